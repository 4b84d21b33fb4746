"""Importance resampling of documents towards a target distribution, over hashed word runs.

Bucket-partitioned inverted postings: texts become postings (bucket, document, count), written once in blocks of some thousand
documents, with a row for each bucket of a block. They are shuffled by bucket and salt; there they meet the bucket's totals in both
corpora, from which its gain follows, and every posting contributes count * gain. Contributions are summed by block before they
are shuffled again, then by document. A hot bucket has one row in each block, dealt over SALTS tasks, so no task gets a list that
grows with the corpus alone; memory is bounded by a block. The draw ranks by ranges of the score, of which only sizes reach the
driver.

Defined results: a null text has no words. Rows that repeat an id are parts of one document: their words and features are added,
runs don't cross rows. A null id has no score, so it is neither counted among the eligible nor drawn; such rows are one document.
Scores that tie go to the smaller id. A document without features has weight 0. Texts of any length are read whole. An empty target
or corpus is a corpus of no features. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, input_partitions, materialise, small_batches, text_or_empty, tidy

#: Rows of a block at most, so that a document's place in it fits 16 bits.
BLOCK_ROWS = 1 << 16
#: Bytes of text in a block, about.
BLOCK_BYTES = 4 << 20
#: Tasks that a bucket's postings are dealt over.
SALTS = 32
#: Longest word, in bytes, whose checksum is found in step with others'.
STEPWISE = 64

ALL = 0xFFFFFFFF
BLOCKS = "bucket int, salt int, target boolean, block long, size int, places binary, counts binary, total long, ids array<long>, words array<long>"


@functools.cache
def _crc_table() -> np.ndarray:
    """What a byte does to the register of CRC-32, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


@functools.cache
def _zeros_tables() -> np.ndarray:
    """[n, k, b]: the register after n zero bytes that began with byte k set to b alone. Registers are linear in their bits."""
    tables = np.zeros((STEPWISE + 1, 4, 256), np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(STEPWISE):
        tables[n + 1] = _crc_table()[tables[n] & 255] ^ (tables[n] >> 8)
    return tables


def _after(register: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Registers after words of these lengths that would have left `words` behind from an empty register."""
    short = np.minimum(lengths, STEPWISE)
    tables = _zeros_tables()
    out = words.copy()
    for k in range(4):
        out ^= tables[short, k, (register >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(lengths > STEPWISE):
        out[i] = words[i] ^ np.uint32(zlib.crc32(bytes(int(lengths[i])), int(register[i]) ^ ALL) ^ ALL)
    return out


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every word of texts that follow each other in lower-cased data and end at `ends`."""
    kind = np.zeros(256, bool)
    kind[ord("0") : ord("9") + 1] = kind[ord("a") : ord("z") + 1] = kind[128:] = True
    inside = kind[data]
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[ends[ends < len(data)]] = False
    after[ends[ends > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1 - starts, np.searchsorted(ends, starts, side="right")


def run_checksums(data: np.ndarray, ends: np.ndarray, longest_run: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For runs of 1, 2, ... words: CRC-32 of the words joined by a space, and the text number; and each text's number of words."""
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    data = lower[data]
    starts, lengths, text = _words(data, ends)
    order = np.argsort(-lengths, kind="stable")
    first, sizes = starts[order], lengths[order]
    register = np.zeros(len(order), np.uint32)
    table = _crc_table()
    for i in range(min(STEPWISE, int(sizes[0]) if len(sizes) else 0)):
        n = int(np.searchsorted(-sizes, -i, side="left"))  # words longer than i
        register[:n] = table[(register[:n] ^ data[first[:n] + i]) & 255] ^ (register[:n] >> 8)
    for i in range(int(np.searchsorted(-sizes, -STEPWISE, side="left"))):
        register[i] = zlib.crc32(data[first[i] : first[i] + sizes[i]], ALL) ^ ALL
    alone = np.empty_like(register)
    alone[order] = register
    runs, state, at = [], np.full(len(alone), ALL, np.uint32), np.arange(len(alone))
    for n in range(longest_run):
        if n:
            more = at + n < len(alone)
            at, state = at[more], state[more]
            same = text[at + n] == text[at]
            at, state = at[same], state[same]
            state = table[(state ^ np.uint32(32)) & 255] ^ (state >> 8)
        state = _after(state, alone[at + n], lengths[at + n])
        runs.append((state ^ np.uint32(ALL), text[at]))
    return runs, np.bincount(text, minlength=len(ends))


def _blocks(docs: DataFrame, id_col: str | None, text_col: str, *, buckets: int, longest_run: int) -> DataFrame:
    """Postings in blocks: a row for each bucket, and one with bucket -1 that has the block's ids and numbers of words."""
    ids = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    target = id_col is None
    names = [f.split()[0] for f in BLOCKS.split(", ")]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for whole in small_batches(batches, ["_text"], BLOCK_BYTES):
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                texts, n = batch.column(1).cast(pa.large_binary()), batch.num_rows
                at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
                data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
                runs, words = run_checksums(data, at[1:] - at[0], longest_run)
                key = np.concatenate([(crc % np.uint32(buckets)).astype(np.int64) * n + text for crc, text in runs])
                key.sort()
                new = np.flatnonzero(np.diff(key, prepend=-1))
                counts = np.diff(new, append=len(key))
                key = key[new]
                # Counts beyond 16 bits become several postings.
                times = (counts - 1) // 65535 + 1
                full = np.repeat(np.where(times > 1, 65535, counts), times)
                last = np.cumsum(times) - 1
                full[last] = counts - (times - 1) * 65535
                key = np.repeat(key, times)
                bucket, place = key // n, (key % n).astype("<u2")
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                bytes_at = np.append(first, len(key)).astype(np.int64) * 2
                if bytes_at[-1] >= 1 << 31:
                    raise ValueError("a block's postings pass 2 GiB: lower BLOCK_BYTES")
                offsets, rows = pa.py_buffer(bytes_at.astype(np.int32)), len(first)
                binary = lambda x: pa.Array.from_buffers(pa.binary(), rows, [None, offsets, pa.py_buffer(x.astype("<u2"))])  # noqa: E731, B023
                total = np.add.reduceat(full, first) if rows else np.zeros(0, np.int64)
                none = pa.nulls(rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[first].astype(np.int32)), pa.array(np.full(rows, (block * 7919 >> 3) % SALTS, np.int32)), pa.array(np.full(rows, target)), pa.array(np.full(rows, block)),
                    pa.array(np.full(rows, n, np.int32)), binary(place), binary(full), pa.array(total), none, none,
                ], names)
                if not target:
                    one = lambda x, kind: pa.array([x], kind)
                    lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x) for x in (batch.column(0), pa.array(words))]
                    yield pa.RecordBatch.from_arrays([
                        one(-1, pa.int32()), one(0, pa.int32()), one(False, pa.bool_()), one(block, pa.int64()), one(n, pa.int32()), one(b"", pa.binary()), one(b"", pa.binary()), one(0, pa.int64()), *lists,
                    ], names)
                block += 1

    return docs.select(ids.alias("_id"), text_or_empty(docs[text_col]).alias("_text")).mapInArrow(run, BLOCKS)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of count * gain by place, of rows that come in order of their block."""
    block, held = None, np.zeros(0)

    def out():
        sums = pa.array(held.astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), sums)], ["block", "sums"])

    for batch in batches:
        blocks, sizes, gain = (batch.column(k).to_numpy() for k in (0, 1, 4))
        raw = []
        for k in (2, 3):
            a = batch.column(k)
            at = np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + len(a) + 1]
            raw.append((np.frombuffer(a.buffers()[2] or b"", np.uint8)[at[0] : at[-1]].view("<u2"), (at - at[0]) // 2))
        (places, at), (counts, _) = raw
        worth = counts * np.repeat(gain, np.diff(at)).astype(float)  # whole numbers below 2 ** 53
        starts = np.flatnonzero(np.diff(blocks, prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], len(blocks)), strict=True):
            if blocks[a] != block:
                if block is not None:
                    yield out()
                block, held = blocks[a], np.zeros(sizes[a])
            held += np.bincount(places[at[a] : at[b]], worth[at[a] : at[b]], minlength=len(held))
    if block is not None:
        yield out()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of a block: its id, words and sum, of rows in order of block with the ids first."""
    ids = words = sums = None

    def out():
        return pa.RecordBatch.from_arrays([ids, pa.array(words), pa.array(sums)], ["_id", "words", "sum"])

    for batch in batches:
        for k in range(batch.num_rows):
            if batch.column(1)[k].is_valid:
                if ids is not None:
                    yield out()
                ids, words = batch.column(1)[k].values, batch.column(2)[k].values.to_numpy()
                sums = np.zeros(len(ids), np.int64)
            else:
                sums = sums + batch.column(3)[k].values.to_numpy()
    if ids is not None:
        yield out()


def gain(s: Column, t: Column, corpus: int, target: int, buckets: int) -> Column:
    """A bucket's gain in thousandths of a natural logarithm, from its features and all features of corpus and target."""
    share = (t + 1).cast("double") * F.lit(float(corpus + buckets)) / ((s + 1).cast("double") * F.lit(float(target + buckets)))
    return F.floor(F.lit(1000.0) * F.log(share)).cast("long")


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weights(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", buckets: int = 10_000, longest_run: int = 2) -> DataFrame:
    """Per id: doc_id, n_words, n_features, weight (the floored mean of its features' gains)."""
    made = _blocks(docs, id_col, text_col, buckets=buckets, longest_run=longest_run).unionByName(_blocks(target, None, target_col, buckets=buckets, longest_run=longest_run))
    blocks = materialise(made, "postings")
    postings = blocks.where("bucket >= 0")
    of = lambda which: F.coalesce(F.sum(F.when(F.col("target") == which, F.col("total"))), F.lit(0))
    corpus, aimed = postings.agg(of(False), of(True)).first()
    totals = postings.groupBy("bucket").agg(of(False).alias("s"), of(True).alias("t"))
    gains = totals.select("bucket", gain(F.col("s"), F.col("t"), corpus, aimed, buckets).alias("gain"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = postings.where("not target").join(gains.hint("shuffle_hash"), ["bucket", "salt"]).select("block", "size", "places", "counts", "gain")
    sums = met.sortWithinPartitions("block").mapInArrow(tidy(_block_sums), "block long, sums array<long>")
    heads = blocks.where("bucket < 0").select("block", "ids", "words", F.lit(None).cast("array<long>").alias("sums"))
    none = F.lit(None).cast("array<long>")
    parts = heads.unionByName(sums.select("block", none.alias("ids"), none.alias("words"), "sums"))
    parts = parts.repartition(input_partitions(docs), "block").sortWithinPartitions("block", F.col("ids").isNull())
    rows = parts.select("block", "ids", "words", "sums").mapInArrow(tidy(_documents), "_id long, words long, sum long")
    features = sum((F.greatest(F.col("words") - n, F.lit(0)) for n in range(1, longest_run)), F.col("words"))
    by_id = rows.withColumn("features", features).groupBy("_id").agg(F.sum("words").alias("n_words"), F.sum("features").alias("n_features"), F.sum("sum").alias("sum"))
    mean = F.when(F.col("n_features") > 0, F.expr("(sum - pmod(sum, n_features)) div n_features")).otherwise(F.lit(0))
    out = materialise(by_id.select(F.col("_id").alias("doc_id"), "n_words", "n_features", mean.cast("long").alias("weight")), "weights")
    discard(blocks)
    return out


def ranked(rows: DataFrame, best: str, tie: str) -> DataFrame:
    """rows with their rank from 1 by `best`, largest first, then by the smaller `tie`; no two rows tie on both.

    Ranges of the order are dealt to tasks; the driver gets the number of rows of each.
    """
    order = [F.col(best).desc(), F.col(tie).asc()]
    parts = materialise(rows.repartitionByRange(input_partitions(rows), *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_part"], r["count"]) for r in parts.groupBy("_part").count().collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(starts, "_part int, _before long")
    counted = parts.withColumn("_place", F.expr(f"row_number() over (partition by _part order by {best} desc, {tie} asc)"))
    return counted.join(offsets, "_part").withColumn("rank", F.col("_before") + F.col("_place")).drop("_part", "_before", "_place")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = 10_000,
    longest_run: int = 2,
    least_words: int = 20,
    percent: int = 25,
    seed: int = 7,
) -> DataFrame:
    """Draw documents that look like the target: per id doc_id, n_words, n_features, weight, score, rank (null where not drawn).

    Of the documents with least_words words or more, percent in a hundred are drawn (rounded down), by weight plus Gumbel noise:
    sampling without replacement, in proportion to the likelihood ratio.
    """
    rows = weights(docs, target, id_col=id_col, text_col=text_col, target_col=target_col, buckets=buckets, longest_run=longest_run)
    rows = rows.withColumn("score", F.col("weight") + noise("doc_id", seed))
    fit = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    quota = percent * rows.where(fit).count() // 100
    drawn = ranked(rows.where(fit), "score", "doc_id").withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    return drawn.unionByName(rows.where(~fit).withColumn("rank", F.lit(None).cast("long")))
