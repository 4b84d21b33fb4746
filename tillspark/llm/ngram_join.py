"""Near duplicates by Jaccard similarity of word n-grams: a grouped prefix join with exact results.

Two documents link when den * |A and B| >= num * |A or B| for their sets of distinct shingles. The order of work:

1. Sets. Every whole text becomes a set of 64-bit shingle hashes. Rows with equal sets collapse to one node, which the number of
   one of those rows names.
2. Prefixes. A set of n shingles misses at most n - ceil(num n / den) shingles of a partner, p(n) is one more. Of the p(n) + q(n)
   shingles with the smallest hashes two partners share at least q + 1 (q of the smaller set), so among those, ordered by rising
   document frequency, a prefix of p(n) and a few finds every partner. Only this part of the shingles is shuffled and counted,
   and the rare ones come first, so a passage that many documents share stays out of the prefix of a document that is at least
   two thirds its own. A document without a prefix shingle that another has links with nothing and is done.
3. Groups. Nodes with the same prefix and the same size form a group (cut in parts of at most GROUP_ROWS). Lists of groups by
   prefix shingle give pairs of groups; of lists that hold the same groups one is worked on, so copies that share many shingles
   meet once. Pairs are filtered by size and by a lower bound of the members' difference: each set has parity bits, of which two
   sets differ in at most as many as in elements, and a group has the bits of its first member and a radius. The pairs that
   remain expand to members, which pass the same bound. Lists of more than LIST_GROUPS groups or LIST_BYTES of bits are cut into
   blocks, and pairs of blocks are separate pieces of work, so no list has to fit in one task.
4. Verification on the full sets. Copies in a large group need not all be compared: a first round verifies a spanning forest of
   the candidates and a second round those candidates whose ends are not connected yet. So no link between different components
   can be missed, and a group of m near copies costs about m verifications. Lists of which no pair was left out, and those whose
   groups are all connected by then, are not worked on again.
5. Connected components by alternating large-star and small-star steps on the links, and on the sets that share a document id.

Words: A-Z lower-cased, then runs of characters other than space and bytes 9 to 13. A set: distinct n-word shingles; with fewer
words, the whole sequence as one; a null, empty or blank text has the empty set and links with nothing. Repeated rows have equal
sets and share a component; rows that repeat an id with other texts are one document with all their links, while n_shingles is
each row's own; an empty row has its own id as component. A row with a null id has a null component and takes no part. Ties need no rule, and the order of the rows makes
no difference. Texts are read whole, of any length. Other columns are ignored by `near_duplicates` and carried by `keep_one`. An
empty table gives an empty result. Hashes of 64 bits stand for shingles: two different shingles of two compared documents are
taken for one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, narrowed, small_batches, text_or_empty, tidy, worker_slot

#: Parity bits of a set of n shingles: the power of two from BITS n on, LEAST_BITS at least.
BITS, LEAST_BITS = 4, 512
GROUP_ROWS = 64
LIST_GROUPS, LIST_BYTES = 4096, 16 << 20
#: Rows that a task remembers to spare work; then it starts anew. Results don't depend on it.
REMEMBERED = 200_000
U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    _powers = worker_slot("ngram_join", dict)
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            _powers[name] = np.concatenate([np.ones(1, U), np.cumprod(np.full(size, base, U))])
    return _powers["up"], _powers["down"]


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text; words are hashed by differences of one running polynomial over all texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    if not n:
        return [np.zeros(0, U) for _ in texts]
    up, down = _power_tables(n + 1)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    folded = np.where((data >= 65) & (data <= 90), data + 32, data)
    running = np.zeros(n + 1, U)
    np.cumsum(_mix(folded.astype(U) + U(1)) * up[:n], out=running[1:])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = ~white, ~white
    start[1:] &= white[:-1] | edge[1:n]
    end[:-1] &= white[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    word = _mix((running[e] - running[s]) * down[s] + (e - s).astype(U))
    cut = np.searchsorted(s, offsets)
    rolled = np.zeros(max(0, len(word) - words + 1), U)
    for k in range(words):
        rolled = _mix(rolled * U(_ODD) + word[k : k + len(rolled)])
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            whole = np.full(1, b - a, U)
            for k in range(a, b):
                whole = _mix(whole * U(_ODD) + word[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, U))
    return out


class Limits:
    """The integer bounds that follow from the threshold num / den."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the threshold must be above 0 and at most 1")
        self.num, self.den = num, den

    def least_size(self, n: int) -> int:
        """Of a partner of a set of n, and of the intersection with it."""
        return -(-self.num * n // self.den)

    def overlap(self, both):
        """Least intersection of two sets whose sizes add up to `both`."""
        return -(-self.num * both // (self.num + self.den))

    def prefix(self, n: int) -> int:
        return n - self.least_size(n) + 1

    def spare(self, n: int) -> int:
        """q: it never falls as n grows, which the prefix rule needs."""
        return min(n - self.prefix(n), max(self.prefix(n) // 2, 8)) if n else 0

    def taken(self, n: int) -> int:
        """Smallest hashes of a set that take part in prefixes."""
        return self.prefix(n) + self.spare(n) if n else 0

    def kept(self, n: int) -> int:
        """Of those, in order of rising frequency, the prefix: with p(m) + q(m) taken from the smallest partner m, q(m) + 1 are shared."""
        return self.taken(n) - self.spare(self.least_size(n))


def parity_bits(s: np.ndarray) -> bytes:
    """Which hash values modulo a power of two of BITS n or more occur an odd number of times in the set."""
    width = max(LEAST_BITS, 1 << (BITS * len(s) - 1).bit_length())
    odd = np.bincount((s & U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bits of a set (64 in a word, along the last axis) for a smaller power of two."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits: two sets differ in at least as many elements."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _sketch(docs: DataFrame, words: int, limits: Limits) -> DataFrame:
    """doc_id, row, n, sig, taken, bits. Of equal sets in a task only the first row, which `row` numbers, carries the last two."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        row = TaskContext.get().partitionId() << 33
        for b in small_batches(batches, ["text"], 1 << 20):
            ids = b.column("doc_id").to_pylist()
            sets = shingle_sets([t.encode() for t in b.column("text").to_pylist()], words)
            sig = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            lead = []
            for i, s, x in zip(ids, sets, sig, strict=True):
                lead.append(i is not None and len(s) > 0 and x not in seen)
                if lead[-1]:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(x)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(range(row, row + len(ids)), pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sig, pa.binary()),
                    pa.array([s[: limits.taken(len(s))].tobytes() if k else None for k, s in zip(lead, sets, strict=True)], pa.binary()),
                    pa.array([parity_bits(s) if k else None for k, s in zip(lead, sets, strict=True)], pa.binary()),
                ],
                names=["doc_id", "row", "n", "sig", "taken", "bits"],
            )
            row += len(ids)

    return docs.mapInArrow(run, "doc_id long, row long, n long, sig binary, taken binary, bits binary")


def _tokens(leads: DataFrame) -> DataFrame:
    """token, row of every shingle that takes part."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            taken = b.column("taken").to_pylist()
            tokens = np.frombuffer(b"".join(taken), "<i8")
            rows = np.repeat(b.column("row").to_numpy(), [len(t) // 8 for t in taken])
            for at in range(0, len(tokens), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(tokens[at : at + 200_000]), pa.array(rows[at : at + 200_000])], names=["token", "row"])

    return leads.select("row", "taken").mapInArrow(run, "token long, row long")


def _prefixes(shared: DataFrame, limits: Limits) -> DataFrame:
    """node, n, prefix (of the shingles that others have too) of rows with row, n, m (shingles that take part), seen.

    Rows without any are left out.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, out = [], []
            sizes = zip(b.column("n").to_pylist(), b.column("m").to_pylist(), b.column("seen"), strict=True)
            for k, (n, m, seen) in enumerate(sizes):
                room = limits.kept(n) - (m - len(seen))  # shingles of its own come first
                if room <= 0:
                    continue
                v = seen.values
                df, token = v.field("df").to_numpy(), v.field("token").to_numpy()
                order = np.lexsort((token, df))[:room]
                keep.append(k)
                out.append(token[order].astype("<i8").tobytes())
            picked = b.take(pa.array(keep, pa.int64()))
            columns = [picked.column(c) for c in ("row", "n")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=["node", "n", "prefix"])

    return shared.mapInArrow(run, "node long, n long, prefix binary")


def _groups(prefixes: DataFrame) -> DataFrame:
    """group, n, prefix, members (array of rep, bits): equal prefix and size, in parts of about GROUP_ROWS at most."""
    large = prefixes.groupBy("n", "prefix").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > GROUP_ROWS)
    share = F.ceil(F.coalesce("rows", F.lit(1)) / GROUP_ROWS).cast("int")
    parts = prefixes.join(large, ["n", "prefix"], "left").withColumn("part", F.pmod(F.xxhash64("node"), share))
    members = F.sort_array(F.collect_list(F.struct(F.col("node").alias("rep"), "bits"))).alias("members")
    return parts.groupBy("n", "prefix", "part").agg(F.min("node").alias("group"), members).drop("part")


def _lists(groups: DataFrame) -> DataFrame:
    """token, group, own block, blocks: the lists of groups by prefix shingle, one of those that hold the same groups."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefix = b.column("prefix").to_pylist()
            times = [len(p) // 8 for p in prefix]
            columns = [np.repeat(b.column(c).to_numpy(), times) for c in ("group", "size", "n")]
            tokens = np.frombuffer(b"".join(prefix), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tokens, *columns)], names=["token", "group", "size", "n"])

    sized = groups.select("group", "prefix", F.size("members").alias("size"), "n")
    tokens = sized.mapInArrow(run, "token long, group long, size int, n long")
    held = F.sum(F.col("size") * F.greatest(F.col("n") * (BITS / 4), F.lit(LEAST_BITS / 8)))  # bytes of bits, rounded up
    lists = tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("size").alias("rows"), held.alias("bytes"),
        F.bit_xor(F.xxhash64("group")).alias("h1"), F.bit_xor(F.xxhash64("group", F.lit(1))).alias("h2"),
    )
    blocks = F.ceil(F.greatest(F.col("groups") / LIST_GROUPS, F.least(F.col("bytes") / LIST_BYTES, F.col("groups")))).cast("int")
    alike = lists.where("rows > 1").groupBy("groups", "h1", "h2")
    chosen = alike.agg(F.min("token").alias("token"), F.max(blocks).alias("blocks")).select("token", "blocks")
    own = F.pmod(F.xxhash64("group"), F.col("blocks"))
    return tokens.select("token", "group").join(chosen, "token").select("token", "group", own.alias("own"), "blocks")


def _work(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Pieces of work: token, left and right block, own block, and the columns of groups."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = lists.select("token", "group", "own", other)
    blocks = [F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right")]
    return placed.select("token", *blocks, "own", "group").join(groups, "group")


class _Forest:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def bounded(self) -> None:
        if len(self.parent) > REMEMBERED:
            self.parent.clear()

    def root(self, x: int) -> int:
        p = self.parent
        while (y := p.get(x, x)) != x:
            p[x] = p.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def list_pairs(rows: list[dict], limits: Limits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs (reps) of one piece of work; rows have own, left, right, n, members."""
    rows.sort(key=lambda r: (r["n"], r["group"]))
    n = np.array([r["n"] for r in rows], np.int64)
    bits = [np.stack([np.frombuffer(m["bits"], np.uint64) for m in r["members"]]) for r in rows]
    ids = [np.array([m["rep"] for m in r["members"]]) for r in rows]
    size = np.array(list(map(len, ids)))
    radius = np.array([int(distance(b[0], b).max()) if len(b) > 1 else 0 for b in bits])
    own = np.array([r["own"] for r in rows])
    within = rows[0]["left"] == rows[0]["right"]
    ends = np.searchsorted(n, limits.den * n // limits.num, side="right")  # partners are at most so large
    words = np.array([b.shape[1] for b in bits])  # never falls, as the rows are in order of n
    first: dict[int, tuple[int, np.ndarray]] = {}
    for w in np.unique(words).tolist():
        at = int(np.searchsorted(words, w))
        first[w] = (at, np.stack([folded(b[0], w) for b in bits[at:]]))
    for k in range(len(rows)):
        if within and size[k] > 1:
            a, b = np.triu_indices(size[k], 1)
            ok = (2 * n[k] - distance(bits[k][a], bits[k][b])) // 2 >= limits.overlap(2 * n[k])
            yield ids[k][a[ok]], ids[k][b[ok]]
        if ends[k] <= k + 1:
            continue
        w = int(words[k])
        at, table = first[w]
        # A group's first member stands for it; no member lies farther from it than the group's radius.
        apart = distance(table[k - at], table[k + 1 - at : ends[k] - at]) - radius[k] - radius[k + 1 : ends[k]]
        both = n[k] + n[k + 1 : ends[k]]
        ok = (both - apart) // 2 >= limits.overlap(both)
        if not within:
            ok &= own[k + 1 : ends[k]] != own[k]
        j = np.flatnonzero(ok) + k + 1
        alone = j[(size[j] == 1) & (size[k] == 1)]
        if len(alone):
            yield np.repeat(ids[k], len(alone)), np.concatenate([ids[o] for o in alone])
        for o in j[(size[j] > 1) | (size[k] > 1)].tolist():
            apart = distance(bits[k][:, None, :], folded(bits[o], w)[None, :, :])
            a, b = np.nonzero((n[k] + n[o] - apart) // 2 >= limits.overlap(n[k] + n[o]))
            yield ids[k][a], ids[o][b]


def _candidates(work: DataFrame, limits: Limits, labelled: bool) -> DataFrame:
    """a, b, thinned: pairs to verify. Without labels, each task thins its candidates to a spanning forest and names the lists of
    which it left out pairs, in rows with thinned (a token) alone; with labels, all pairs whose labels differ."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, told = _Forest(), set()

        def piece(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            forest.bounded()
            if len(told) > REMEMBERED:
                told.clear()
            known = {m["rep"]: x for r in rows for m, x in zip(r["members"], r["labels"], strict=True)} if labelled else {}
            found, thinned = [], False
            if not labelled or len(set(known.values())) > 1:
                for a, b in list_pairs(rows, limits):
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        pair = (min(x, y), max(x, y))
                        if pair in told or labelled and known[x] == known[y]:
                            continue
                        if labelled or forest.join(x, y):
                            told.add(pair)
                            found.append((*pair, None))
                        else:
                            thinned = True
            if thinned:
                found.append((None, None, rows[0]["token"]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b", "thinned"])

        held, key = [], None
        for b in batches:
            for row in b.to_pylist():
                at = (row["token"], row["left"], row["right"])
                if at != key:
                    if held:
                        yield from piece(held)
                    held, key = [], at
                held.append(row)
        if held:
            yield from piece(held)

    dealt = work.repartition("token", "left", "right").sortWithinPartitions("token", "left", "right")
    return dealt.mapInArrow(run, "a long, b long, thinned long")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, set of the nodes wanted (node, sig, first), from the rows of the ids in first that have the set."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, ["text"], 1 << 20):
            found = shingle_sets([t.encode() for t in b.column("text").to_pylist()], words)
            raw = [s.tobytes() for s in found]
            same = [xxhash.xxh3_128_digest(r) == sig for r, sig in zip(raw, b.column("sig").to_pylist(), strict=True)]
            sets = pa.RecordBatch.from_arrays([b.column("node"), pa.array(raw, pa.binary())], names=["node", "set"])
            yield sets.filter(pa.array(same, pa.bool_()))

    named = wanted.select(F.col("first").alias("doc_id"), "node", "sig")
    return narrowed(docs, "doc_id", named).join(named, "doc_id").select("node", "sig", "text").mapInArrow(run, "node long, set binary").dropDuplicates(["node"])


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, limits: Limits) -> DataFrame:
    """The pairs that link, by their full sets."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = materialise(nodes.join(ends, "node", "left_semi"), "wanted")
    known = materialise(_sets(docs, wanted, words), "sets")
    a, b = (known.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, ["set_a", "set_b"], 4 << 20):
            ok = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                same = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(limits.den * same >= limits.num * (len(x) + len(y) - same))
            picked = b.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([picked.column("a"), picked.column("b")], names=["a", "b"])

    links = materialise(pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long"), "links")
    discard(known, wanted)
    return links


def _stars(links: DataFrame) -> DataFrame:
    """Links of a task contracted to stars: the same components with fewer, shallower edges."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, seen = _Forest(), set()

        def stars() -> Iterator[pa.RecordBatch]:
            out = [(forest.root(x), x) for x in seen if forest.root(x) != x]
            for at in range(0, len(out), 100_000):
                columns = zip(*out[at : at + 100_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        for b in batches:
            for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
                forest.join(x, y)
                seen.update((x, y))
            if len(seen) > REMEMBERED:
                yield from stars()
                forest, seen = _Forest(), set()
        yield from stars()

    return links.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, label (smallest node of its component, other than itself) from links a, b; nodes that are their own label are left out."""
    edges, before = materialise(_stars(links).distinct(), "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
        before = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        # Edges point from a smaller a to a larger b here, so the small-star step ties a node's smaller neighbours together.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x <> y")
        last, edges = edges, materialise(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        discard(last)


def near_duplicates(docs: DataFrame, *, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id per row; documents link at a Jaccard similarity of num / den or more."""
    limits = Limits(num, den)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    sketch = materialise(_sketch(rows, words, limits), "sketch")
    usable = sketch.where("n > 0 and doc_id is not null")
    nodes = materialise(usable.groupBy("sig").agg(F.min("row").alias("node"), F.min("doc_id").alias("first")), "nodes")

    leads = usable.where("taken is not null")
    tokens = _tokens(leads)
    frequent = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(frequent, "token").groupBy("row").agg(F.collect_list(F.struct("df", "token")).alias("seen"))
    # Of leads of equal sets in several tasks the one that names the node stays.
    chosen = shared.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    sized = leads.select("row", "n", F.floor(F.octet_length("taken") / 8).alias("m")).join(chosen, "row")
    prefixes = materialise(_prefixes(sized.select("row", "n", "m", "seen"), limits), "prefixes")
    bits = narrowed(leads.select(F.col("row").alias("node"), "bits"), "node", prefixes.select("node"))
    groups = materialise(_groups(prefixes.join(bits, "node")), "groups")
    discard(prefixes)
    lists = whole = materialise(_lists(groups), "lists")

    def candidates(lists: DataFrame, groups: DataFrame, labelled: bool) -> DataFrame:
        return materialise(_candidates(_work(lists, groups), limits, labelled).distinct(), "pairs")

    plain = groups.select("group", "n", "members")
    pairs = candidates(lists, plain, False)
    links = _verified(rows, nodes, pairs.where("thinned is null").select("a", "b"), words, limits)
    label = components(links)
    # Round two: what the forest left unconnected, in thinned lists that hold more than one label.
    thinned = pairs.where("thinned is not null").select(F.col("thinned").alias("token"))
    lists = lists.join(thinned, "token", "left_semi")
    members = groups.select("group", F.posexplode("members.rep").alias("at", "node"))
    named = members.join(label, "node", "left").select("group", "at", F.coalesce("label", "node").alias("label"))
    told = F.sort_array(F.collect_list(F.struct("at", "label"))).alias("told")
    labels = materialise(named.groupBy("group").agg(told, F.min("label").alias("low"), F.max("label").alias("high")), "labels")
    several = lists.join(labels.select("group", "low", "high"), "group").groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    open_lists = lists.join(several.where("low < high").select("token"), "token", "left_semi")
    again = candidates(open_lists, plain.join(labels.select("group", F.col("told.label").alias("labels")), "group"), True)
    if not again.isEmpty():
        links = links.union(_verified(rows, nodes, again.select("a", "b"), words, limits))
    discard(groups, whole, pairs, again, labels)

    # Sets of one document belong together too; then every node gets the smallest id of its component.
    placed = materialise(usable.select("doc_id", "n", "sig").join(nodes.select("sig", "node"), "sig").drop("sig"), "placed")
    ids = placed.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high")).where("a < high").drop("high")
    own = placed.join(ids, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))
    label = components(links.union(own))
    named = materialise(nodes.select("node", "first").join(label, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    least = materialise(named.groupBy("label").agg(F.min("first").alias("component_id")), "components")
    found = materialise(named.select("node", "label").join(least, "label").select("node", "component_id"), "components")
    discard(nodes, named, least)
    alone = sketch.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return placed.join(found, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)


def keep_one(docs: DataFrame, *, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs (doc_id, text and other columns) with the smallest id left of each component; rows with a null id stay."""
    found = near_duplicates(docs, words=words, num=num, den=den)
    return docs.join(found.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
