"""Packing token sequences by the linear grouping scheme.

Every document becomes the ids of its text followed by an end id, cut into pieces of at most `capacity` tokens. Only the number
of pieces of each length decides a packing, so a plan is made from that histogram, which has `capacity` rows whatever the size
of the corpus:

1. Pieces longer than `small` are sorted and cut into `groups` groups of equal cardinality; each length is rounded up to the
   largest of its group, which leaves few sizes.
2. The configurations of these sizes that fit a sequence are optimised as a cutting-stock linear program by column generation
   (a knapsack finds each new configuration); the solution is rounded down and best-fit decreasing covers what is left.
3. Actual pieces take the places of the rounded ones, which they never exceed.
4. Best fit puts the small pieces, longest first, into the fullest sequences that can hold them, and opens new ones at the end.
5. The plan is held against best fit of all pieces by actual length, which takes a fraction of a second; the one with fewer sequences
   counts, so a program that ended early never costs a sequence.

Pieces then find their place by their rank among pieces of equal length. Ranks are counted in salted parts of a length, so a
length that a third of all pieces share is spread over many tasks. The plan that workers look up has at most a few entries per
length and configuration: a few hundred kilobytes.

A null text counts as empty: one piece that holds the end id alone. Texts are read whole. Ties between equal lengths go by
salt, document id and piece; rows that repeat an id, or have none, are packed each. Other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Remembered, input_partitions, materialise, small_batches, text_or_empty, tidy, worker_slot

CAPACITY = 2048
GROUPS = 2048
#: The linear program ends within NEAR of a sequence of its optimum, or after IDLE steps without gain.
NEAR, IDLE = 0.25, 60
#: What a worker remembers of words, and of runs of characters between white space, with their ids; text in a batch; new words in a call.
REMEMBER_BYTES, BATCH_BYTES, LEARN_AT_ONCE = 32 << 20, 4 << 20, 4000

#: Characters for which the tokenizer's normaliser only lower-cases and its pattern (fixed by the vocabulary) says what the one below
#: says: letters, single numbers, runs of other characters.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")


class WordBpe:
    """Ids as little-endian 32-bit bytes. Texts of plain characters are looked up word by word; any other text goes to the tokenizer whole."""

    def __init__(self, path: str, remember_bytes: int = REMEMBER_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)], bool)
        self.words, self.runs = Remembered(remember_bytes * 3 // 8), Remembered(remember_bytes * 5 // 8)

    def _direct(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn_words(self, words: pa.Array) -> None:
        """Many new words in one call: each ends with a piece that ends a word."""
        for at in range(0, len(words), LEARN_AT_ONCE):
            part = words.slice(at, LEARN_AT_ONCE)
            texts = part.to_pylist()
            ids = self._direct(" ".join(texts))
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(texts):
                each = [self._direct(w) for w in texts]
                ids, stops = np.concatenate(each), np.cumsum(list(map(len, each)))
            self.words.add(part, ids, np.diff(stops, prepend=0))

    def _learn_runs(self, runs: pa.Array) -> None:
        fine = [WORDS.findall(run.lower()) for run in runs.to_pylist()]
        coded = pa.array(chain.from_iterable(fine), pa.string()).dictionary_encode()
        words = coded.dictionary
        self._learn_words(words.filter(pa.array(self.words.find(words) < 0)))
        places = self.words.find(words)[coded.indices.to_numpy()]
        before = np.concatenate([[0], np.cumsum(self.words.sizes(places))])
        stops = before[np.cumsum(list(map(len, fine)))]
        self.runs.add(runs, self.words.gather(places), np.diff(stops, prepend=0))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """No word reaches over white space, so each run between white space is looked up once for all texts."""
        self.words.trim()
        self.runs.trim()
        odd = [i for i, t in enumerate(texts) if PLAIN.search(t)]
        plain = pa.array(["" if k else t for t, k in zip(texts, _flags(odd, len(texts)), strict=True)], pa.string())
        lists = pc.ascii_split_whitespace(plain)
        coded = lists.flatten().dictionary_encode()
        at = self.runs.find(coded.dictionary)
        if (at < 0).any():
            self._learn_runs(coded.dictionary.filter(pa.array(at < 0)))
            at = self.runs.find(coded.dictionary)
        places = at[coded.indices.to_numpy()]
        ends = np.concatenate([[0], np.cumsum(self.runs.sizes(places))])
        cuts = (ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()] * 4).tolist()
        raw = self.runs.gather(places).tobytes()
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for i in odd:
            out[i] = self._direct(texts[i]).tobytes()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _flags(at: list[int], n: int) -> list[bool]:
    flags = [False] * n
    for i in at:
        flags[i] = True
    return flags


def load(path: str, remember_bytes: int = REMEMBER_BYTES) -> WordBpe:
    return worker_slot(("packing", path, remember_bytes), lambda: WordBpe(path, remember_bytes))


def token_pieces(
    docs: DataFrame, *, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    remember_bytes: int = REMEMBER_BYTES, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each row.

    remember_bytes, batch_bytes: a worker's memory against its time; smaller ones give the same result more slowly.
    """
    end = struct.pack("<I", end_id)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(tokenizer, remember_bytes).encode_all
        for b in small_batches(batches, ["text"], batch_bytes):
            out = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), encode(b.column("text").to_pylist()), strict=True):
                raw = ids + end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# The plan: sequences of one kind are [count, room left, [(length, copies), ...]].


def linear_groups(counts: np.ndarray, small: int, groups: int) -> list[tuple[int, list[list[int]]]]:
    """Lengths over small in descending order, cut into groups of equal cardinality: (rounded length, [[length, count], ...])."""
    total = int(counts[small + 1 :].sum())
    share = max(1, -(-total // groups))
    out, room = [], 0
    for length in range(len(counts) - 1, small, -1):
        c = int(counts[length])
        while c:
            if not room:
                out.append((length, []))
                room = share
            take = min(c, room)
            out[-1][1].append([length, take])
            c, room = c - take, room - take
    return out


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most worth that fits, each size any number of times."""
    best, taken = np.zeros(capacity + 1), []
    for k, s in enumerate(sizes):
        if worth[k] <= 1e-12:
            continue
        for _ in range(capacity // s):
            with_it = best[:-s] + worth[k]
            better = with_it > best[s:] + 1e-12
            if not better.any():
                break
            mark = np.zeros(capacity + 1, bool)
            mark[s:] = better
            best = best.copy()
            best[s:][better] = with_it[better]
            taken.append((k, s, mark))
    at, amounts = capacity, np.zeros(len(sizes), np.int64)
    for k, s, mark in reversed(taken):
        if mark[at]:
            amounts[k] += 1
            at -= s
    return float(best[capacity]), amounts


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, np.ndarray]]:
    """Configurations with counts that cover the demand: the linear program's solution rounded down, the rest by best-fit decreasing."""
    sizes_, need = np.array(sizes), np.array(demand, float)
    n = len(sizes_)
    columns = np.diag(capacity // sizes_).astype(float)
    inverse = np.linalg.inv(columns)
    amount = inverse @ need
    best, idle = float("inf"), 0
    for step in range(20 * n):
        if step % 50 == 49:
            inverse = np.linalg.inv(columns)
            amount = inverse @ need
        price = inverse.sum(axis=0)
        worth, column = _knapsack(sizes_, price, capacity)
        value = float(amount.sum())
        if value - value / worth < NEAR:  # value / worth is a lower bound of the optimum
            break
        if value < best - 1e-9:
            best, idle = value, 0
        idle += 1
        if idle > IDLE:  # steps that change nothing, as those of equal ratios may be
            break
        change = inverse @ column
        usable = change > 1e-9
        if not usable.any():
            break
        ratio = np.where(usable, amount / np.where(usable, change, 1), np.inf)
        out = int(np.argmin(ratio))
        moved = max(0.0, float(ratio[out]))
        amount = amount - moved * change
        amount[out] = moved
        columns[:, out] = column
        pivot = inverse[out] / change[out]
        inverse = inverse - np.outer(change, pivot)
        inverse[out] = pivot
    whole = np.floor(amount + 1e-6).astype(np.int64).clip(0)
    found = [(int(c), columns[:, k].round().astype(np.int64)) for k, c in enumerate(whole) if c]
    left = np.array(demand, np.int64) - sum((c * a for c, a in found), np.zeros(n, np.int64))
    rooms: list[tuple[int, np.ndarray]] = []
    for k in np.argsort(-sizes_, kind="stable"):
        for _ in range(max(0, int(left[k]))):
            fit = [(r, i) for i, (r, _) in enumerate(rooms) if r >= sizes_[k]]
            if fit:
                r, i = min(fit)
                rooms[i][1][k] += 1
                rooms[i] = (r - int(sizes_[k]), rooms[i][1])
            else:
                a = np.zeros(n, np.int64)
                a[k] = 1
                rooms.append((capacity - int(sizes_[k]), a))
    return found + [(1, a) for _, a in rooms]


def substitute(groups: list[tuple[int, list[list[int]]]], chosen: list[tuple[int, np.ndarray]], capacity: int) -> list[list]:
    """Kinds of sequences in which actual lengths take the places of rounded ones."""
    streams = [[run[:] for run in runs] for _, runs in groups]
    kinds: list[list] = []
    for count, amounts in chosen:
        slots = []
        for g, copies in enumerate(amounts.tolist()):
            for k in range(copies):
                taken, need = [], count
                runs = streams[g]
                while need and runs:
                    run = runs[-1 if k % 2 else 0]  # by turns from either end, so that long meets short
                    t = min(need, run[1])
                    taken.append([run[0], t])
                    run[1] -= t
                    need -= t
                    if not run[1]:
                        runs.remove(run)
                if need:
                    taken.append([0, need])  # more places than pieces
                slots.append(taken)
        at = [[0, s[0][1]] for s in slots]
        done = 0
        while done < count:
            step = min([count - done, *(a[1] for a in at)])
            content: dict[int, int] = {}
            for s, a in zip(slots, at, strict=True):
                if s[a[0]][0]:
                    content[s[a[0]][0]] = content.get(s[a[0]][0], 0) + 1
                a[1] -= step
                if not a[1] and a[0] + 1 < len(s):
                    a[0] += 1
                    a[1] = s[a[0]][1]
            if content:
                kinds.append([step, capacity - sum(x * c for x, c in content.items()), list(content.items())])
            done += step
    return kinds


def best_fit(kinds: list[list], counts: np.ndarray, most: int, capacity: int) -> list[list]:
    """Put the pieces of lengths up to most into the kinds, longest first, each into the least room that holds it."""
    by_room: list[list[list]] = [[] for _ in range(capacity + 1)]
    for kind in kinds:
        by_room[kind[1]].append(kind)
    for length in range(most, 0, -1):
        left, room = int(counts[length]), length
        while left and room <= capacity:
            if not by_room[room]:
                room += 1
                continue
            kind = by_room[room].pop()
            copies = room // length
            whole, rest = min(kind[0], left // copies), 0
            if whole < kind[0]:
                rest = left - whole * copies
            for n, c in ((whole, copies), (1 if rest else 0, rest)):
                if n:
                    by_room[room - c * length].append([n, room - c * length, [*kind[2], (length, c)]])
                    left -= n * c
            if (same := kind[0] - whole - (1 if rest else 0)) > 0:
                by_room[room].append([same, room, kind[2]])
                if not left:
                    break
        if left:
            copies = capacity // length
            for n, c in ((left // copies, copies), (1 if left % copies else 0, left % copies)):
                if n:
                    by_room[capacity - c * length].append([n, capacity - c * length, [(length, c)]])
    return [k for room in by_room for k in room]


def make_plan(counts: np.ndarray, *, capacity: int = CAPACITY, groups: int = GROUPS, small: int | None = None) -> list[list]:
    """Kinds of sequences [count, room, [(length, copies), ...]] that hold counts[length] pieces of each length 0 < length <= capacity."""
    small = 2 * capacity // 5 if small is None else small
    rest = counts.copy()
    kinds = [[int(counts[capacity]), 0, [(capacity, 1)]]] if counts[capacity] else []
    rest[capacity] = 0
    grouped = linear_groups(rest, small, groups)
    if grouped:
        merged: dict[int, list[list[int]]] = {}  # groups of one rounded length are one size
        for size, runs in grouped:
            merged.setdefault(size, []).extend(runs)
        grouped = list(merged.items())
        chosen = configurations([s for s, _ in grouped], [sum(c for _, c in runs) for _, runs in grouped], capacity)
        kinds += substitute(grouped, chosen, capacity)
    plan, plain = best_fit(kinds, rest, min(small, capacity), capacity), best_fit([], counts, capacity, capacity)
    # Rounding down and the bounds of the linear program may cost what the scheme gains; best fit alone is the limit of that.
    return min(plan, plain, key=lambda kinds: sum(n for n, _, _ in kinds))


def plan_tables(plan: list[list], capacity: int) -> tuple[np.ndarray, ...]:
    """For each place of a kind: key (length, first rank), copies, first sequence, offset, sorted by key."""
    ranks = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for count, _, content in plan:
        offset = 0
        for length, copies in content:
            rows.append((length << 44 | int(ranks[length]), int(ranks[length]), copies, sequence, offset))
            ranks[length] += count * copies
            offset += length * copies
        sequence += count
    return tuple(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True))


def pack(docs: DataFrame, *, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, groups: int = GROUPS, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece. options: further ones of token_pieces."""
    pieces = materialise(token_pieces(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity, **options), "pieces")
    salts = 4 * input_partitions(docs)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    parts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in parts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    if not counts.any():
        return pieces.sparkSession.createDataFrame([], schema)
    keys, first, copies, sequence, offset = plan_tables(make_plan(counts, capacity=capacity, groups=groups), capacity)

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            number = rank - first[at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence[at] + number // copies[at]), pa.array(offset[at] + (number % copies[at]) * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)
