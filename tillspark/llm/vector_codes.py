"""Compression of vectors to codes: each of a few equal parts becomes the index of its nearest codebook entry.

Heap Lloyd. Vectors are cut into blocks, whose state is a row of a written table: the parts, and for each part position a heap per
entry of the parts it has, keyed by the slack between the lower bound on the distance to any other entry and the upper bound on the
distance to its own. When entries move, only their drift is added up; a round pops from an entry's heap the parts whose slack the
drift since then has used up, finds their nearest entries exactly, and pushes them where they belong. All others are known to stay.
Rounds send sums of what moved, at most one row for each entry and component from a task; the driver has the codebooks alone, whose
size is fixed by the parameters. A lost executor costs the blocks of its current round.

Defined results: rows whose vector is null, empty, or holds null or non-finite components are dropped, and so are those of another
length than the vector of the smallest id. That length must be a multiple of the parts. Rows with a null id are coded, but are no
first entries; rows that repeat an id are coded each, and are first entries in order of their vectors. With fewer rows than entries,
each is an entry. Entries that tie go to the lower index, and nulls are one label. Distances are exact in 64 bits; components too
large for that are an error. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, tidy

#: Vectors of a block.
BLOCK_ROWS = 8192
#: Taken from every slack against rounding of square roots.
MARGIN = 1e-6


def finite(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good, F.lit(False))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of x: the nearest entry, lower indexes first, and the exact squared distances to it and to the next."""
    most = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    width = x.shape[1] * (2 * most) ** 2
    if width >= 1 << 63:
        raise ValueError("components are too large for distances of 64 bits")
    which, first, second = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), np.zeros(len(x))
    step = 1024 if width < 1 << 52 else 64
    for a in range(0, len(x), step):
        part = x[a : a + step]
        if width < 1 << 52:  # whole numbers that doubles hold
            p, c = part.astype(float), book.astype(float)
            d = (p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)[None]
        else:
            d = ((part[:, None, :] - book[None]) ** 2).sum(2)
        rows = np.arange(len(part))
        i = d.argmin(1)
        which[a : a + step], first[a : a + step] = i, d[rows, i]
        d = d.astype(float)
        d[rows, i] = np.inf
        second[a : a + step] = d.min(1)
    return which, first, second


def _slack(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.sqrt(second) - np.sqrt(first.astype(float)) - MARGIN


class Heaps:
    """Heaps of one part position in a block: those of entry e are order[starts[e] : starts[e + 1]], with their keys."""

    def __init__(self, order: np.ndarray, keys: np.ndarray, starts: np.ndarray):
        self.order, self.keys, self.starts = order, keys, starts

    @classmethod
    def built(cls, entry: np.ndarray, keys: np.ndarray, entries: int) -> Heaps:
        order = np.lexsort((keys, entry))  # a sorted list is a heap
        return cls(order.astype("<i4"), keys[order], np.searchsorted(entry[order], np.arange(entries + 1)).astype("<i4"))

    def entry(self) -> np.ndarray:
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        return out

    def heap(self, e: int) -> list[tuple[float, int]]:
        a, b = self.starts[e], self.starts[e + 1]
        return list(zip(self.keys[a:b].tolist(), self.order[a:b].tolist(), strict=True))

    def advance(self, x: np.ndarray, book: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pop what the drift spent by each entry has violated and push it to its nearest entry. The parts popped, from, to."""
        changed: dict[int, list] = {}
        popped, came_from = [], []
        some = np.flatnonzero(np.diff(self.starts) > 0)
        for e in some[self.keys[self.starts[some]] <= spent[some]].tolist():
            heap = changed[e] = self.heap(e)
            while heap and heap[0][0] <= spent[e]:
                popped.append(heapq.heappop(heap)[1])
                came_from.append(e)
        parts = np.array(popped, np.int64)
        to, first, second = nearest(x[parts], book)
        for part, e, key in zip(popped, to.tolist(), (_slack(first, second) + spent[to]).tolist(), strict=True):
            if e not in changed:
                changed[e] = self.heap(e)
            heapq.heappush(changed[e], (key, part))
        if changed:
            order, keys, sizes = [], [], np.diff(self.starts)
            for e in range(len(sizes)):
                a, b = self.starts[e], self.starts[e + 1]
                if e in changed:
                    order.append(np.array([part for _, part in changed[e]], "<i4"))
                    keys.append(np.array([key for key, _ in changed[e]], float))
                    sizes[e] = len(changed[e])
                else:
                    order.append(self.order[a:b])
                    keys.append(self.keys[a:b])
            self.order, self.keys = np.concatenate(order), np.concatenate(keys)
            self.starts = np.append(0, np.cumsum(sizes)).astype("<i4")
        return parts, np.array(came_from, np.int64), to


def _moved(x: np.ndarray, to: np.ndarray, entries: int, sign: int, out: np.ndarray) -> None:
    """Add (or take) parts and their number to the sums of their entries: out has the sums by component, then the number."""
    order = np.argsort(to, kind="stable")
    at = np.flatnonzero(np.diff(to[order], prepend=-1))
    if len(at):
        out[to[order][at], :-1] += sign * np.add.reduceat(x[order], at)
        out[:, -1] += sign * np.bincount(to, minlength=entries)


def _state(label: T.DataType) -> T.StructType:
    lists = [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label))]
    binary = [T.StructField(c, T.BinaryType()) for c in ("parts", "order", "keys", "starts", "sums")]
    return T.StructType([*lists, *binary, T.StructField("popped", T.LongType())])


def _row(ids: pa.Array, labels: pa.Array, parts: np.ndarray, heaps: list[Heaps], sums: np.ndarray, popped: int) -> pa.RecordBatch:
    whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    packed = [parts.tobytes(), *(b"".join(getattr(h, k).tobytes() for h in heaps) for k in ("order", "keys", "starts")), sums.tobytes()]
    columns = [whole(ids), whole(labels), *(pa.array([b], pa.binary()) for b in packed), pa.array([popped], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "parts", "order", "keys", "starts", "sums", "popped"])


def _read(batch: pa.RecordBatch, k: int, books: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray, list[Heaps]]:
    """Ids, labels, parts [n, dim] and heaps of a block's row."""
    ids, labels = batch.column(0)[k].values, batch.column(1)[k].values
    n, (positions, entries, sub) = len(ids), books.shape
    raw = [np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in ((2, "<i8"), (3, "<i4"), (4, "<f8"), (5, "<i4"))]
    heaps = [Heaps(raw[1][p * n : (p + 1) * n], raw[2][p * n : (p + 1) * n], raw[3][p * (entries + 1) : (p + 1) * (entries + 1)]) for p in range(positions)]
    return ids, labels, raw[0].reshape(n, positions * sub), heaps


def _begin(books: np.ndarray, scale: int):
    """Blocks of scaled integers, every part assigned to its nearest entry."""
    positions, entries, sub = books.shape

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out():
            rows = pa.Table.from_batches(held).combine_chunks()
            flat = rows.column(1).chunk(0).flatten().to_numpy().astype(float)
            whole = np.floor(flat * scale).reshape(-1, positions * sub)
            if np.abs(whole).max(initial=0) >= 1 << 31:
                raise ValueError("components are too large for distances of 64 bits")
            parts = whole.astype(np.int64)
            heaps, sums = [], np.zeros((positions, entries, sub + 1), np.int64)
            for p in range(positions):
                x = parts[:, p * sub : (p + 1) * sub]
                to, first, second = nearest(x, books[p])
                heaps.append(Heaps.built(to, _slack(first, second), entries))
                _moved(x, to, entries, 1, sums[p])
            return _row(rows.column(0).chunk(0), rows.column(2).chunk(0), parts, heaps, sums, len(parts) * positions)

        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(a, BLOCK_ROWS))
                if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                    yield out()
                    held = []
        if held and any(b.num_rows for b in held):
            yield out()

    return run


def _advance(books: np.ndarray, spent: np.ndarray):
    """One round over blocks: heaps with entries that moved to `books`, and the sums that changed."""
    positions, entries, sub = books.shape

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels, parts, heaps = _read(batch, k, books)
                sums, popped = np.zeros((positions, entries, sub + 1), np.int64), 0
                for p in range(positions):
                    x = parts[:, p * sub : (p + 1) * sub]
                    seen, old, new = heaps[p].advance(x, books[p], spent[p])
                    popped += len(seen)
                    moved = old != new
                    _moved(x[seen[moved]], old[moved], entries, -1, sums[p])
                    _moved(x[seen[moved]], new[moved], entries, 1, sums[p])
                yield _row(ids, labels, parts, heaps, sums, popped)

    return run


@tidy
def _task_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's blocks: a row for each number that isn't zero."""
    total = None
    for batch in batches:
        for raw in batch.column(0):
            sums = np.frombuffer(raw.as_buffer(), "<i8")
            total = sums.copy() if total is None else total + sums
    if total is not None:
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])


def _codes(books: np.ndarray):
    """A row for each vector of a block: id, label, code and squared distance."""
    positions, _, sub = books.shape

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels, parts, heaps = _read(batch, k, books)
                entry = np.stack([h.entry() for h in heaps], 1)
                chosen = np.stack([books[p][entry[:, p]] for p in range(positions)], 1).reshape(parts.shape)
                digits = entry.astype(np.uint8).tobytes().hex()
                codes = [digits[i : i + 2 * positions] for i in range(0, len(digits), 2 * positions)]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(((parts - chosen) ** 2).sum(1))], ["vec_id", "label", "code", "error"])

    return run


def train(vectors: DataFrame, *, id_col: str, vector_col: str, label_col: str, parts: int, entries: int, rounds: int, scale: int) -> tuple[DataFrame | None, np.ndarray, list[int]]:
    """The blocks' last state, the codebooks [part, entry, component], and how many parts each round looked at."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: entries must be 1 to 256")
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_vector"), F.col(label_col).alias("_label")).where(finite(F.col("_vector")))
    named = rows.where("_id is not null").orderBy("_id", "_vector").select("_vector")
    if not (first := named.limit(1).collect()):
        return None, np.zeros((parts, 0, 0), np.int64), []
    dim = len(first[0][0])
    if dim % parts:
        raise ValueError(f"vectors of {dim} components have no {parts} equal parts")
    rows = rows.where(F.size("_vector") == dim)
    seeds = named.where(F.size("_vector") == dim).limit(entries).collect()
    whole = np.floor(np.array([s[0] for s in seeds], float) * scale)
    if np.abs(whole).max() >= 1 << 31:
        raise ValueError("components are too large for distances of 64 bits")
    books = np.ascontiguousarray(whole.astype(np.int64).reshape(-1, parts, dim // parts).transpose(1, 0, 2))
    schema = _state(vectors.schema[label_col].dataType)
    state = materialise(rows.mapInArrow(_begin(books, scale), schema), "code-state")
    sums = np.zeros((*books.shape[:2], dim // parts + 1), np.int64)
    spent, looked = np.zeros(books.shape[:2]), []
    for _ in range(rounds):
        changed = materialise(state.select("sums").mapInArrow(_task_sums, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")), "code-sums")
        for r in changed.collect():  # parts * entries * (components + 1) rows at most
            sums.reshape(-1)[r["at"]] += r["n"]
        looked.append(state.agg(F.sum("popped")).first()[0])
        n = sums[..., -1:]
        moved = np.where(n > 0, np.floor_divide(sums[..., :-1], np.maximum(n, 1)), books)
        drift = np.sqrt(((moved - books).astype(float) ** 2).sum(2))
        # What an entry's parts lose: its own drift, and the largest among the others'.
        largest = np.sort(drift, 1)[:, ::-1]
        others = np.where((drift == largest[:, :1]) & (np.arange(drift.shape[1]) == drift.argmax(1)[:, None]), largest[:, 1:2] if drift.shape[1] > 1 else 0, largest[:, :1])
        spent = spent + drift + others
        books = moved
        after = materialise(state.mapInArrow(_advance(books, spent), schema), "code-state")
        discard(state, changed)
        state = after
    looked.append(state.agg(F.sum("popped")).first()[0])
    return state, books, looked


def vector_codes(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> DataFrame:
    """Per vector: vec_id, code (two hex digits a part), error, label_error (of all vectors with its label), codebooks_sha256."""
    state, books, _ = train(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col, parts=parts, entries=entries, rounds=rounds, scale=scale)
    if state is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    label = vectors.schema[label_col].dataType.simpleString()
    coded = materialise(state.mapInArrow(_codes(books), f"vec_id long, label {label}, code string, error long"), "codes")
    discard(state)
    by_label = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
