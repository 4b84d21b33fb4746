"""Shared storage, identifiers and small helpers of the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[tuple[SparkSession, str]] = []
_tables: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a folder of its own (tests); on a cluster that is an error, since executors would write
    to their own disks.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        conf = "file://" + tempfile.mkdtemp(prefix="tillspark-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, removed by discard() or when the driver's process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # the session may have ended before the process; another one may not have
            continue


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop objects of the driver."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


#: While a table is written: what was shuffled for it isn't needed afterwards, and Python workers get batches of bounded size.
WRITING = {
    CLEAN_UP: "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder as Parquet and read it back.

    Lost executors lose nothing of what was written, and later stages see its true size.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = {k: spark.conf.get(k, None) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    _tables[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of materialise() that nothing reads any more."""
    for df in tables:
        if path := _tables.pop(df, None):
            remove(df.sparkSession, path)
            _written[:] = [w for w in _written if w[1] != path]


_slot: dict = {}


def worker_slot(key, make=lambda: None):
    """What a Python worker keeps between tasks: one operator's model and caches at a time.

    Workers are reused by later stages, so what the last operator remembered goes when another one starts.
    """
    if key not in _slot:
        _slot.clear()
        release()
        _slot[key] = make()
    return _slot[key]


def release() -> None:
    """Give back to the system what a Python worker no longer needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function over batches that releases memory at the end of its task, since idle workers stay beside the next stage."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


#: Bits of the filter that narrowed() broadcasts, 64 to a row: a table of 131,072 rows at most, about 5 MB, whatever the input.
FILTER_BITS = 1 << 23


def narrowed(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """df without most of the rows whose long key isn't among those of wanted (one column), by a filter of bounded size.

    A join with wanted has to follow. Where wanted is large against FILTER_BITS the filter lets more and more pass, so it saves
    less shuffling but loses nothing. Null keys don't pass.
    """
    bit = F.pmod(F.xxhash64(F.col(key)), F.lit(FILTER_BITS))
    word, mask = F.floor(bit / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    asked = wanted.select(F.col(wanted.columns[0]).cast("long").alias(key)).where(F.col(key).isNotNull())
    table = asked.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_masks"))
    there = df.withColumn("_word", word).join(F.broadcast(table), "_word").where(F.col("_masks").bitwiseAND(mask) != 0)
    return there.select(*df.columns)


def input_partitions(df: DataFrame, *, at_least: int = 1) -> int:
    """Shuffle partitions to use for df: the session's setting, which the cluster sizes for its data."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def small_batches(batches: Iterator[pa.RecordBatch], columns: list[str], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slice record batches so that the named string columns of a slice hold about most_bytes at most.

    A single longer row forms a slice of its own: texts are never cut.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        total = sum(batch.column(c).nbytes for c in columns)
        if total <= most_bytes:
            yield batch
            continue
        sizes = [0] * n
        for c in columns:
            for i, v in enumerate(pc.binary_length(batch.column(c)).to_pylist()):
                sizes[i] += v or 0
        start = held = 0
        for i, v in enumerate(sizes):
            if i > start and held + v > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += v
        yield batch.slice(start)


class Remembered:
    """What a worker remembers of strings: a run of 32-bit numbers for each, in columns of at most about most_bytes.

    Places in the columns hold until the next trim().
    """

    def __init__(self, most_bytes: int):
        self.most_bytes = most_bytes
        self.keys = pa.array([], pa.string())
        self.numbers = np.zeros(0, "<u4")
        self.ends = np.zeros(1, np.int64)

    def trim(self) -> None:
        """Forget the later half: frequent strings come early in any text, so most of them stay."""
        if self.keys.nbytes + self.numbers.nbytes + self.ends.nbytes > self.most_bytes:
            n = len(self.keys) // 2
            self.keys = pa.concat_arrays([self.keys.slice(0, n)])
            self.ends = self.ends[: n + 1].copy()
            self.numbers = self.numbers[: self.ends[-1]].copy()

    def find(self, keys: pa.Array) -> np.ndarray:
        """The place of each key, or -1."""
        return pc.fill_null(pc.index_in(keys, value_set=self.keys), -1).to_numpy(zero_copy_only=False)

    def add(self, keys: pa.Array, numbers: np.ndarray, sizes: np.ndarray) -> None:
        """New keys with sizes[k] of the numbers each, in order."""
        self.keys = pa.concat_arrays([self.keys, keys])
        self.numbers = np.concatenate([self.numbers, numbers])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int64)])

    def sizes(self, places: np.ndarray) -> np.ndarray:
        return self.ends[places + 1] - self.ends[places]

    def gather(self, places: np.ndarray) -> np.ndarray:
        """The numbers at these places, one run after the other."""
        n = self.sizes(places)
        total = int(n.sum())
        if not total:
            return self.numbers[:0]
        shift = (self.ends[places] - np.cumsum(n) + n).astype(np.int32)
        at = np.repeat(shift, n)
        at += np.arange(total, dtype=np.int32)
        return self.numbers[at]
