"""A column of mixed sources to names and bytes: local and object paths by their file systems, addresses by a given function.

Sources are filtered by name first, so what is no image is never opened; then their sizes are looked up and they are dealt to tasks by
size, large ones to tasks of their own. What can't be read is a row with an error, not a failed job. Nothing passes through the driver
but the total size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions import fixed as X
from . import files

#: Bytes that a task reads, about.
TASK_BYTES = 64 << 20
KINDS = ("url", "drive")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size or error of each path; addresses are left for later."""
    for batch in batches:
        sizes, errors = [], []
        for source, kind in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            size = error = None
            if kind == "path":
                try:
                    fs, path = storage.store(source)
                    info = fs.get_file_info(path)
                    size = info.size
                    error = None if info.type == pyarrow.fs.FileType.File else f"File not found: {source}"
                except Exception as e:  # an unknown scheme, or no access
                    error = f"{type(e).__name__}: {e}"
            elif kind == "folder":
                error = "a folder has no bytes of its own"
            sizes.append(size)
            errors.append(error)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sizes, pa.int64()), pa.array(errors, pa.string())], ["_key", "source", "kind", "name", "size", "error"])


def _reader(fetch: Callable[[str], bytes] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a row at a time: its bytes may be many
                key, source, kind, name, _, error = (batch.column(c)[k].as_py() for c in range(6))
                content = None
                if error is None:
                    try:
                        if kind in KINDS:
                            if fetch is None:
                                raise ValueError("no service fetches addresses")
                            content = fetch(source)
                        else:
                            fs, path = storage.store(source)
                            with fs.open_input_stream(path, compression=None) as f:
                                content = f.read()
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pydict({"_key": pa.array([key]), "name": pa.array([name], pa.string()), "content": pa.array([content], pa.large_binary()).cast(pa.binary()), "error": pa.array([error], pa.string())})

    return run


def read_sources(rows: DataFrame, source: str = "source", *, fetch: Callable[[str], bytes] | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """source, name, content and error of each distinct source of the column. fetch: an address, rewritten for download, to its bytes.

    Names are those of image_name(); a path whose name has no image extension is an error without being opened.
    """
    s = F.col("source")
    asked = rows.select(F.col(source).alias("source")).distinct().withColumn("kind", files.source_kind(s))
    own_name = F.element_at(F.split(F.regexp_extract(s, r"^[^?#]*", 0), "/"), -1)
    fit = s.isNotNull() & ((F.col("kind") != "path") | files.is_image(own_name))
    bare = asked.where(fit).select(F.xxhash64("source").alias("_key"), files.direct_url(s).alias("_at"), "kind", files.image_name(s).alias("name"), "source")
    sized = storage.written(bare.select("_key", F.col("_at").alias("source"), "kind", "name").mapInArrow(_sizes, "_key long, source string, kind string, name string, size long, error string"), "sizes")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // task_bytes), sized.sparkSession.sparkContext.defaultParallelism)
    part = F.when(F.col("size") > task_bytes, F.col("_key")).otherwise(F.pmod("_key", F.lit(tasks)))
    read = sized.repartition(tasks, part).mapInArrow(_reader(fetch), "_key long, name string, content binary, error string")
    found = read.join(bare.select("_key", "source"), "_key").select("source", "name", "content", "error")
    kinds = ", ".join(X.IMAGE_EXTENSIONS)
    other = asked.where(~fit | fit.isNull()).select("source", own_name.alias("name"), F.lit(None).cast("binary").alias("content"), F.when(s.isNull(), "no source").otherwise(F.lit(f"not an image: {kinds} are")).alias("error"))
    return found.unionByName(other)

