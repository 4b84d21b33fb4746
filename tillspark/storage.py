"""Tables written in the folder that driver and executors share (spark.checkpoint.dir), and files of any store by their address."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset a local master gets a folder of its own, and a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        folder = "file://" + tempfile.mkdtemp(prefix="tillspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """The address of a new folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, and a lost executor loses nothing of it."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(address: str):
    """The file system and the path in it of a folder that driver and executors share; usable in both."""
    import pyarrow.fs

    return pyarrow.fs.FileSystem.from_uri(address if "://" in address else "file://" + address.removeprefix("file:"))


def exists(address: str) -> bool:
    import pyarrow.fs

    fs, path = store(address)
    return fs.get_file_info(path).type != pyarrow.fs.FileType.NotFound


def children(address: str) -> list[str]:
    """Names of the files and folders right below a folder; none where it doesn't exist."""
    import pyarrow.fs

    fs, path = store(address)
    found = fs.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found)


def put(fs, path: str, body: bytes) -> None:
    """A file that appears whole or not at all."""
    temporary = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary, compression=None) as out:
        out.write(body)
    fs.move(temporary, path)
