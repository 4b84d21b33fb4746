"""A data source that writes a file for each row, with commit and abort.

    df.write.format("row_files").mode("append").save(folder)      rows: folder string, name string, body string

A task writes its files to a staging folder of its own attempt, and its commit message says where that is and how many there are; so
what the driver hears doesn't grow with the rows. When all tasks have ended, the driver writes the list of the attempts that count, in
one file that appears whole. From then on the job is done, whatever happens: `publish` moves the files to their places, by as many
tasks as wrote them, and can be run again until nothing is left. Until then nothing is visible: a failed attempt's files, or those of
a job that was aborted, never leave the staging folder, which goes. Rows that repeat a name are an error of the caller; the last wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .. import storage

STAGING = "_staging"


@dataclass
class Staged(WriterCommitMessage):
    attempt: str
    files: int


class RowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "row_files"

    def schema(self) -> str:
        return "folder string, name string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("row_files only appends; a file that is there is replaced")
        if schema.fieldNames() != ["folder", "name", "body"]:
            raise ValueError("row_files takes the columns folder, name and body")
        return RowFilesWriter(self.options["path"], self.options.get("job") or uuid.uuid4().hex)


class RowFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self.staging = f"{path.rstrip('/')}/{STAGING}/{job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        attempt = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        fs, root = storage.store(f"{self.staging}/{attempt}")
        files, known = 0, set()
        for batch in batches:
            for folder, name, body in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if folder not in known:
                    fs.create_dir(f"{root}/{folder}", recursive=True)
                    known.add(folder)
                with fs.open_output_stream(f"{root}/{folder}/{name}", compression=None) as out:
                    out.write((body or "").encode())
                files += 1
        return Staged(attempt, files)

    def commit(self, messages: list[Staged | None]) -> None:
        fs, root = storage.store(self.staging)
        fs.create_dir(root, recursive=True)
        done = [{"attempt": m.attempt, "files": m.files} for m in messages if m is not None and m.files]
        storage.put(fs, f"{root}/committed.json", json.dumps(done).encode())

    def abort(self, messages: list[Staged | None]) -> None:
        if storage.exists(self.staging):
            fs, root = storage.store(self.staging)
            fs.delete_dir(root)


def publish(spark: SparkSession, path: str) -> int:
    """Move the files of committed jobs to their places; how many. Jobs that aren't committed are left alone."""
    path, moved = path.rstrip("/"), 0
    for job in storage.children(f"{path}/{STAGING}"):
        staging = f"{path}/{STAGING}/{job}"
        if not storage.exists(f"{staging}/committed.json"):
            continue
        fs, root = storage.store(staging)
        with fs.open_input_stream(f"{root}/committed.json") as f:
            attempts = json.loads(f.read())
        if attempts:
            rows = spark.createDataFrame([(a["attempt"],) for a in attempts], "attempt string").repartition(len(attempts), "attempt")
            moved += rows.mapInArrow(_mover(staging, path), "moved long").agg({"moved": "sum"}).first()[0]
        fs.delete_dir(root)
    return moved


def _mover(staging: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = 0
        for batch in batches:
            for attempt in batch.column(0).to_pylist():
                fs, source = storage.store(f"{staging}/{attempt}")
                _, target = storage.store(path)
                # What an earlier attempt of this task has moved is no longer listed.
                for info in fs.get_file_info(pyarrow.fs.FileSelector(source, recursive=True, allow_not_found=True)):
                    if info.type == pyarrow.fs.FileType.File:
                        place = f"{target}/{info.path.removeprefix(source).strip('/')}"
                        fs.create_dir(place.rpartition("/")[0], recursive=True)
                        fs.move(info.path, place)
                        moved += 1
        yield pa.RecordBatch.from_pydict({"moved": pa.array([moved], pa.int64())})

    return run


def discard_unfinished(path: str) -> None:
    """Remove the staging folders of jobs that died before they were committed. No job may be under way."""
    for job in storage.children(f"{path.rstrip('/')}/{STAGING}"):
        if not storage.exists(f"{path.rstrip('/')}/{STAGING}/{job}/committed.json"):
            fs, root = storage.store(f"{path.rstrip('/')}/{STAGING}/{job}")
            fs.delete_dir(root)


def write_files(rows: DataFrame, path: str) -> int:
    """One file below path for each row (folder, name, body); the number of files. All of them appear, or none."""
    spark = rows.sparkSession
    spark.dataSource.register(RowFiles)
    rows.select("folder", "name", "body").write.format("row_files").mode("append").option("job", uuid.uuid4().hex).save(path)
    return publish(spark, path)
