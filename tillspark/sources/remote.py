"""Images of a remote folder as a Spark data source (S3): one partition per file, fetched where it is read.

The two calls that a service needs are functions named by options, "module:function": `lister(folder, token)` gives
(id, name, mime type) of the folder's files, `fetcher(id, token)` gives a file's bytes. Only images by name or mime type are read.
A fetch that fails gives a row with the reason in `error`, not a failed job.

    spark.dataSource.register(RemoteImages)
    spark.read.format("remote_images").option("folder", F).option("lister", "m:f").option("fetcher", "m:g").load()
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import fixed as X

SCHEMA = "id string, name string, content binary, error string"


def _named(path: str):
    module, _, function = path.partition(":")
    return getattr(importlib.import_module(module), function)


class FilePartition(InputPartition):
    def __init__(self, file_id: str, name: str):
        super().__init__(file_id)
        self.name = name


class RemoteImages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "remote_images"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RemoteImagesReader(self.options)


class RemoteImagesReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.token = options.get("folder", ""), options.get("token")
        self.lister, self.fetcher = options["lister"], options["fetcher"]

    def partitions(self) -> list[FilePartition]:
        listed = _named(self.lister)(self.folder, self.token)
        images = [(i, n) for i, n, mime in listed if (mime or "").startswith("image/") or any(n.lower().endswith(x) for x in X.IMAGE_EXTENSIONS)]
        return [FilePartition(i, n) for i, n in sorted(images, key=lambda x: x[1])] or [FilePartition("", "")]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        if not partition.value:
            return
        try:
            yield partition.value, partition.name, _named(self.fetcher)(partition.value, self.token), None
        except Exception as e:  # a failed download is a row
            yield partition.value, partition.name, None, f"{type(e).__name__}: {e}"
