"""A keyed store with copy-on-write buckets: last write wins, readers see whole versions only.

Keys are hashed to buckets. An upsert rewrites the buckets it touches into a folder of its own and then puts one manifest in the place
of the old one, which says which folder holds each bucket; until that moment readers see the store as it was, and a writer that dies
before has changed nothing. A bucket whose files can't be read is empty, and its keys come back as they are written again. There is
one writer at a time; the manifest's version says so where there were two.

    root/manifest.json     {"version": 3, "buckets": {"0": "v1-...", "5": "v3-..."}}
    root/v3-.../bucket=5/  rows of a bucket (Parquet)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage


class KeyedStore:
    """Rows by a string key. schema: the other columns, as "name type, ..."."""

    def __init__(self, spark: SparkSession, root: str, key: str, schema: str, buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.schema = f"{key} string, {schema}"

    def _manifest(self) -> dict:
        if not storage.exists(f"{self.root}/manifest.json"):
            return {"version": 0, "buckets": {}}
        fs, path = storage.store(f"{self.root}/manifest.json")
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def _read(self, held: dict[str, str]) -> DataFrame:
        folders = [f"{self.root}/{folder}/bucket={b}" for b, folder in held.items() if storage.exists(f"{self.root}/{folder}/bucket={b}")]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
        return reader.parquet(*folders)

    def read(self) -> DataFrame:
        """All rows of the current version."""
        return self._read(self._manifest()["buckets"])

    def upsert(self, rows: DataFrame, *, order: str) -> int:
        """Put rows in the place of those with their keys; of rows with one key the one with the largest `order` counts. The new version."""
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rest = [c for c in self.spark.createDataFrame([], self.schema).columns if c != self.key]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), order).alias("_r"))
        new = storage.written(last.select(self.key, *[F.col(f"_r.{c}").alias(c) for c in rest]).where(F.col(self.key).isNotNull()).withColumn("bucket", bucket), "upsert")
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most `buckets`
        manifest = self._manifest()
        if not touched:
            return manifest["version"]
        old = self._read({str(b): manifest["buckets"][str(b)] for b in touched if str(b) in manifest["buckets"]})
        kept = old.join(new.select(self.key), self.key, "left_anti").withColumn("bucket", bucket)
        folder = f"v{manifest['version'] + 1}-{uuid.uuid4().hex}"
        both = kept.unionByName(new).repartition(len(touched), "bucket")
        both.write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        return self._switch(manifest, folder, touched)

    def _switch(self, before: dict, folder: str, touched: list[int]) -> int:
        if self._manifest()["version"] != before["version"]:
            raise RuntimeError("another writer has changed the store")
        after = {"version": before["version"] + 1, "buckets": before["buckets"] | {str(b): folder for b in touched}}
        fs, root = storage.store(self.root)
        storage.put(fs, f"{root}/manifest.json", json.dumps(after).encode())
        return after["version"]

    def clean(self) -> None:
        """Remove folders that the manifest doesn't name: older versions and what died half-way. No reader or writer may be at work."""
        named = set(self._manifest()["buckets"].values())
        for name in storage.children(self.root):
            if name.startswith("v") and name not in named:
                fs, path = storage.store(f"{self.root}/{name}")
                fs.delete_dir(path)


def upload_registry(spark: SparkSession, root: str) -> KeyedStore:
    """K5: image_stem -> ids of what was uploaded of it."""
    return KeyedStore(spark, root, "image_stem", "ids array<string>")
