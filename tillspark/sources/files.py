"""Readers and writers: images, event logs, ground truth, OCR cache, receipts, upload registry, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions import fixed as X
from ..functions import text as T
from ..schemas import FLAT_ITEM, LOG_EVENT
from . import sink


def source_kind(source: Column) -> Column:
    """S1: "folder", "drive", "url" or "path"."""
    return (
        F.when(source.rlike(r"drive\.google\.com/drive/(?:u/\d+/)?folders/"), "folder").when(source.rlike(r"drive\.google\.com/file/d/"), "drive").when(source.rlike(r"^https?://"), "url").otherwise("path")
    )


def direct_url(source: Column) -> Column:
    """A Drive viewer address becomes one that downloads."""
    file_id = F.regexp_extract(source, r"drive\.google\.com/file/d/([^/?]+)", 1)
    return F.when(file_id != "", F.concat(F.lit("https://drive.google.com/uc?export=download&id="), file_id)).otherwise(source)


def image_name(source: Column) -> Column:
    """The name of what a source points at, with .jpg where it has no image extension."""
    name = F.element_at(F.split(F.regexp_extract(source, r"^[^?#]*", 0), "/"), -1)
    return F.when(T.file_suffix(name).isin(X.IMAGE_EXTENSIONS), name).otherwise(F.concat(T.file_stem(name), F.lit(X.DEFAULT_EXTENSION)))


def is_image(name: Column) -> Column:
    """F6."""
    return T.file_suffix(name).isin(X.IMAGE_EXTENSIONS)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Path, name, content of the images of a folder (with its folders below) or of one file.

    Other files are left out by name, before any is read. Rows have no order; sort paths where one is wanted, not contents.
    """
    endings = ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e) for e in X.IMAGE_EXTENSIONS)
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{{{endings}}}").load(path)
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """The events of etl_*.jsonl, and of what write_logs wrote, below path; blank and malformed lines are dropped."""
    lines = spark.read.schema(LOG_EVENT).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true")
    return lines.option("pathGlobFilter", "{etl_*.jsonl,part-*.json}").json(path)


def write_logs(events: DataFrame, path: str) -> None:
    """K2: events appended as JSON lines, in folders by UTC day."""
    events.withColumn("event_date", F.substring("time", 1, 10)).write.mode("append").partitionBy("event_date").json(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Stem, status and items of the JSON files below path, one receipt each; a bare object counts as a list of one, an empty file has none."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(path).withColumn("_name", F.element_at(F.split("path", "/"), -1))
    body = T.strip(F.coalesce(F.decode("content", "UTF-8"), F.lit("")))
    listed = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    item = f"array<struct<{', '.join(':'.join(f.split()) for f in FLAT_ITEM.split(', '))}>>"
    filled = rows.select(T.file_stem(F.col("_name")).alias("stem"), F.when(body == "", "empty").otherwise("filled").alias("status"), F.from_json(listed, item).alias("items"))
    none = [(name,) for name in _empty_files(spark, path) if name.endswith(".json")]
    empty = spark.createDataFrame(none, "name string").select(T.file_stem(F.col("name")).alias("stem"), F.lit("empty").alias("status"), F.lit(None).cast(item).alias("items"))
    return filled.unionByName(empty)


def _empty_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files without content below path, which Spark's readers skip; a listing of metadata, as those make too."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(folder, True)
    found = []
    while listed.hasNext():
        status = listed.next()
        if status.getLen() == 0:
            found.append(status.getPath().getName())
    return found


def receipt_files(flat: DataFrame, *, provider: str, model: Column) -> DataFrame:
    """K1: folder (<provider>-<model>), name (<stem>.json) and body (a list of its flat items, in order) of each receipt's file.

    Rows: stem, item_idx and the output columns. A row whose item_idx is null stands for a receipt without items.
    """
    columns = [c.split()[0] for c in FLAT_ITEM.split(", ")]
    item = F.when(F.col("item_idx").isNotNull(), F.struct("item_idx", F.struct(*columns).alias("i")))
    folder = F.concat(F.lit(provider + "-"), T.model_slug(model))
    lists = flat.groupBy(folder.alias("folder"), "stem").agg(F.array_sort(F.collect_list(item)).alias("l"))
    return lists.select("folder", F.concat("stem", F.lit(".json")).alias("name"), F.to_json("l.i", {"ignoreNullFields": "false"}).alias("body"))


def write_receipts(flat: DataFrame, path: str, *, provider: str, model: Column) -> int:
    """K1: a file for each receipt below path, all of them or none; the number of files. Other files stay. The path is one that driver
    and executors share."""
    return sink.write_files(receipt_files(flat, provider=provider, model=model), path)


def write_ocr_cache(texts: DataFrame, path: str) -> int:
    """New texts (stem, text) as <stem>.txt of the cache."""
    return sink.write_files(texts.select(F.lit("").alias("folder"), F.concat("stem", F.lit(".txt")).alias("name"), F.col("text").alias("body")), path)


def read_ocr_cache(spark: SparkSession, path: str) -> DataFrame:
    """Stem and text of the cache's files; a cache that doesn't exist has none."""
    if not storage.exists(path):
        return spark.createDataFrame([], "stem string, text string")
    rows = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    return rows.select(T.file_stem(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).alias("stem"), F.col("value").alias("text"))


def missing_from_cache(pages: DataFrame, cache: DataFrame, *, use_cache: bool = True) -> DataFrame:
    """Pages whose name has no OCR text yet."""
    return pages.join(cache.select("stem").distinct(), "stem", "left_anti") if use_cache else pages


def registry_upsert(registry: DataFrame, uploads: DataFrame) -> DataFrame:
    """K5: the last upload of each image stem. registry: image_stem, ids; uploads: image_stem, ids, seq."""
    both = registry.withColumn("seq", F.lit(-1).cast("long")).unionByName(uploads.withColumn("seq", F.col("seq").cast("long")))
    return both.groupBy("image_stem").agg(F.max_by("ids", "seq").alias("ids"))


def content_type(name: Column) -> Column:
    """S8's map from extension to content type; what isn't listed counts as JPEG."""
    suffix = T.file_suffix(name)
    kinds = F.when(suffix.isin(".tif", ".tiff"), "image/tiff")
    for kind in ("png", "webp", "bmp"):
        kinds = kinds.when(suffix == f".{kind}", f"image/{kind}")
    return kinds.otherwise("image/jpeg")


def markdown_table(rows: DataFrame, columns: list[str], *, order: list[str]) -> DataFrame:
    """K6: one row, `report`: a small result as a Markdown table."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("—")) for c in columns]), F.lit(" |"))
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))), lambda s: s["line"]), "\n")
    return rows.agg(F.concat(F.lit(head), body).alias("report"))
