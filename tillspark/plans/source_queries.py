"""Sources and sinks as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions import text as T
from ..sources import events, files, journal, providers, store
from .derive import derived, duck, ocr_texts
from .registry import query

SOURCES = """, s AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN 'https://drive.google.com/file/d/ID' || page_id || '/view?usp=x' WHEN 1 THEN url WHEN 2 THEN 'https://drive.google.com/drive/folders/F' || page_id ELSE '/data/scan' || page_id || CASE WHEN page_id % 8 = 3 THEN '.PNG' ELSE '.csv' END END AS source FROM pages)"""


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("page_id").cast("string")
    k = F.col("page_id") % 4
    local = F.concat(F.lit("/data/scan"), p, F.when(F.col("page_id") % 8 == 3, ".PNG").otherwise(".csv"))
    source = F.when(k == 0, F.concat(F.lit("https://drive.google.com/file/d/ID"), p, F.lit("/view?usp=x"))).when(k == 1, F.col("url")).when(k == 2, F.concat(F.lit("https://drive.google.com/drive/folders/F"), p)).otherwise(local)
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", source.alias("source"))


@query("WITH x AS (SELECT 1)" + SOURCES + r""", n AS (SELECT *, split_part(regexp_extract(source, '^[^?#]*'), '/', -1) AS base FROM s), e AS (SELECT *, lower(regexp_extract(base, '.(\.[^.]+)$', 1)) AS ext FROM n)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'drive' WHEN 1 THEN 'url' WHEN 2 THEN 'folder' ELSE 'path' END AS kind, CASE WHEN page_id % 4 = 0 THEN 'https://drive.google.com/uc?export=download&id=ID' || page_id ELSE source END AS url,
CASE WHEN ext IN ('.jpg', '.jpeg', '.png', '.webp', '.heic', '.tiff', '.tif', '.bmp') THEN base ELSE regexp_replace(base, '(.)\.[^.]*$', '\1') || '.jpg' END AS name, ext IN ('.jpg', '.jpeg', '.png', '.webp', '.heic', '.tiff', '.tif', '.bmp') AS image FROM e""")
def s01_f06_sources(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("source")
    bare = F.regexp_extract(s, r"^[^?#]*", 0)
    return _sources(spark, sf).select("page_id", files.source_kind(s).alias("kind"), files.direct_url(s).alias("url"), files.image_name(s).alias("name"), files.is_image(bare).alias("image"))


#: Every log row as one of the five kinds, by its number.
FIVE = ["adi_ocr", "llm_extraction", "pipeline_complete", "mcp_upload", "mcp_delete"]


@query(duck("logs") + """, k AS (SELECT *, event_id % 5 AS n FROM logs)
SELECT event_id, ['adi_ocr', 'llm_extraction', 'pipeline_complete', 'mcp_upload', 'mcp_delete'][CAST(n + 1 AS int)] AS event, CASE WHEN success THEN 'INFO' WHEN n >= 3 THEN 'WARN' ELSE 'ERROR' END AS level,
(latency_ms + 0.2)::DOUBLE AS latency_ms, CASE WHEN n = 1 THEN input_tokens + output_tokens END AS total_tokens, CASE WHEN n = 1 THEN provider WHEN n = 2 THEN provider END AS provider,
CASE n WHEN 0 THEN round(input_tokens * 0.0015::DOUBLE, 6) WHEN 1 THEN round(input_tokens * 0.00000125::DOUBLE, 8) END AS cost, CAST(CASE WHEN n = 3 AND success THEN 201 WHEN n = 4 AND success THEN 200 END AS int) AS status, CASE n WHEN 3 THEN items_extracted - items_extracted // 3 END AS items_uploaded FROM k""")
def k03_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, "logs").withColumns({"raw_ms": F.col("latency_ms") + F.lit(0.25), "lost": F.expr("items_extracted div 3")})
    made = []
    for n, kind in enumerate(FIVE):
        own = rows.where(F.col("event_id") % 5 == n).select(
            "event_id", "time", "trace_id", "image_name", "success", F.col("success").alias("ocr_success"), F.col("success").alias("llm_success"),
            F.col("provider").alias("llm_provider"), F.col("model").alias("llm_model"), F.col("input_tokens").alias("llm_input_tokens"), F.col("output_tokens").alias("llm_output_tokens"),
            (F.col("input_tokens") * F.lit(0.0015)).alias("cost_usd"), (F.col("input_tokens") * F.lit(0.00000125)).alias("llm_cost_usd"),
            *[F.col("raw_ms").alias(c) for c in ("ocr_latency_ms", "llm_latency_ms", "total_latency_ms", "latency_ms")],
            F.col("items_extracted").alias("items_attempted"), F.col("lost").alias("items_failed"), (F.col("items_extracted") - F.col("lost")).alias("items_uploaded"),
        )
        made.append(events.built(own, kind, time=F.col("time"), keep=("event_id",)))
    every = reduce(DataFrame.unionByName, made)
    latency = F.coalesce("ocr_latency_ms", "llm_latency_ms", "total_latency_ms", "latency_ms")
    return every.select(
        "event_id", "event", "level", latency.alias("latency_ms"), F.col("usage.total_tokens").alias("total_tokens"), F.col("llm_provider").alias("provider"),
        F.coalesce("cost_usd", "cost.total_usd").alias("cost"), "status", "items_uploaded",
    )


@query(duck("logs") + """, u AS (SELECT replace(image_name, '.jpg', '') AS image_stem, arg_max(trace_id, event_id) AS id FROM logs GROUP BY 1), r AS (SELECT 'img' || i AS image_stem, 'old' AS id FROM range(0, 60, 7) t(i))
SELECT coalesce(u.image_stem, r.image_stem) AS image_stem, coalesce(u.id, r.id) AS id FROM u FULL JOIN r ON u.image_stem = r.image_stem""")
def k05_registry(spark: SparkSession, sf: str) -> DataFrame:
    uploads = derived(spark, sf, "logs").select(T.file_stem(F.col("image_name")).alias("image_stem"), F.array("trace_id").alias("ids"), F.col("event_id").alias("seq"))
    old = spark.range(0, 60, 7).select(F.concat(F.lit("img"), F.col("id").cast("string")).alias("image_stem"), F.array(F.lit("old")).alias("ids"))
    return files.registry_upsert(old, uploads).select("image_stem", F.col("ids")[0].alias("id"))


#: Log events as recorded attempts: a request is an image and a model, its answer the trace that got one.
ATTEMPTS = """, a AS (SELECT image_name || ' ' || model AS request, event_id AS place, success AS ok, CASE WHEN success THEN trace_id END AS answer, CASE WHEN NOT success THEN 'failed in ' || trace_id END AS error FROM logs WHERE event = 'llm_extraction'),
r AS (SELECT request, bool_or(ok) AS ok, arg_min(answer, place) FILTER (WHERE ok) AS answer, count(*)::INT AS attempts, arg_max(error, place) FILTER (WHERE NOT ok) AS last FROM a GROUP BY request)"""


def _attempts(spark: SparkSession, sf: str) -> DataFrame:
    rows, ok = derived(spark, sf, "logs").where("event = 'llm_extraction'"), F.col("success")
    request = F.concat_ws(" ", "image_name", "model")
    return rows.select(request.alias("request"), F.col("event_id").cast("double").alias("at"), F.lit(0).alias("place"), ok.alias("ok"), F.when(ok, F.col("trace_id")).alias("answer"), F.when(~ok, F.concat(F.lit("failed in "), "trace_id")).alias("error"))


@query(duck("logs") + ATTEMPTS + """ SELECT request, ok, answer, attempts, CASE WHEN NOT ok THEN last END AS error FROM r""")
def s07_c03_journal(spark: SparkSession, sf: str) -> DataFrame:
    """A journal replayed: what each request got in all its attempts."""
    return journal.resolve(_attempts(spark, sf), ["request"])


@query(duck("logs") + ATTEMPTS + """ SELECT DISTINCT image_name || ' ' || model AS request FROM logs WHERE image_name || ' ' || model NOT IN (SELECT request FROM r WHERE ok OR attempts >= 3)""")
def k04_unanswered(spark: SparkSession, sf: str) -> DataFrame:
    """What a run has to ask yet: requests of all events without a good answer and with fewer than three attempts."""
    asked = derived(spark, sf, "logs").select(F.concat_ws(" ", "image_name", "model").alias("request"))
    return journal.unanswered(asked, _attempts(spark, sf), ["request"])


@query(duck("logs") + """ SELECT replace(image_name, '.jpg', '') AS image_stem, arg_max(trace_id, event_id) AS id FROM logs GROUP BY 1""")
def k05_store(spark: SparkSession, sf: str) -> DataFrame:
    """The registry as a store: the first half of the events, then all of the later half in a second upsert."""
    rows = derived(spark, sf, "logs").select(T.file_stem(F.col("image_name")).alias("image_stem"), F.array("trace_id").alias("ids"), "event_id")
    registry = store.upload_registry(spark, storage.fresh(spark, "registry"))
    middle = rows.agg(F.avg("event_id")).first()[0]
    for half in (F.col("event_id") <= middle, F.col("event_id") > middle):
        registry.upsert(rows.where(half), order="event_id")
    return registry.read().select("image_stem", F.col("ids")[0].alias("id"))


@query("""SELECT '| r_regionkey | r_name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_regionkey || ' | ' || r_name || ' |', chr(10) ORDER BY r_regionkey) AS report FROM region""")
def k06_markdown(spark: SparkSession, sf: str) -> DataFrame:
    return files.markdown_table(spark.read.parquet(f"{sf}/region.parquet"), ["r_regionkey", "r_name"], order=["r_regionkey"])


@query(duck("logs") + """ SELECT DISTINCT image_name FROM logs WHERE event = 'adi_ocr' AND image_name NOT IN (SELECT image_name FROM logs WHERE event = 'llm_extraction' AND event_id % 5 = 0)""")
def j11_s07_cache_misses(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, "logs")
    cache = rows.where("event = 'llm_extraction' and event_id % 5 = 0").select(F.col("image_name").alias("stem"))
    return files.missing_from_cache(rows.where("event = 'adi_ocr'").select(F.col("image_name").alias("stem")).distinct(), cache).withColumnRenamed("stem", "image_name")


@query(duck("ocr_lines", "items") + r""", a AS (SELECT receipt_id, coalesce(string_agg(trim(line), ' ' ORDER BY line_idx) FILTER (WHERE NOT regexp_matches(line, 'Dir |Mgr |Main:|Rx:|Phone:|Tel:|Manager|\(\d{3}\) \d{3}-\d{4}')), '') AS address FROM ocr_lines GROUP BY receipt_id),
s AS (SELECT receipt_id, min(store) AS store FROM items GROUP BY receipt_id), k AS (SELECT a.receipt_id, trim(split_part(store, ' ', 1) || ' ' || trim(replace(address, 'Store 2216', ''))) AS query FROM a JOIN s ON s.receipt_id = a.receipt_id)
SELECT receipt_id, query, CASE WHEN length(query) % 2 = 0 THEN CAST(length(query) AS double) END AS latitude FROM k""")
def e01_geocode(spark: SparkSession, sf: str) -> DataFrame:
    stores = derived(spark, sf, "items").groupBy("receipt_id").agg(F.min("store").alias("store"))
    receipts = ocr_texts(spark, sf).withColumn("address", T.raw_part(F.col("ocr"))).join(stores, "receipt_id")
    asked = T.strip(F.concat_ws(" ", T.first_word(F.col("store")), T.address_for_geocoder(F.col("address"))))
    places = receipts.select(asked.alias("query")).distinct().where(F.length("query") % 2 == 0).select("query", F.length("query").cast("double").alias("latitude"), F.lit(0.0).alias("longitude"))
    return providers.geocode(receipts, places).select("receipt_id", "query", "latitude")


@query(duck("items") + r""", c AS (SELECT *, regexp_matches(price, '\d') AS priced FROM items) SELECT receipt_id, item_idx, CASE WHEN priced THEN price ELSE CAST(item_idx AS varchar) || '.50' || currency END AS price FROM c WHERE priced OR item_idx % 20 = 0""")
def c07_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, "items")
    answers = rows.where("item_idx % 20 = 0").select("receipt_id", "item_idx", F.concat(F.lit("about "), F.col("item_idx").cast("string"), F.lit(".5 dollars")).alias("answer"))
    return providers.repair_prices(rows, answers).select("receipt_id", "item_idx", "price")
