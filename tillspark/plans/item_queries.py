"""Item operators as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import similarity as S
from ..functions import text as T
from ..operators import chunks, items
from .derive import derived, duck, ocr_texts
from .registry import query
from .text_queries import q

VALID = rf""", named AS (SELECT *, trim(name) AS n0 FROM items),
product AS (
    SELECT *, coalesce(nullif(trim(regexp_replace(trim(regexp_replace(n0, '(?i)^\(sale\)\s+', '')), '^\d{{4,}}\s+', '')), ''), trim(regexp_replace(n0, '(?i)^\(sale\)\s+', ''))) AS n1,
           CAST(round(try_cast(nullif(regexp_extract(price, '\d+\.?\d*'), '') AS decimal(20, 6)) * 100) AS bigint) AS c,
           nullif(regexp_extract(price, '\d+\.?\d*'), '') AS digits, regexp_replace(trim(amount), '^(\d+\.\d{{2}})\s*[A-Za-z]$', '\1') AS a
    FROM named WHERE n0 <> '' AND length(n0) BETWEEN 3 AND 100 AND NOT regexp_matches(n0, {q(X.NON_PRODUCT)}) AND NOT regexp_matches(n0, {q(X.JUNK_NAME)})
      AND NOT regexp_matches(n0, '^[\d\s\.\,\-]+$') AND NOT regexp_matches(n0, {q(X.METADATA_NAME)})
), valid AS (
    SELECT receipt_id, item_idx, store, purchase_date, currency, n1 AS name, code,
           CASE WHEN c IS NULL AND regexp_matches(a, '^\d+\.\d{{2}}$') THEN a || currency WHEN c IS NOT NULL THEN CAST(c // 100 AS varchar) || '.' || lpad(CAST(c % 100 AS varchar), 2, '0') || currency ELSE price END AS price,
           coalesce(nullif(CASE WHEN regexp_matches(a, '^\d+\.\d{{2}}$') THEN '' ELSE trim(regexp_replace(a, {q(X.UNIT_CODES)}, '', 'g')) END, ''), '1') AS amount
    FROM product WHERE digits IS NULL OR coalesce(try_cast(digits AS decimal(38, 18)) BETWEEN 0.5 AND 99, false))"""
FLAT = rf""", flat AS (SELECT * FROM valid WHERE regexp_matches(price, '^\d+\.\d{{2}}[A-Z]{{3}}$') AND NOT regexp_matches(name, {q(X.FLAT_NON_PRODUCT)}) AND NOT (name = lower(name) AND regexp_matches(name, '[a-z]')) AND NOT contains(lower(name), lower(store)))"""
UNIQUE = """, whole AS (SELECT f.* FROM flat f WHERE NOT EXISTS (SELECT 1 FROM flat g WHERE g.receipt_id = f.receipt_id AND g.price = f.price AND lower(g.name) <> lower(f.name) AND contains(lower(g.name), lower(f.name))))"""
COLS = ["receipt_id", "item_idx", "store", "purchase_date", "currency", "name", "code", "price", "amount"]
SELECT = " SELECT " + ", ".join(COLS) + " FROM "


def valid_items(spark: SparkSession, sf: str) -> DataFrame:
    return items.validate(derived(spark, sf, "items").drop("cents"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Clean items per store and currency."""
    clean = items.drop_fragments(items.flatten(valid_items(spark, sf)))
    cents = T.price_cents(F.col("price"))
    return clean.groupBy("store", "currency").agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("receipt_id").alias("n_receipts"), F.sum(cents).alias("total_cents"))


@query(duck("items") + VALID + FLAT + UNIQUE + r""" SELECT store, currency, count(*) AS n_items, count(DISTINCT receipt_id) AS n_receipts, CAST(sum(CAST(replace(regexp_replace(price, '[A-Z]+$', ''), '.', '') AS bigint)) AS bigint) AS total_cents FROM whole GROUP BY store, currency""")
def flagship_store_totals(spark: SparkSession, sf: str) -> DataFrame:
    return flagship(spark, sf)


@query(duck("items") + VALID + SELECT + "valid")
def f01_validate(spark: SparkSession, sf: str) -> DataFrame:
    return valid_items(spark, sf)


@query(duck("items") + VALID + FLAT + SELECT + "flat")
def f02_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Through the nested form: items are gathered to receipts, exploded and flattened."""
    from ..schemas import ITEM

    valid = valid_items(spark, sf)
    item = F.struct(F.col("name").alias("productName"), F.col("code").alias("itemCode"), "price", "amount", F.lit(None).cast("string").alias("category"))
    nested = valid.groupBy("receipt_id", F.col("store").alias("storeName"), F.col("purchase_date").alias("purchaseDate"), "currency").agg(F.array_sort(F.collect_list(F.struct("item_idx", item.alias("i")))).alias("s"))
    receipts = nested.select("receipt_id", "storeName", "purchaseDate", "currency", F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"), F.col("s.item_idx").alias("ids"), F.col("s.i").cast(f"array<{ITEM}>").alias("items"))
    rows = items.explode_receipts(receipts).join(receipts.select("receipt_id", F.posexplode("ids").alias("item_idx", "id")), ["receipt_id", "item_idx"])
    return items.flatten(rows.drop("item_idx").withColumnRenamed("id", "item_idx")).select(*COLS)


@query(duck("items") + VALID + rf""" SELECT receipt_id, item_idx, name FROM valid WHERE NOT (regexp_matches(name, '^\d{{9,}}$') OR (length(name) > 10 AND regexp_matches(substr(name, 1, 8), '\d')))
AND NOT regexp_matches(upper(name), '%|TAX|TOTAL|CASH|CHANGE') AND length(name) > 1""")
def f03_late_filter(spark: SparkSession, sf: str) -> DataFrame:
    return items.late_filter(valid_items(spark, sf)).select("receipt_id", "item_idx", "name")


@query(duck("items") + VALID + FLAT + UNIQUE + ", placed AS (SELECT *, min(item_idx) OVER (PARTITION BY receipt_id, price) AS f FROM whole) SELECT receipt_id, item_idx, name AS \"productName\", purchase_date AS \"purchaseDate\", price, amount, store AS \"storeName\", row_number() OVER (PARTITION BY receipt_id ORDER BY f, item_idx) AS place FROM placed")
def f04_w02_output_rows(spark: SparkSession, sf: str) -> DataFrame:
    clean = items.output_order(items.drop_fragments(items.flatten(valid_items(spark, sf)))).withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")})
    placed = clean.withColumn("place", F.col("place").cast("long"))
    return items.upload_rows(items.output_rows(placed, ["place"]), ["place"])


@query(duck("items") + VALID + FLAT + UNIQUE + SELECT + "whole")
def w02_drop_fragments(spark: SparkSession, sf: str) -> DataFrame:
    return items.drop_fragments(items.flatten(valid_items(spark, sf))).select(*COLS)


@query(duck("items") + VALID + SELECT + r"""(SELECT *, row_number() OVER (PARTITION BY receipt_id, regexp_replace(lower(name), '[^a-z0-9]', '', 'g'), regexp_replace(price, '[A-Za-z]+$', ''), code ORDER BY item_idx) AS k FROM valid) WHERE k = 1""")
def w03_exact_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return items.drop_exact_repeats(valid_items(spark, sf)).select(*COLS)


#: Keys of items of one receipt and price, in order; of each pair of different keys what its ratio can't exceed.
PAIRS = r""", keyed AS (
    SELECT receipt_id, currency, item_idx, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS k, regexp_replace(price, '[A-Za-z]+$', '') AS p, code FROM valid
), pairs AS (
    SELECT a.currency, a.k AS x, b.k AS y FROM keyed a JOIN keyed b ON a.receipt_id = b.receipt_id AND a.p = b.p AND a.item_idx < b.item_idx
    WHERE a.k <> b.k AND a.k <> '' AND b.k <> '' AND NOT (a.code <> '' AND b.code <> '' AND a.code <> b.code)
), bounds AS (
    SELECT currency, 2.0 * least(length(x), length(y)) / (length(x) + length(y)) AS by_length,
           2.0 * list_sum(list_transform(list_distinct(string_split(x, '')), lambda c: least(length(x) - length(replace(x, c, '')), length(y) - length(replace(y, c, ''))))) / (length(x) + length(y)) AS by_characters FROM pairs
)"""


@query(duck("items") + VALID + PAIRS + """ SELECT currency, count(*) AS pairs, count(*) FILTER (WHERE by_length >= 0.85) AS long_enough, count(*) FILTER (WHERE by_characters >= 0.85) AS compared FROM bounds GROUP BY currency""")
def w03_pruned_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """How many pairs the bounds leave to be compared."""
    groups = items.repeat_groups(valid_items(spark, sf).select(*COLS))
    apart = lambda x, y: (x["code_key"] != "") & (y["code_key"] != "") & (x["code_key"] != y["code_key"])
    every = groups.select(F.col("g")[0]["row"]["currency"].alias("currency"), F.size(S.candidate_pairs(F.col("g"), lambda x: x["key"], apart, 0.0)).alias("n"), "pairs", "g")
    key = lambda i: F.get(F.col("g"), i)["key"]
    long_enough = F.size(F.filter(S.candidate_pairs(F.col("g"), lambda x: x["key"], apart, 0.0), lambda p: S.length_bound(key(p["i"]), key(p["j"])) >= 0.85))
    total = lambda c, name: F.sum(c).cast("long").alias(name)
    return every.groupBy("currency").agg(total(F.col("n"), "pairs"), total(long_enough, "long_enough"), total(F.size("pairs"), "compared")).where("pairs > 0")


@query()
def w03_fuzzy_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return items.drop_fuzzy_repeats(valid_items(spark, sf).select(*COLS))


@query(duck("items") + SELECT + r"""(SELECT *, row_number() OVER (PARTITION BY receipt_id, lower(regexp_replace(name, '^\d+\s+', '')), regexp_replace(price, '[A-Za-z]+$', '') ORDER BY item_idx) AS k FROM items) WHERE k = 1""")
def w04_first_items(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.first_items(derived(spark, sf, "items"), keys=["receipt_id"], order=["item_idx"]).select(*COLS)


CHUNKS = r""", c AS (SELECT receipt_id, item_idx // 20 AS chunk_idx, min(store) AS store, nullif(CASE WHEN item_idx // 20 % 2 = 0 THEN '' ELSE min(purchase_date) END, 'x') AS purchase_date, CASE WHEN item_idx // 20 % 3 < 2 THEN min(price) END AS total, count(*) AS input_tokens, count(DISTINCT name) AS output_tokens FROM items GROUP BY receipt_id, item_idx // 20)"""


def _chunk_rows(spark: SparkSession, sf: str) -> DataFrame:
    chunk = F.expr("item_idx div 20")
    g = derived(spark, sf, "items").groupBy("receipt_id", chunk.alias("chunk_idx"))
    rows = g.agg(F.min("store").alias("store"), F.min("purchase_date").alias("d"), F.min("price").alias("p"), F.count(F.lit(1)).alias("input_tokens"), F.count_distinct("name").alias("output_tokens"))
    return rows.select("receipt_id", "chunk_idx", "store", F.when(F.col("chunk_idx") % 2 == 0, "").otherwise(F.col("d")).alias("purchase_date"), F.when(F.col("chunk_idx") % 3 < 2, F.col("p")).alias("total"), "input_tokens", "output_tokens")


@query(duck("items") + CHUNKS + """ SELECT receipt_id, arg_min(store, chunk_idx) AS store, arg_min(purchase_date, chunk_idx) FILTER (WHERE purchase_date <> '') AS purchase_date, arg_max(total, chunk_idx) FILTER (WHERE total IS NOT NULL) AS total FROM c GROUP BY receipt_id""")
def c04_merge_scalars(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.merge_scalars(_chunk_rows(spark, sf), first=["store"], first_filled=["purchase_date"], last=["total"])


@query(duck("items") + CHUNKS + """ SELECT receipt_id, CAST(sum(input_tokens) AS bigint) AS input_tokens, CAST(sum(output_tokens) AS bigint) AS output_tokens, CAST(sum(input_tokens * 3) AS bigint) AS cost_usd FROM c GROUP BY receipt_id""")
def c05_usage(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.usage(_chunk_rows(spark, sf).withColumn("cost_usd", F.col("input_tokens") * 3))


@query(duck("items", "ocr_texts") + rf""", n AS (SELECT receipt_id, row_number() OVER (PARTITION BY receipt_id ORDER BY line_idx) AS n, trim(line) AS line, trim(regexp_replace(line, '(\d)\.\s+(\d)', '\1.\2', 'g')) AS norm FROM ocr_lines),
w AS (SELECT receipt_id, n, regexp_extract(norm, {q(X.WEIGHT_LINE)}, 1) AS weight, regexp_extract(norm, {q(X.WEIGHT_LINE)}, 3) AS own FROM n WHERE regexp_matches(norm, {q(X.WEIGHT_LINE)})),
t AS (SELECT w.receipt_id, w.n, any_value(weight) AS weight, CASE WHEN any_value(own) <> '' THEN any_value(own) ELSE arg_min(a.norm, a.n) END AS total
  FROM w LEFT JOIN n a ON a.receipt_id = w.receipt_id AND a.n BETWEEN w.n + 1 AND w.n + 3 AND regexp_matches(a.norm, '^\d+\.\d+$') GROUP BY w.receipt_id, w.n),
names AS (SELECT receipt_id, n, trim(regexp_replace(regexp_replace(line, '^\d+\s+', ''), '(?i)\s+MRJ\s*$', '')) AS name FROM n WHERE line <> '' AND upper(line) <> 'MRJ'),
hits AS (SELECT t.receipt_id, t.n, any_value(weight) AS weight, any_value(total) AS total, upper(arg_max(b.name, b.n)) AS name
  FROM t JOIN names b ON b.receipt_id = t.receipt_id AND b.n BETWEEN t.n - 4 AND t.n - 1 AND NOT regexp_matches(b.name, '^\d+-[A-Z]+$') WHERE total IS NOT NULL GROUP BY t.receipt_id, t.n),
weights AS (SELECT receipt_id, name AS k, arg_max(weight, n) AS weight, CAST(round(CAST(arg_max(total, n) AS decimal(20, 6)) * 100) AS bigint) AS c FROM hits WHERE name <> '' GROUP BY receipt_id, name),
h AS (SELECT receipt_id, arg_min(store, item_idx) AS store, arg_min(purchase_date, item_idx) AS purchase_date, arg_min(currency, item_idx) AS currency, max(item_idx) AS last FROM items GROUP BY receipt_id),
o AS (SELECT i.receipt_id, i.item_idx, i.store, i.purchase_date, i.currency, i.name, i.code, CASE WHEN k IS NULL THEN price ELSE CAST(c // 100 AS varchar) || '.' || lpad(CAST(c % 100 AS varchar), 2, '0') || currency END AS price, CASE WHEN k IS NULL THEN amount ELSE weight || ' kg' END AS amount
  FROM items i LEFT JOIN weights w ON w.receipt_id = i.receipt_id AND w.k = upper(i.name))
SELECT * FROM o UNION ALL
SELECT w.receipt_id, last + row_number() OVER (PARTITION BY w.receipt_id ORDER BY k), store, purchase_date, currency, array_to_string(list_transform(string_split(lower(k), ' '), lambda x: upper(x[1]) || x[2:]), ' '), '',
  CAST(c // 100 AS varchar) || '.' || lpad(CAST(c % 100 AS varchar), 2, '0') || currency, weight || ' kg'
FROM weights w JOIN h ON h.receipt_id = w.receipt_id WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.receipt_id = w.receipt_id AND upper(i.name) = k)""")
def j08_inject_weights(spark: SparkSession, sf: str) -> DataFrame:
    return items.inject_exact(derived(spark, sf, "items").drop("cents"), items.weight_items(ocr_texts(spark, sf)))


@query()
def j08_inject_weights_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    return items.inject_closest(derived(spark, sf, "items").drop("cents"), items.weight_items(ocr_texts(spark, sf)))


@query()
def extraction_process(spark: SparkSession, sf: str) -> DataFrame:
    """All item steps in order."""
    return items.process(derived(spark, sf, "items").select(*COLS))
