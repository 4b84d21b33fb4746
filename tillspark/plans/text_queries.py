"""Text operators as queries over derived receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T
from ..operators import chunks, items
from .derive import derived, duck, ocr_texts
from .registry import query


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


@query(duck("ocr_texts") + r" SELECT receipt_id, regexp_replace(ocr, '(\d)\.\s+(\d)', '\1.\2', 'g') AS ocr FROM ocr_texts")
def t01_spaced_decimals(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.join_spaced_decimals(F.col("ocr")).alias("ocr"))


@query(duck("ocr_texts") + r""", marked AS (
    SELECT receipt_id, line_idx, line, regexp_matches(trim(line), '^\$?\d+\.\d{2}\s*$') AS is_price, trim(line) <> '' AS filled FROM ocr_lines
), headed AS (SELECT *, max(CASE WHEN filled AND NOT is_price THEN line_idx END) OVER (PARTITION BY receipt_id ORDER BY line_idx) AS head FROM marked),
numbered AS (SELECT *, row_number() OVER (PARTITION BY receipt_id, head, is_price ORDER BY line_idx) AS nth FROM headed),
firsts AS (SELECT receipt_id, head, trim(line) AS price FROM numbered WHERE is_price AND nth = 1 AND head IS NOT NULL),
kept AS (
    SELECT n.receipt_id, n.line_idx, CASE WHEN f.price IS NOT NULL AND NOT regexp_matches(n.line, '\$?\d+\.\d{2}\s*$') THEN rtrim(n.line) || '  ' || f.price ELSE n.line END AS line
    FROM numbered n LEFT JOIN firsts f ON n.receipt_id = f.receipt_id AND n.line_idx = f.head
    WHERE NOT n.is_price OR (n.head IS NULL AND n.nth = 1)
), joined AS (SELECT receipt_id, string_agg(line, chr(10) ORDER BY line_idx) AS raw FROM kept GROUP BY receipt_id)
SELECT j.receipt_id, j.raw || substr(t.ocr, length(t.raw) + 1) AS ocr FROM joined j JOIN ocr_texts t ON j.receipt_id = t.receipt_id""")
def t02_join_price_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.join_price_lines(F.col("ocr")).alias("ocr"))


@query(duck("ocr_texts") + f""", kept AS (SELECT receipt_id, string_agg(line, chr(10) ORDER BY line_idx) AS raw FROM ocr_lines WHERE NOT regexp_matches(line, {q(X.NOISE_LINE)}) GROUP BY receipt_id)
SELECT k.receipt_id, k.raw || substr(t.ocr, length(t.raw) + 1) AS ocr FROM kept k JOIN ocr_texts t ON k.receipt_id = t.receipt_id""")
def t03_noise_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.drop_noise_lines(F.col("ocr")).alias("ocr"))


@query(duck("ocr_lines") + f""" SELECT receipt_id, line_idx, regexp_matches(line, {q(X.SPATIAL_NOISE_LINE)}) AS noise,
CASE WHEN regexp_matches(line, {q(X.SAVINGS_LINE)}) THEN 'S' ELSE 'L' END AS label FROM ocr_lines""")
def t04_t05_spatial_lines(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "ocr_lines").select("receipt_id", "line_idx", T.is_spatial_noise(F.col("line")).alias("noise"), T.row_label(F.col("line")).alias("label"))


@query(duck("ocr_lines") + r""", s AS (SELECT receipt_id, line_idx, trim(line) AS s FROM ocr_lines)
SELECT receipt_id, line_idx, CASE WHEN s = '' THEN true WHEN length(regexp_replace(s, '[^A-Za-z0-9 ]', '', 'g')) < 0.55 * length(s) THEN true
WHEN regexp_matches(s, '[0-9]') THEN false ELSE regexp_matches(s, '^[^A-Z0-9]') END AS garbled FROM s""")
def t06_garbled(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "ocr_lines").select("receipt_id", "line_idx", T.is_garbled(F.col("line")).alias("garbled"))


@query(duck("ocr_texts") + r""", m AS (SELECT receipt_id, regexp_extract(raw, '\b(\d{1,2})/(\d{1,2})/(\d{4})\b', ['a', 'b', 'c']) AS f, regexp_extract(raw, '\b(\d{2})/(\d{2})/(\d{2})\b', ['a', 'b', 'c']) AS s FROM ocr_texts)
SELECT receipt_id, CASE WHEN f.c <> '' THEN f.c || '.' || lpad(f.a, 2, '0') || '.' || lpad(f.b, 2, '0')
WHEN try_cast(s.a AS int) > 12 THEN '20' || s.a || '.' || s.b || '.' || s.c WHEN try_cast(s.c AS int) > 12 THEN '20' || s.c || '.' || s.a || '.' || s.b END AS date FROM m""")
def t07_header_date(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.header_date(T.raw_part(F.col("ocr"))).alias("date"))


#: The first match that no promotion announces (pattern 1: date with time, else pattern 2: written date), by its place in the text.
DATES = rf""", r AS (SELECT receipt_id, split_part(ocr, chr(10) || '---' || chr(10), 1) AS t FROM ocr_texts),
h AS (
    SELECT receipt_id, t, 1 AS kind, regexp_extract_all(t, {q(X.DATE_WITH_TIME)}) AS hits, string_split_regex(t, {q(X.DATE_WITH_TIME)}) AS gaps FROM r
    UNION ALL SELECT receipt_id, t, 2, regexp_extract_all(t, {q(X.WRITTEN_DATE)}), string_split_regex(t, {q(X.WRITTEN_DATE)}) FROM r
), m AS (
    SELECT receipt_id, t, kind, u.hit, u.n, CAST(list_sum(list_transform(gaps[1:u.n], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:u.n - 1], lambda x: length(x))), 0) AS bigint) AS place
    FROM h, unnest(hits) WITH ORDINALITY AS u(hit, n)
), b AS (SELECT *, substr(t, 1, place) AS before FROM m),
near AS (SELECT *, CASE WHEN kind = 1 THEN substr(before, greatest(1, place - length(regexp_extract(before, '[^\n]*$')) - 79)) ELSE right(before, 80) END AS beside FROM b),
p AS (
    SELECT *, string_split_regex(regexp_extract(hit, '^\S+'), '[/-]') AS d, regexp_extract(hit, {q(X.WRITTEN_DATE)}, ['month', 'day', 'year']) AS w
    FROM near WHERE NOT regexp_matches(beside, {q(X.PROMOTION)})
), v AS (
    SELECT receipt_id, kind, n,
           CASE WHEN kind = 2 THEN try_cast(w.year AS int) WHEN length(d[1]) = 4 THEN try_cast(d[1] AS int) WHEN length(d[3]) > 2 THEN try_cast(d[3] AS int) ELSE 2000 + try_cast(d[3] AS int) END AS y,
           CASE WHEN kind = 2 THEN list_position({X.MONTHS}, lower(left(w.month, 3))) WHEN length(d[1]) = 4 OR try_cast(d[1] AS int) > 12 OR try_cast(d[2] AS int) > 31 THEN try_cast(d[2] AS int) ELSE try_cast(d[1] AS int) END AS mo,
           CASE WHEN kind = 2 THEN try_cast(w.day AS int) WHEN length(d[1]) = 4 THEN try_cast(d[3] AS int) WHEN try_cast(d[1] AS int) > 12 OR try_cast(d[2] AS int) > 31 THEN try_cast(d[1] AS int) ELSE try_cast(d[2] AS int) END AS dy
    FROM p
), firsts AS (
    SELECT receipt_id, arg_min(CAST(y AS varchar) || '.' || lpad(CAST(mo AS varchar), 2, '0') || '.' || lpad(CAST(dy AS varchar), 2, '0'), kind * 1000000 + n) AS date
    FROM v WHERE y >= 2022 AND (kind = 1 OR y <= 2030) AND mo BETWEEN 1 AND 12 AND dy BETWEEN 1 AND 31 GROUP BY receipt_id
)"""


@query(duck("ocr_texts") + DATES + " SELECT r.receipt_id, date FROM r LEFT JOIN firsts f ON f.receipt_id = r.receipt_id")
def t08_transaction_date(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.transaction_date(F.col("ocr")).alias("date"))


STORE_SQL = f"""CASE WHEN store IN ({', '.join(map(q, X.CANADIAN_STORES))}) OR regexp_matches(upper(store), '{'|'.join(X.CANADIAN_KEYWORDS)}') THEN 'CAD'
WHEN regexp_matches(upper(store), '{'|'.join(X.US_KEYWORDS)}') THEN 'USD' END"""
TEXT_SQL = " ".join(f"WHEN regexp_matches(ocr, {q(p)}) THEN '{c}'" for p, c in X.CURRENCY_MARKS) + f" WHEN regexp_matches(ocr, {q(X.US_STORE_IN_TEXT)}) THEN 'USD'"


@query(duck("ocr_texts") + f" SELECT receipt_id, CASE {TEXT_SQL} END AS currency FROM ocr_texts")
def t09_currency_in_text(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.currency_in_text(F.col("ocr")).alias("currency"))


@query(duck("items", "ocr_texts") + f""", s AS (SELECT receipt_id, min(store) AS store, min(currency) AS claimed FROM items GROUP BY receipt_id)
SELECT s.receipt_id, {STORE_SQL} AS by_store, coalesce(CASE {TEXT_SQL} END, {STORE_SQL}, nullif(claimed, ''), 'USD') AS currency,
CASE upper(store) WHEN 'VONS STORE' THEN 'Vons' WHEN 'NO FRILLS' THEN 'No Frills' ELSE store END AS alias FROM s JOIN ocr_texts t ON s.receipt_id = t.receipt_id""")
def t10_t11_t12_store_currency(spark: SparkSession, sf: str) -> DataFrame:
    stores = derived(spark, sf, "items").groupBy("receipt_id").agg(F.min("store").alias("store"), F.min("currency").alias("claimed"))
    both = stores.join(ocr_texts(spark, sf), "receipt_id")
    return both.select("receipt_id", T.currency_of_store(F.col("store")).alias("by_store"), T.receipt_currency(F.col("ocr"), F.col("store"), F.col("claimed")).alias("currency"), T.store_alias(F.col("store")).alias("alias"))


@query(duck("ocr_lines") + f""", top AS (SELECT receipt_id, line, row_number() OVER (PARTITION BY receipt_id ORDER BY line_idx) AS n FROM ocr_lines),
head AS (SELECT receipt_id, string_agg(line, chr(10) ORDER BY n) AS h FROM top WHERE n <= 10 GROUP BY receipt_id),
found AS (SELECT receipt_id, lower(regexp_extract(h, {q(X.KNOWN_CHAIN)}, 1)) AS f FROM head)
SELECT receipt_id, CASE f WHEN '' THEN 'Downtown' WHEN 'vons' THEN 'Vons' WHEN 'kroger' THEN 'Kroger' WHEN 'no  frills' THEN 'No  Frills' WHEN 'trader joe' THEN 'Trader Joe' ELSE f END AS store FROM found""")
def t13_store_from_header(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.store_from_header(F.lit("Downtown"), F.col("ocr")).alias("store"))


@query(duck("ocr_lines") + rf""", n AS (SELECT receipt_id, line, row_number() OVER (PARTITION BY receipt_id ORDER BY line_idx) AS n FROM ocr_lines),
top AS (SELECT *, lead(line) OVER (PARTITION BY receipt_id ORDER BY n) AS nxt FROM n WHERE n <= 30),
picked AS (SELECT receipt_id, arg_min(trim(line), n) FILTER (WHERE regexp_matches(line, {q(X.STREET_LINE)})) AS street, arg_min(coalesce(trim(nxt), ''), n) FILTER (WHERE regexp_matches(line, {q(X.STREET_LINE)})) AS nxt,
  arg_min(line, n) FILTER (WHERE regexp_matches(line, {q(X.CITY_STATE_ZIP)})) AS line FROM top GROUP BY receipt_id),
cut AS (SELECT *, regexp_extract(line, {q(X.CITY_STATE_ZIP)}, 0) AS city FROM picked)
SELECT receipt_id, CASE WHEN street IS NOT NULL THEN street || CASE WHEN NOT regexp_matches(street, {q(X.CITY_STATE_ZIP)}) AND regexp_matches(nxt, {q(X.CITY_STATE_ZIP)}) THEN ', ' || nxt ELSE '' END
WHEN line IS NOT NULL THEN 'Vons ' || trim(city) ELSE '' END AS address FROM cut""")
def t14_address(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.address_from_text(F.col("ocr"), F.lit("Vons")).alias("address"))


@query(duck("ocr_lines") + r""" SELECT receipt_id, trim(replace(coalesce(string_agg(trim(line), ' ' ORDER BY line_idx) FILTER (WHERE NOT regexp_matches(line, 'Dir |Mgr |Main:|Rx:|Phone:|Tel:|Manager|\(\d{3}\) \d{3}-\d{4}')), ''), 'Store 2216', '')) AS address
FROM ocr_lines GROUP BY receipt_id""")
def t15_address_for_geocoder(spark: SparkSession, sf: str) -> DataFrame:
    """Of the whole raw text, as an address of many lines."""
    return ocr_texts(spark, sf).select("receipt_id", T.address_for_geocoder(T.raw_part(F.col("ocr"))).alias("address"))


@query(duck("ocr_lines") + rf""", n AS (SELECT receipt_id, row_number() OVER (PARTITION BY receipt_id ORDER BY line_idx) AS n, trim(line) AS line, trim(regexp_replace(line, '(\d)\.\s+(\d)', '\1.\2', 'g')) AS norm FROM ocr_lines),
w AS (SELECT receipt_id, n, regexp_extract(norm, {q(X.WEIGHT_LINE)}, 1) AS weight, regexp_extract(norm, {q(X.WEIGHT_LINE)}, 3) AS own FROM n WHERE regexp_matches(norm, {q(X.WEIGHT_LINE)})),
t AS (SELECT w.receipt_id, w.n, any_value(weight) AS weight, CASE WHEN any_value(own) <> '' THEN any_value(own) ELSE arg_min(a.norm, a.n) END AS total
  FROM w LEFT JOIN n a ON a.receipt_id = w.receipt_id AND a.n BETWEEN w.n + 1 AND w.n + 3 AND regexp_matches(a.norm, '^\d+\.\d+$') GROUP BY w.receipt_id, w.n),
names AS (SELECT receipt_id, n, trim(regexp_replace(regexp_replace(line, '^\d+\s+', ''), '(?i)\s+MRJ\s*$', '')) AS name FROM n WHERE line <> '' AND upper(line) <> 'MRJ'),
hits AS (SELECT t.receipt_id, t.n, any_value(weight) AS weight, any_value(total) AS total, upper(arg_max(b.name, b.n)) AS name
  FROM t JOIN names b ON b.receipt_id = t.receipt_id AND b.n BETWEEN t.n - 4 AND t.n - 1 AND NOT regexp_matches(b.name, '^\d+-[A-Z]+$') WHERE total IS NOT NULL GROUP BY t.receipt_id, t.n)
SELECT receipt_id, name, arg_max(weight, n) AS weight, arg_max(total, n) AS total FROM hits WHERE name <> '' GROUP BY receipt_id, name""")
def t16_weight_items(spark: SparkSession, sf: str) -> DataFrame:
    return items.weight_rows(ocr_texts(spark, sf))


@query(duck("ocr_texts") + r""", split AS (SELECT receipt_id, ocr, string_split(regexp_replace(ocr, '\n$', ''), chr(10)) AS lines FROM ocr_texts),
n AS (SELECT receipt_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS n FROM split),
found AS (SELECT receipt_id, min(n) FILTER (WHERE contains(upper(line), 'MEMBER')) AS k FROM n GROUP BY receipt_id)
SELECT s.receipt_id, CASE WHEN k IS NULL THEN substr(ocr, 1, 500) ELSE array_to_string(list_slice(lines, greatest(1, k - 3), k + 3), chr(10)) END AS context FROM split s JOIN found f ON s.receipt_id = f.receipt_id""")
def t17_line_context(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_texts(spark, sf).select("receipt_id", T.line_context(F.col("ocr"), F.lit("member card")).alias("context"))


@query(duck("items") + r""", p AS (SELECT receipt_id, item_idx, currency, regexp_replace(price, '[A-Za-z]+$', '') AS bare, price, amount FROM items),
c AS (SELECT *, CAST(round(try_cast(nullif(regexp_extract(bare, '\d+\.?\d*'), '') AS decimal(20, 6)) * 100) AS bigint) AS cents FROM p)
SELECT receipt_id, item_idx, cents, CAST(cents // 100 AS varchar) || '.' || lpad(CAST(cents % 100 AS varchar), 2, '0') || currency AS price,
try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS double) AS scored, CASE WHEN regexp_matches(amount, '^\d+\.\d{2}\s*[A-Za-z]?$') THEN '' ELSE trim(replace(amount, 'EA', '')) END AS amount,
replace(lower(amount), ' ', '') AS scored_amount FROM c""")
def t18_t19_prices_amounts(spark: SparkSession, sf: str) -> DataFrame:
    items = derived(spark, sf, "items").withColumn("cents", T.price_cents(F.col("price")))
    return items.select(
        "receipt_id", "item_idx", "cents", T.format_cents(F.col("cents"), F.col("currency")).alias("price"), T.eval_price(F.col("price")).alias("scored"),
        T.clean_amount(F.col("amount"), F.col("cents").isNotNull()).alias("amount"), T.eval_amount(F.col("amount")).alias("scored_amount"),
    )


@query(duck("items") + r""" SELECT receipt_id, item_idx, lower(name) AS name_key, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS dedup_key, lower(regexp_replace(name, '^\d+\s+', '')) AS merge_key,
regexp_replace(price, '[A-Za-z]+$', '') AS price_key, replace(purchase_date, '-', '.') AS date_key,
array_to_string(list_distinct(list_filter(string_split_regex(lower(store), '\W+'), lambda w: length(w) > 3)), ',') IS NULL AS no_words,
len(list_distinct(list_filter(string_split_regex(lower(store), '\W+'), lambda w: length(w) > 3 AND w NOT IN ('the', 'and', 'your', 'for')))) AS n_words, item_idx % 40 = 0 AS cjk FROM items""")
def t20_t21_keys(spark: SparkSession, sf: str) -> DataFrame:
    i = derived(spark, sf, "items")
    words = T.store_words(F.col("store"))
    doubled = F.when(F.col("item_idx") % 40 == 0, F.concat(F.col("name"), F.regexp_replace("name", ".", "牛"))).otherwise(F.col("name"))
    return i.select(
        "receipt_id", "item_idx", T.name_key(F.col("name")).alias("name_key"), T.dedup_key(F.col("name")).alias("dedup_key"), T.merge_name_key(F.col("name")).alias("merge_key"),
        T.merge_price_key(F.col("price")).alias("price_key"), T.date_key(F.col("purchase_date")).alias("date_key"), F.array_join(words, ",").isNull().alias("no_words"),
        F.size(words).cast("long").alias("n_words"), T.is_mostly_cjk(doubled).alias("cjk"),
    )


BOOK = ", ".join(f"('{p}', '{m}', {i}, {o})" for p, m, i, o in X.PRICE_BOOK)


@query(duck("logs") + f""", book(provider, model, rate_in, rate_out) AS (VALUES {BOOK})
SELECT event_id, round(input_tokens / 1e6 * coalesce(rate_in, 0) + output_tokens / 1e6 * coalesce(rate_out, 0), 9) AS cost_usd FROM logs l LEFT JOIN book b ON l.provider = b.provider AND l.model = b.model""")
def t23_j09_cost(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.logs import with_cost

    return with_cost(derived(spark, sf, "logs")).select("event_id", F.round("cost_usd", 9).alias("cost_usd"))


@query(duck("items") + r""", r AS (SELECT receipt_id, min(store) AS store, min(name) AS name, count(*) AS n FROM items GROUP BY receipt_id)
SELECT receipt_id, CASE WHEN receipt_id % 5 < 3 THEN store END AS store_name, CASE WHEN receipt_id % 5 < 3 THEN n END AS total_items, CASE WHEN receipt_id % 5 < 3 THEN name END AS first_name FROM r""")
def t24_model_json(spark: SparkSession, sf: str) -> DataFrame:
    r = derived(spark, sf, "items").groupBy("receipt_id").agg(F.min("store").alias("store"), F.min("name").alias("name"), F.count(F.lit(1)).alias("n"))
    body = F.format_string('{"storeName": "%s", "totalItems": %d, "items": [{"productName": "%s"},]', F.col("store"), F.col("n"), F.col("name"))
    clean = F.concat(F.replace(body, F.lit(",]"), F.lit("]")), F.lit("}"))
    kind = F.col("receipt_id") % 5
    raw = (
        F.when(kind == 0, F.concat(F.lit("thinking <json> "), clean, F.lit(" </json>")))
        .when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit(",}\n```")))
        .when(kind == 2, F.concat(F.lit("Here it is: "), body, F.lit("}  Bye")))
        .when(kind == 3, F.lit("  "))
        .otherwise(F.concat(F.lit("<json>"), body, F.lit(",}</json>")))
    )
    from ..schemas import RECEIPT

    parsed = r.select("receipt_id", F.from_json(T.model_json(raw), RECEIPT).alias("r"))
    return parsed.select("receipt_id", F.col("r.storeName").alias("store_name"), F.col("r.totalItems").cast("long").alias("total_items"), F.col("r.items")[0]["productName"].alias("first_name"))


@query(r"""SELECT page_id, nullif(trim(regexp_replace(CASE WHEN page_id % 3 = 0 THEN 'Bearer ' || page_id WHEN page_id % 3 = 1 THEN 'Bearer ' ELSE url END, '^Bearer ', '')), '') AS token,
split_part(url, ' ', 1) AS word, lower(split_part(url, '/', -1)) AS slug, regexp_replace(split_part(url, '/', -1), '(.)\.[^.]*$', '\1') AS stem, lower(regexp_extract(split_part(url, '/', -1), '.(\.[^.]+)$', 1)) AS suffix FROM pages""")
def t25_t27_scalars(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    header = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("Bearer "), F.col("page_id").cast("string"))).when(F.col("page_id") % 3 == 1, F.lit("Bearer ")).otherwise(F.col("url"))
    u = F.col("url")
    return p.select("page_id", T.bearer_token(header).alias("token"), T.first_word(u).alias("word"), T.model_slug(u).alias("slug"), T.file_stem(u).alias("stem"), T.file_suffix(u).alias("suffix"))


@query()
def t26_similarity(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.similarity import ratio

    pairs = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.col("p_name").alias("a"), F.col("p_type").alias("b"))
    return pairs.select("p_partkey", ratio("a", "b").alias("ratio"))


CHUNKED = r""", body AS (SELECT receipt_id, raw, ocr, receipt_id % 2 = 0 AS spatial FROM ocr_texts WHERE receipt_id % 2 = 0 OR length(ocr) > 2000),
all_lines AS (SELECT receipt_id, spatial, raw, u.line, u.n FROM body, unnest(string_split(CASE WHEN spatial THEN upper(raw) ELSE raw END, chr(10))) WITH ORDINALITY AS u(line, n)),
lines AS (SELECT receipt_id, line, n - CASE WHEN spatial THEN 0 ELSE 6 END AS n FROM all_lines WHERE spatial OR n > 6),
sums AS (SELECT *, sum(length(line)) OVER (PARTITION BY receipt_id ORDER BY n) AS total FROM lines),
walk AS (
    SELECT receipt_id, n, CAST(1 AS bigint) AS first, CAST(total AS bigint) AS chars, CAST(NULL AS bigint) AS flushed FROM sums WHERE n = 1
    UNION ALL
    SELECT s.receipt_id, s.n, CASE WHEN w.chars + length(s.line) > 700 THEN greatest(w.first, s.n - 6) ELSE w.first END,
           CAST(CASE WHEN w.chars + length(s.line) > 700 THEN s.total - coalesce(b.total, 0) ELSE w.chars + length(s.line) END AS bigint), CASE WHEN w.chars + length(s.line) > 700 THEN w.first END
    FROM walk w JOIN sums s ON s.receipt_id = w.receipt_id AND s.n = w.n + 1 LEFT JOIN sums b ON b.receipt_id = w.receipt_id AND b.n = greatest(w.first, s.n - 6) - 1
), cuts AS (
    SELECT receipt_id, flushed AS a, n - 1 AS b FROM walk WHERE flushed IS NOT NULL UNION ALL SELECT receipt_id, arg_max(first, n), max(n) FROM walk GROUP BY receipt_id
), chunks AS (SELECT c.receipt_id, row_number() OVER (PARTITION BY c.receipt_id ORDER BY b) - 1 AS chunk_idx, a, b FROM cuts c)
"""


@query(duck("ocr_texts") + CHUNKED + """, bodies AS (SELECT c.receipt_id, c.chunk_idx, string_agg(l.line, chr(10) ORDER BY l.n) AS text FROM chunks c JOIN lines l ON l.receipt_id = c.receipt_id AND l.n BETWEEN a AND b GROUP BY c.receipt_id, c.chunk_idx)
SELECT receipt_id, chunk_idx, text FROM bodies UNION ALL SELECT receipt_id, 0, ocr FROM ocr_texts WHERE receipt_id NOT IN (SELECT receipt_id FROM body)""")
def c01_c02_chunk_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks without the header that each one repeats."""
    return chunks.split(ocr_texts(spark, sf), with_header=False).select("receipt_id", F.col("chunk_idx").cast("long").alias("chunk_idx"), "text")


#: What each chunk begins with: three clean lines of the first ten and the date beside a layout, else the first six lines.
HEADERS = r""", top AS (
    SELECT receipt_id, n, line, trim(line) AS s FROM body, unnest(string_split(raw, chr(10))) WITH ORDINALITY AS u(line, n) WHERE n <= 10
), clean AS (
    SELECT receipt_id, line, row_number() OVER (PARTITION BY receipt_id ORDER BY n) AS k FROM top
    WHERE s <> '' AND length(regexp_replace(s, '[^A-Za-z0-9 ]', '', 'g')) >= 0.55 * length(s) AND (regexp_matches(s, '[0-9]') OR regexp_matches(s, '^[A-Z]'))
), dates AS (
    SELECT receipt_id, regexp_extract(raw, '\b(\d{1,2})/(\d{1,2})/(\d{4})\b', ['a', 'b', 'c']) AS f, regexp_extract(raw, '\b(\d{2})/(\d{2})/(\d{2})\b', ['a', 'b', 'c']) AS g FROM body WHERE spatial
), dated AS (
    SELECT receipt_id, CASE WHEN f.c <> '' THEN f.c || '.' || lpad(f.a, 2, '0') || '.' || lpad(f.b, 2, '0') WHEN try_cast(g.a AS int) > 12 THEN '20' || g.a || '.' || g.b || '.' || g.c
           WHEN try_cast(g.c AS int) > 12 THEN '20' || g.c || '.' || g.a || '.' || g.b END AS date FROM dates
), head_lines AS (
    SELECT c.receipt_id, k, line FROM clean c JOIN body b ON b.receipt_id = c.receipt_id WHERE spatial AND k <= 3
    UNION ALL SELECT receipt_id, 4, 'Purchase date: ' || date FROM dated WHERE date IS NOT NULL
    UNION ALL SELECT t.receipt_id, n, line FROM top t JOIN body b ON b.receipt_id = t.receipt_id WHERE NOT spatial AND n <= 6
), heads AS (SELECT receipt_id, string_agg(line, chr(10) ORDER BY k) || chr(10) AS head FROM head_lines GROUP BY receipt_id)"""


@query(duck("ocr_texts") + CHUNKED + HEADERS + """, bodies AS (SELECT c.receipt_id, c.chunk_idx, string_agg(l.line, chr(10) ORDER BY l.n) AS text FROM chunks c JOIN lines l ON l.receipt_id = c.receipt_id AND l.n BETWEEN a AND b GROUP BY c.receipt_id, c.chunk_idx)
SELECT b.receipt_id, chunk_idx, coalesce(head, '') || text AS text FROM bodies b LEFT JOIN heads h ON h.receipt_id = b.receipt_id
UNION ALL SELECT receipt_id, 0, ocr FROM ocr_texts WHERE receipt_id NOT IN (SELECT receipt_id FROM body)""")
def c02_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.split(ocr_texts(spark, sf)).withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


@query(duck("ocr_texts") + CHUNKED + """, counted AS (SELECT t.receipt_id, ocr, coalesce(max(chunk_idx) + 1, 1) AS n FROM ocr_texts t LEFT JOIN chunks c ON c.receipt_id = t.receipt_id GROUP BY t.receipt_id, ocr)
SELECT receipt_id, CASE WHEN n = 1 AND receipt_id % 2 = 0 THEN 'direct' ELSE 'cot' END || CASE WHEN contains(upper(substr(ocr, 1, 500)), 'COSTCO') THEN '+costco' ELSE '' END AS path FROM counted""")
def t22_prompt_path(spark: SparkSession, sf: str) -> DataFrame:
    texts = chunks.with_runs(ocr_texts(spark, sf))
    return texts.select("receipt_id", T.prompt_path(F.col("ocr"), F.size("_runs")).alias("path"))


@query(duck("ocr_texts", "items") + r""", first5 AS (SELECT receipt_id, name, row_number() OVER (PARTITION BY receipt_id ORDER BY item_idx) AS n FROM items),
w AS (SELECT receipt_id, n, unnest(string_split_regex(lower(name), '\W+')) AS w FROM first5 WHERE n <= 5)
SELECT t.receipt_id, coalesce(bool_and(NOT contains(lower(ocr), w.w)), false) AS hallucinated FROM ocr_texts t LEFT JOIN w ON w.receipt_id = t.receipt_id AND length(w.w) > 3 GROUP BY t.receipt_id""")
def c06_hallucination(spark: SparkSession, sf: str) -> DataFrame:
    names = derived(spark, sf, "items").groupBy("receipt_id").agg(F.array_sort(F.collect_list(F.struct("item_idx", "name"))).alias("s"))
    both = ocr_texts(spark, sf).join(names, "receipt_id")
    return both.select("receipt_id", T.is_hallucinated(F.col("s.name"), F.col("ocr")).alias("hallucinated"))
