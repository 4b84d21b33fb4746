"""Receipts, OCR text, pages of words, log events and scored pairs derived from the star schema.

The tables hold no receipts, so queries run on deterministic ones: an order is a receipt, its line items are the items, the
customer's nation gives store and currency. The derivations are input data, not operators: one SQL text, in two dialects, gives
Spark and DuckDB the same rows; where Spark has a form of its own, the tests compare both. Names, prices and lines are chosen so that every branch of the operators has rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {"div": "div", "str": "string", "ymd": "date_format(o_orderdate, 'yyyy.MM.dd')", "mdy": "date_format(o_orderdate, 'MM/dd/yyyy')", "mdy2": "date_format(o_orderdate, 'MM/dd/yy')", "nl": "'\\n'", "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", "k": "cast(get_json_object(props, '$.k') as bigint)"}
DUCK = {"div": "//", "str": "varchar", "ymd": "strftime(o_orderdate, '%Y.%m.%d')", "mdy": "strftime(o_orderdate, '%m/%d/%Y')", "mdy2": "strftime(o_orderdate, '%m/%d/%y')", "nl": "chr(10)", "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S')", "k": "cast(json_extract_string(props, '$.k') as bigint)"}

STORE = "CASE n_regionkey % 5 WHEN 0 THEN 'VONS STORE' WHEN 1 THEN 'No Frills' WHEN 2 THEN 'Corner Shop ' || n_name WHEN 3 THEN 'KROGER' ELSE 'T&T Supermarket' END"
CURRENCY = "CASE n_regionkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'GBP' ELSE 'EUR' END"

BASE = f"""
SELECT l_orderkey AS receipt_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) AS item_idx,
       l_partkey AS part, upper(p_name) AS pname, upper(p_type) AS ptype, CAST(round(l_extendedprice * 100) AS bigint) % 10500 AS cents, CAST(l_quantity AS bigint) AS qty,
       {{ymd}} AS purchase_date, {{mdy}} AS mdy, {{mdy2}} AS mdy2, {STORE} AS store, {CURRENCY} AS currency, o_custkey AS cust
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey"""

#: The same rows for Spark, with as little as can be in shuffles. Lines meet their parts first and go to their order as narrow rows;
#: customers join orders, not lines. Rows that are equal up to the quantity give equal items, whatever their order, so columns that
#: come later in the order above stay out. From here on a receipt's rows lie together: items, lines and texts shuffle no more.
BASE_SPARK = f"""
SELECT l_orderkey AS receipt_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, qty) AS item_idx,
       l_partkey AS part, upper(p_name) AS pname, upper(p_type) AS ptype, CAST(round(l_extendedprice * 100) AS bigint) % 10500 AS cents, qty,
       {{ymd}} AS purchase_date, {{mdy}} AS mdy, {{mdy2}} AS mdy2, {STORE} AS store, {CURRENCY} AS currency, o_custkey AS cust
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_quantity AS bigint) AS qty, p_name, p_type FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey) l
JOIN (SELECT o_orderkey, o_custkey, o_orderdate, c_nationkey FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey) o ON l_orderkey = o_orderkey
JOIN {{nation}} ON c_nationkey = n_nationkey"""

#: Items with fragments of names, exact duplicates and one-letter misreadings at the same price.
ITEMS = f"""
SELECT receipt_id, item_idx * 10 + extra AS item_idx, store, purchase_date, currency, cents,
       CASE WHEN extra = 1 THEN pname WHEN extra = 3 THEN 'X' || substr(pname, 2)
            WHEN item_idx % 17 = 3 THEN 'SUBTOTAL' WHEN item_idx % 17 = 5 THEN '(SALE) ' || pname WHEN item_idx % 17 = 7 THEN lower(pname)
            WHEN item_idx % 17 = 9 THEN 'www.shop.example' WHEN item_idx % 17 = 11 THEN 'ITEM 3' WHEN part % 41 = 0 THEN store || ' CLUB' WHEN part % 43 = 0 THEN 'TAX 5%'
            WHEN part % 5 = 0 THEN '1' || CAST(10000 + part % 900 AS {{str}}) || ' ' || pname WHEN item_idx % 6 = 0 THEN pname || ' ' || ptype ELSE pname END AS name,
       CASE WHEN part % 7 = 0 THEN 'C' || CAST(part % 50 AS {{str}}) ELSE '' END AS code,
       CASE WHEN part % 23 = 0 AND extra = 0 THEN '' WHEN part % 29 = 1 AND extra = 0 THEN '0.496' WHEN part % 29 = 2 AND extra = 0 THEN '99.004'
            WHEN part % 29 = 3 AND extra = 0 THEN '123456789012345678.00' WHEN part % 29 = 4 AND extra = 0 THEN '98.996' ELSE CAST(cents {{div}} 100 AS {{str}}) || '.' || lpad(CAST(cents % 100 AS {{str}}), 2, '0') || CASE WHEN part % 3 = 0 THEN 'A' ELSE '' END END AS price,
       CASE part % 6 WHEN 0 THEN CAST(cents {{div}} 100 AS {{str}}) || '.' || lpad(CAST(cents % 100 AS {{str}}), 2, '0') || ' S' WHEN 1 THEN '' WHEN 2 THEN CAST(qty AS {{str}}) || ' EA' ELSE CAST(qty AS {{str}}) END AS amount
FROM base JOIN (SELECT 0 AS extra UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) e
  ON extra = 0 OR (extra = 1 AND item_idx % 6 = 0) OR (extra = 2 AND item_idx % 9 = 0) OR (extra = 3 AND item_idx % 13 = 0)"""

HEAD_LINE = """CASE n WHEN 0 THEN CASE receipt_id % 6 WHEN 0 THEN 'VONS STORE #2216' WHEN 1 THEN '~~ %% ^^ ==' WHEN 2 THEN 'Corner Shop' WHEN 3 THEN 'welcome to KROGER' WHEN 4 THEN 'No  Frills Grocery' ELSE 'TRADER JOE''S' END
              WHEN 1 THEN CASE WHEN receipt_id % 4 = 3 THEN 'store of the day' WHEN receipt_id % 4 = 2 THEN CAST(100 + receipt_id % 900 AS {str}) || ' North Main Street' ELSE 'Tel 5 ' || CAST(100 + receipt_id % 900 AS {str}) || ' North Main Street' END
              WHEN 2 THEN CASE WHEN receipt_id % 3 = 0 THEN 'Springfield CA ' || CAST(90000 + receipt_id % 1000 AS {str}) WHEN receipt_id % 3 = 1 THEN 'Mgr Smith' ELSE '(604) 555-0123' END
              WHEN 3 THEN CASE receipt_id % 5 WHEN 0 THEN mdy || ' 10:30' WHEN 1 THEN 'VERIFIED BY PIN ' || mdy2 || ' 10:00' WHEN 2 THEN 'Valid Feb 10 2026' WHEN 3 THEN '2026-02-21 09:15' ELSE '26/02/21' END
              WHEN 4 THEN '' ELSE CASE receipt_id % 7 WHEN 0 THEN 'All prices in CAD' WHEN 1 THEN 'EUR 1.00' WHEN 2 THEN '----' ELSE 'Item list' END END"""
ITEM_LINE = """CASE item_idx % 8
            WHEN 0 THEN CASE n WHEN 0 THEN pname ELSE CAST(cents {div} 100 AS {str}) || '.' || lpad(CAST(cents % 100 AS {str}), 2, '0') END
            WHEN 1 THEN CASE n WHEN 0 THEN pname || '  1.50' ELSE '3.00' END
            WHEN 2 THEN CASE n WHEN 0 THEN '4' || CAST(1000 + part % 900 AS {str}) || ' ' || pname || ' MRJ' ELSE '1. ' || CAST(100 + part % 800 AS {str}) || ' kg @ $ 1. 72 /kg ' || CAST(qty AS {str}) || '.25' END
            WHEN 3 THEN CASE n WHEN 0 THEN pname ELSE CAST(qty AS {str}) || '.160 kg @ $2.50/kg' END
            WHEN 4 THEN CASE n WHEN 0 THEN CAST(qty AS {str}) || '.75' ELSE '27-PRODUCE' END
            WHEN 5 THEN CASE n WHEN 0 THEN 'SUBTOTAL 12.00' ELSE 'Member Savings 1.00' END
            WHEN 6 THEN CASE n WHEN 0 THEN '' ELSE '****' END
            ELSE CASE n WHEN 0 THEN 'Terminal 7' ELSE lower(pname) || ' (' || ptype || ')' END END"""
LINES = f"""
SELECT receipt_id, CAST(n AS bigint) AS line_idx,
       {HEAD_LINE} AS line
FROM (SELECT receipt_id, min(mdy) AS mdy, min(mdy2) AS mdy2 FROM base GROUP BY receipt_id) r JOIN (SELECT 0 AS n UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) k ON n >= 0
UNION ALL
SELECT receipt_id, item_idx * 10 + n,
       {ITEM_LINE}
FROM base JOIN (SELECT 0 AS n UNION ALL SELECT 1) k ON n >= 0"""

#: The same lines for Spark in one pass over the items: the first item of a receipt also makes the lines above.
LINES_SPARK = f"""
SELECT receipt_id, CAST(CASE WHEN head THEN n ELSE item_idx * 10 + n END AS bigint) AS line_idx, CASE WHEN head THEN {HEAD_LINE} ELSE {ITEM_LINE} END AS line
FROM (SELECT receipt_id, item_idx, part, pname, ptype, cents, qty, min(mdy) OVER (PARTITION BY receipt_id) AS mdy, min(mdy2) OVER (PARTITION BY receipt_id) AS mdy2 FROM base) r
JOIN (SELECT 0 AS n, true AS head UNION ALL SELECT 1, true UNION ALL SELECT 2, true UNION ALL SELECT 3, true UNION ALL SELECT 4, true UNION ALL SELECT 5, true UNION ALL SELECT 0, false UNION ALL SELECT 1, false) k ON NOT head OR item_idx = 1"""

#: And as one text a receipt, which gathers its items instead of its lines.
TEXTS_SPARK = f"""
SELECT receipt_id, array_join(concat(transform(sequence(0, 5), n -> {HEAD_LINE}), flatten(transform(array_sort(items), i -> i.lines))), {{nl}}) AS raw
FROM (SELECT receipt_id, min(mdy) AS mdy, min(mdy2) AS mdy2, collect_list(struct(item_idx, transform(sequence(0, 1), n -> {ITEM_LINE}) AS lines)) AS items FROM base GROUP BY receipt_id) r"""

#: One page per receipt. Words tilt with x; some lines nearly touch, some have no price, some are savings or noise, and short
#: tokens repeat on a page.
WORDS = """
SELECT receipt_id AS page_id, item_idx * 10 + w AS word_idx, item_idx AS line_idx,
       CASE w WHEN 0 THEN CASE WHEN item_idx % 7 <> 6 THEN pname WHEN part % 2 = 0 THEN 'COUPON SAVINGS' ELSE 'SUBTOTAL' END
              WHEN 1 THEN 'W' || CAST(part % 9 AS {str}) WHEN 2 THEN 'Q' || CAST(qty AS {str}) ELSE CAST(cents AS {str}) || '.00' END AS token,
       CAST(CASE w WHEN 0 THEN 60 WHEN 1 THEN 300 WHEN 2 THEN 560 ELSE 860 END + part % 7 AS double) AS x,
       CAST(item_idx * 40 - CASE WHEN item_idx % 7 = 5 THEN 30 ELSE 0 END + part % 5 + (receipt_id % 3) * CASE w WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END AS double) AS y,
       CAST(item_idx * 40 - CASE WHEN item_idx % 7 = 5 THEN 30 ELSE 0 END + part % 5 + (receipt_id % 3) * 3 AS double) AS line_y,
       CAST(1000 AS double) AS width, CAST(1000 AS double) AS height
FROM base JOIN (SELECT 0 AS w UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) k
  ON w = 0 OR (w = 1 AND item_idx % 3 = 1) OR (w = 2 AND item_idx % 7 NOT IN (2, 3)) OR (w = 3 AND item_idx % 4 > 0 AND item_idx % 7 NOT IN (2, 3))"""

LOGS = """
SELECT event_id, {iso} AS time,
       CASE WHEN event_id % 4 = 0 THEN 'adi_ocr' WHEN event_id % 4 = 3 THEN 'pipeline_complete' ELSE 'llm_extraction' END AS event,
       'trace' || CAST(user_id % 12 AS {str}) AS trace_id, 'img' || CAST(event_id % 40 AS {str}) || '.jpg' AS image_name,
       CASE WHEN user_id % 3 = 0 THEN 'clod' ELSE 'openrouter' END AS provider, CASE user_id % 3 WHEN 0 THEN 'gemma-3n-E4B-it' WHEN 1 THEN 'anthropic/claude-haiku-4.5' ELSE 'qwen/qwen-2.5-7b-instruct' END AS model,
       CAST(round(value * 10) AS bigint) AS latency_ms, event_type <> 'error' AS success, {k} AS input_tokens, {k} % 37 AS output_tokens, {k} % 9 AS items_extracted,
       CASE WHEN event_id % 7 > 0 THEN {k} * 11 END AS input_chars, CASE WHEN user_id % 15 IN (0, 1, 3, 6, 9, 12) THEN 'api' WHEN user_id % 5 <> 2 THEN 'estimate' END AS cost_source
FROM {events}"""

#: Ground truth, and an output with wrong names, prices and amounts, lost items and lost receipts.
TRUTH = """
SELECT CAST(receipt_id AS {str}) AS stem, item_idx, pname AS name, CAST(cents AS {str}) || '.00' || currency AS price, CAST(qty AS {str}) || ' LBS' AS amount, store, purchase_date,
       CASE WHEN receipt_id % 6 > 0 THEN CAST(receipt_id % 90 AS double) END AS latitude, CASE WHEN receipt_id % 8 > 0 THEN CAST(receipt_id % 170 AS double) END AS longitude
FROM base WHERE receipt_id % 5 > 0"""
OUTPUT = """SELECT CAST(receipt_id AS {str}) AS stem, item_idx, CASE item_idx % 11 WHEN 1 THEN pname || ' ' || ptype WHEN 2 THEN lower(pname) WHEN 3 THEN 'QQQQ' ELSE pname END AS name,
       CAST(cents + CASE WHEN item_idx % 11 = 4 THEN 1 ELSE 0 END AS {str}) || '.00' || currency AS price, CASE WHEN item_idx % 11 = 5 THEN '' ELSE CAST(qty AS {str}) || 'lb' END AS amount,
       CASE WHEN receipt_id % 4 = 0 THEN 'Other Place' ELSE store END AS store, replace(purchase_date, '.', '-') AS purchase_date,
       CASE WHEN receipt_id % 9 > 0 AND receipt_id % 12 > 0 THEN receipt_id % 90 + CASE WHEN receipt_id % 11 = 1 THEN 0.0625 ELSE 0.015625 END END AS latitude,
       CASE WHEN receipt_id % 16 > 0 THEN receipt_id % 170 - CASE WHEN receipt_id % 13 = 1 THEN 0.0625 ELSE 0.015625 END END AS longitude
FROM base WHERE item_idx % 11 <> 7 AND receipt_id % 7 > 0 AND receipt_id % 14 <> 1"""

#: The files of that output; a few have no text.
OUTPUT_FILES = "SELECT DISTINCT CAST(receipt_id AS {str}) AS stem, CASE WHEN receipt_id % 14 = 1 THEN 'empty' ELSE 'filled' END AS status FROM base WHERE receipt_id % 7 > 0"

FROM_BASE = {"items": ITEMS, "ocr_lines": LINES, "words": WORDS, "truth": TRUTH, "output": OUTPUT, "output_files": OUTPUT_FILES}
STAR = ["lineitem", "orders", "part", "customer", "nation", "events"]


def _rows(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    for mark, sql in SPARK.items():
        text = text.replace("{" + mark + "}", sql)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in STAR if "{" + t + "}" in text})


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of items, ocr_lines, words, truth, output, output_files, logs.

    Columns are computed once each, as those of a stored table would be, whatever the operators refer to. The receipt stays outside
    of that, so that Spark knows that a receipt's rows lie together.
    """
    from pyspark.sql import functions as F

    text = LOGS if name == "logs" else f"WITH base AS ({BASE_SPARK}) {(FROM_BASE | {'ocr_lines': LINES_SPARK})[name]}"
    rows = _rows(spark, sf_dir, text)
    return rows.select("receipt_id", F.inline(F.array(F.struct(*[c for c in rows.columns if c != "receipt_id"])))) if name in ("items", "ocr_lines") else rows


def ocr_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """receipt_id, ocr: the lines in order, and a spatial part for every other receipt."""
    from pyspark.sql import functions as F

    joined = _rows(spark, sf_dir, f"WITH base AS ({BASE_SPARK}) {TEXTS_SPARK}")
    spatial = F.concat(F.lit("\n---\n## SPATIAL LAYOUT\n"), F.upper("raw"))
    return joined.select("receipt_id", F.concat("raw", F.when(F.col("receipt_id") % 2 == 0, spatial).otherwise("")).alias("ocr"))


def duck(*names: str) -> str:
    """WITH clause that defines the derived tables (and ocr_texts) in DuckDB."""
    parts = []
    if any(n in FROM_BASE or n == "ocr_texts" for n in names):
        parts.append(f"base AS ({BASE})")
    for n in dict.fromkeys(["ocr_lines" if n == "ocr_texts" else n for n in names]):
        parts.append(f"{n} AS ({LOGS if n == 'logs' else FROM_BASE[n]})")
    if "ocr_texts" in names:
        parts.append("raw_texts AS (SELECT receipt_id, string_agg(line, chr(10) ORDER BY line_idx) AS raw FROM ocr_lines GROUP BY receipt_id)")
        parts.append("ocr_texts AS (SELECT receipt_id, raw, raw || CASE WHEN receipt_id % 2 = 0 THEN chr(10) || '---' || chr(10) || '## SPATIAL LAYOUT' || chr(10) || upper(raw) ELSE '' END AS ocr FROM raw_texts)")
    text = "WITH RECURSIVE " + ", ".join(parts)
    for mark, sql in (DUCK | {t: t for t in STAR}).items():
        text = text.replace("{" + mark + "}", sql)
    return text
