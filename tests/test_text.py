"""Golden cases of the text operators, worked out by hand."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tillspark.functions import fixed as X
from tillspark.functions import stats
from tillspark.functions import text as T
from tillspark.operators import chunks, items


def value(spark, column_of, text):
    return spark.createDataFrame([(text,)], "t string").select(column_of(F.col("t")).alias("v")).first()["v"]


def weighed(spark, text):
    return items.weight_items(spark.createDataFrame([("r", text)], "receipt_id string, ocr string")).first()["items"]


@pytest.mark.parametrize(
    ("function", "text", "expected"),
    [
        (T.join_spaced_decimals, "1. 160 kg @ 1. 72", "1.160 kg @ 1.72"),
        (T.join_price_lines, "BANANAS\n2.00", "BANANAS  2.00"),
        (T.join_price_lines, "MILK 2.00\n3.00", "MILK 2.00"),
        (T.join_price_lines, "BREAD\n\n$4.10\nX", "BREAD  $4.10\n\nX"),
        (T.join_price_lines, "2.00\n3.00", "2.00"),
        (T.join_price_lines, "A\n1.00" + X.SPATIAL_MARKER + "B\n2.00", "A  1.00" + X.SPATIAL_MARKER + "B\n2.00"),
        (T.drop_noise_lines, "MILK\nSUBTOTAL 3\n****\nTAX 1\n**x", "MILK\n****"),
        (T.header_date, "on 1/3/2026", "2026.01.03"),
        (T.header_date, "13/02/05", "2013.02.05"),
        (T.header_date, "02/21/26", "2026.02.21"),
        (T.header_date, "02/03/04", None),
        (T.transaction_date, "01/03/26 10:00", "2026.01.03"),
        (T.transaction_date, "VERIFIED BY PIN 01/03/26 10:00", None),
        (T.transaction_date, "valid until 05/05/26 09:00" + "\n" + "x" * 90 + "\n2026-02-03 11:15", "2026.02.03"),
        (T.transaction_date, "21/02/2026 10:00", "2026.02.21"),
        (T.transaction_date, "on Feb 10 2026", "2026.02.10"),
        (T.transaction_date, "expires Feb 10 2026", None),
        (T.transaction_date, "01/03/19 10:00", None),
        (T.currency_in_text, "TOTAL CAD$ 3", "CAD"),
        (T.currency_in_text, "C$4 and EUR", "CAD"),
        (T.currency_in_text, "€ 4", "EUR"),
        (T.currency_in_text, "£ 4", "GBP"),
        (T.currency_in_text, "KROGER", "USD"),
        (T.currency_in_text, "nothing", None),
        (T.currency_of_store, "No Frills", "CAD"),
        (T.currency_of_store, "My Whole Foods", "USD"),
        (T.currency_of_store, None, None),
        (T.store_alias, " vons ", "Vons"),
        (T.store_alias, "Corner", "Corner"),
        (T.title_case, "wal-mart t&t", "Wal-Mart T&T"),
        (T.address_for_geocoder, "1 Main St\nTel: 5\n(714) 282-7064 x\nStore 2216", "1 Main St"),
        (T.name_key, "  Big   MILK ", "big milk"),
        (T.dedup_key, "Campbell's Soup", "campbellssoup"),
        (T.merge_name_key, "47825 GREEN GRAPES", "green grapes"),
        (T.merge_price_key, "11.99A", "11.99"),
        (T.date_key, "2026-01/03", "2026.01.03"),
        (T.eval_amount, "2 LBS", "2lbs"),
        (T.eval_amount, " Lbs ", "lb"),
        (T.price_cents, "11.99A", 1199),
        (T.price_cents, "1,299.00", 100),
        (T.price_cents, "free", None),
        (T.eval_price, "$1,299.00", 1299.0),
        (T.eval_price, "1.2.3", None),
        (T.bearer_token, "Bearer abc", "abc"),
        (T.bearer_token, "Bearer ", None),
        (T.model_slug, "anthropic/Claude-X", "claude-x"),
        (T.file_stem, "a/b.c.jpg", "b.c"),
        (T.file_stem, ".hidden", ".hidden"),
        (T.file_suffix, "x.JPG", ".jpg"),
        (T.model_json, "```json\n{\"a\": [1,],}\n```", '{"a": [1]}'),
        (T.model_json, "<json> {\"a\": 1,} </json>", '{"a": 1,}'),
        (T.model_json, "well {\"a\": 1} ok", '{"a": 1}'),
        (T.model_json, "  ", None),
        (T.is_garbled, "", True),
        (T.is_garbled, "euoju x", True),
        (T.is_garbled, "euoju 1", False),
        (T.is_garbled, "## %% a", True),
        (T.is_garbled, "Main Street", False),
        (T.row_label, "You Saved 2.00", "S"),
        (T.row_label, "MILK", "L"),
        (T.is_spatial_noise, "****", True),
        (T.is_spatial_noise, "Member Savings 1.00", False),
        (T.is_mostly_cjk, "牛奶 MILK", False),
        (T.is_mostly_cjk, "牛奶 M", True),
    ],
)
def test_scalar(spark, function, text, expected):
    assert value(spark, function, text) == expected


def test_weight_items(spark):
    text = "27-PRODUCE\n4011 BANANAS MRJ\n1. 160 kg @ $ 1. 72 /kg 2.00\nGRAPES\n0.500 kg @ $3.00/kg\nx\n1.50\n"
    assert [tuple(r) for r in weighed(spark, text)] == [("BANANAS", "1.160", "2.00"), ("GRAPES", "0.500", "1.50")]
    twice = "A\n1.0 kg @ $1.0/kg 1.00\na\n2.0 kg @ $1.0/kg 2.00"
    assert [tuple(r) for r in weighed(spark, twice)] == [("A", "2.0", "2.00")]


def test_address(spark):
    f = lambda t: value(spark, lambda c: T.address_from_text(c, F.lit("Vons")), t)
    assert f("VONS\n123 North Main Street\nSpringfield CA 90001") == "123 North Main Street, Springfield CA 90001"
    assert f("see 4500 W Springfield CA 90001").endswith("CA 90001")
    assert f("nothing here") == ""


def test_context(spark):
    text = "\n".join(f"line {i}" for i in range(20)) + "\nMILK\nend"
    assert value(spark, lambda c: T.line_context(c, F.lit("milk 2%")), text).split("\n") == ["line 17", "line 18", "line 19", "MILK", "end"]
    assert value(spark, lambda c: T.line_context(c, F.lit("zzz")), text) == text[:500]


def test_percentiles(spark):
    four = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int").withColumn("g", F.lit(1))
    assert tuple(stats.summary(four, ["g"], "x", median="p50", indexed={"p95": 0.95}).first()) == (1, 2.5, 4)
    two = spark.createDataFrame([(10,), (20,)], "x int").withColumn("g", F.lit(1))
    assert stats.indexed_percentile(two, ["g"], "x", 0.5, "p").first()["p"] == 20
    assert tuple(stats.summary(two, [], "x", median="p50").first()) == (15.0,)


def test_order_statistics_of_large_groups(spark):
    """Groups of continuous, repeated, skewed and equal values, large and small, null keys and values: as the sorted list has them."""
    rng = random.Random(9)
    groups = {
        "continuous": [rng.gauss(0, 1e6) for _ in range(3000)], "repeated": [float(rng.choice([1, 1, 1, 1, 2, 3, 50])) for _ in range(3000)], "skewed": [10.0 ** rng.uniform(-200, 200) for _ in range(3000)],
        "equal": [7.0] * 3000, "nearly": [7.0] * 2990 + [8.0 + k for k in range(10)], "small": [3.0, 1.0, 2.0], None: [rng.random() for _ in range(900)],
    }
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("small", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r["g"]: tuple(r)[1:] for r in stats.order_statistics(df, ["g"], "x", {"first": lambda n: n * 0, "mid": stats.lower_middle, "p95": stats.at_index(0.95), "last": lambda n: n - 1}, few=40, parts=8).collect()}
    want = {}
    for g, xs in groups.items():
        xs, n = sorted(xs), len(xs)
        want[g] = (xs[0], xs[(n - 1) // 2], xs[min(int(0.95 * n), n - 1)], xs[-1])
    assert got == want


def test_no_task_sorts_a_large_group(spark):
    df = spark.range(200_000).select(F.lit("all").alias("g"), F.hash("id").cast("double").alias("x"))
    found = stats.summary(df, ["g"], "x", median="p50", indexed={"p95": 0.95})
    values = sorted(r["x"] for r in df.collect())
    assert tuple(found.first()) == ("all", (values[99_999] + values[100_000]) / 2, values[190_000])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_chunks_cover_the_body(spark):
    raw = "\n".join(f"Header {i}" for i in range(6)) + "\n" + "\n".join(f"item number {i} " + "x" * 60 for i in range(60))
    df = spark.createDataFrame([("a", raw), ("b", "short")], "receipt_id string, ocr string")
    parts = [r["text"].split("\n") for r in chunks.split(df).where("receipt_id = 'a'").orderBy("chunk_idx").collect()]
    assert all(p[:6] == raw.split("\n")[:6] for p in parts)
    bodies = [p[6:] for p in parts]
    assert all(a[-6:] == b[:6] for a, b in zip(bodies, bodies[1:]))
    joined = bodies[0] + [line for b in bodies[1:] for line in b[6:]]
    assert joined == raw.split("\n")[6:]
    assert [r["text"] for r in chunks.split(df).where("receipt_id = 'b'").collect()] == ["short"]


def test_hallucination(spark):
    df = spark.createDataFrame([(["GREEN APPLES"], "green things"), (["BANANA"], "milk"), (["a b"], "milk"), ([], "x")], "n array<string>, o string")
    assert [r[0] for r in df.select(T.is_hallucinated(F.col("n"), F.col("o"))).collect()] == [False, True, False, False]


def folded_prices(text):
    """T2 line by line."""
    out, last = [], None
    for line in text.split("\n"):
        bare = line.strip()
        if not re.match(r"^\$?\d+\.\d{2}\s*$", bare) or last is None:
            out.append(line)
            last = len(out) - 1 if bare else last
        elif not re.search(r"\$?\d+\.\d{2}\s*$", out[last].rstrip()):
            out[last] = out[last].rstrip() + "  " + bare
    return "\n".join(out)


def folded_chunks(lines, most=700, overlap=6):
    done, now = [], []
    for line in lines:
        if now and sum(map(len, now)) + len(line) > most:
            done.append(now)
            now = now[-overlap:]
        now = [*now, line]
    return [*done, now] if now else done


def test_price_lines_against_a_fold(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["", " ", "MILK", "TEA ", "OAT 2.00", "3.00", "$4.10 ", " 5.25", "x 1.5", "\tRYE\t"]) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", T.join_price_lines(F.col("t")).alias("t"))
    assert {r["k"]: r["t"] for r in df.collect()} == dict(enumerate(map(folded_prices, texts)))


def test_receipts_of_a_hundred_thousand_lines(spark):
    """Chunks and price lines of one long text: the same rows as a fold, in time that is linear in the lines."""
    rng = random.Random(6)
    lines = [rng.choice(["", "3.00", "OAT MILK " * rng.randint(1, 5), "TEA  2.00"]) for _ in range(100_000)]
    text, began = "\n".join(lines), time.time()
    df = spark.createDataFrame([("a", text)], "receipt_id string, ocr string")
    assert df.select(T.join_price_lines(F.col("ocr"))).first()[0] == folded_prices(text)
    got = [r["text"] for r in chunks.split(df, with_header=False).orderBy("chunk_idx").collect()]
    assert time.time() - began < 40
    assert got == ["\n".join(c) for c in folded_chunks(lines[6:])]
