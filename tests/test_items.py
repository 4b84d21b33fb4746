"""Golden cases of item operators, scoring, resilience and layout."""

import math

import pytest
from pyspark.sql import functions as F

from tillspark.operators import chunks, evaluate, items, logs, resilience, spatial
from tillspark.sources import files, images, providers

SCHEMA = "receipt_id int, item_idx bigint, store string, purchase_date string, currency string, name string, code string, price string, amount string"


def rows(spark, *named):
    full = [(1, i, n.get("store", "Shop"), "2026.01.03", "USD", n.get("name"), n.get("code", ""), n.get("price"), n.get("amount", "1")) for i, n in enumerate(named)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.mark.parametrize(
    ("item", "expected"),
    [
        ({"name": "BANANA", "price": "1.00"}, None),
        ({"name": "OAT MILK", "price": "0.49"}, None),
        ({"name": "OAT MILK", "price": "0.50"}, ("OAT MILK", "0.50USD", "1")),
        ({"name": "OAT MILK", "price": "99.00"}, ("OAT MILK", "99.00USD", "1")),
        ({"name": "OAT MILK", "price": "99.01"}, None),
        ({"name": "OAT MILK", "price": "0.496"}, None),
        ({"name": "OAT MILK", "price": "99.004"}, None),
        ({"name": "OAT MILK", "price": "98.996"}, ("OAT MILK", "99.00USD", "1")),
        ({"name": "OAT MILK", "price": "123456789012345678.00"}, None),
        ({"name": "OAT MILK", "price": "1" * 60}, None),
        ({"name": "OAT MILK", "price": "11.99A"}, ("OAT MILK", "11.99USD", "1")),
        ({"name": "OAT MILK", "price": "4.79", "amount": "4.79 S"}, ("OAT MILK", "4.79USD", "1")),
        ({"name": "OAT MILK", "price": None, "amount": "4.79"}, ("OAT MILK", "4.79USD", "1")),
        ({"name": "OAT MILK", "price": "4.79", "amount": "2 EA"}, ("OAT MILK", "4.79USD", "2")),
        ({"name": "(SALE) OAT MILK", "price": "4.79"}, ("OAT MILK", "4.79USD", "1")),
        ({"name": "47825 GREEN GRAPES", "price": "4.79"}, ("GREEN GRAPES", "4.79USD", "1")),
        ({"name": "OAT MILK", "price": "2.675"}, ("OAT MILK", "2.68USD", "1")),
        ({"name": "SUBTOTAL", "price": "4.79"}, None),
        ({"name": "WWW.SHOP", "price": "4.79"}, None),
        ({"name": None, "price": "4.79"}, None),
        ({"name": "12 - 3.4", "price": "4.79"}, None),
        ({"name": "X" * 101, "price": "4.79"}, None),
    ],
)
def test_validate(spark, item, expected):
    got = [(r["name"], r["price"], r["amount"]) for r in items.validate(rows(spark, item)).collect()]
    assert got == ([expected] if expected else [])


def test_flatten_drops_and_is_idempotent(spark):
    df = rows(spark, {"name": "MILK OAT", "price": "4.79USD", "amount": ""}, {"name": "A", "price": "4.7USD"}, {"name": "donation", "price": "1.00USD"}, {"name": "milk", "price": "1.00USD"}, {"name": "SHOP CLUB", "price": "1.00USD"})
    once = items.flatten(df)
    assert [(r["name"], r["amount"]) for r in once.collect()] == [("MILK OAT", "1")]
    assert items.flatten(once).collect() == once.collect()


def test_fragments(spark):
    df = rows(spark, {"name": "EGGS", "price": "3.00USD"}, {"name": "EGGS LARGE", "price": "3.00USD"}, {"name": "eggs", "price": "3.00USD"}, {"name": "EGGS", "price": "4.00USD"})
    assert sorted((r["name"], r["price"]) for r in items.drop_fragments(df).collect()) == [("EGGS", "4.00USD"), ("EGGS LARGE", "3.00USD")]


def test_repeats(spark):
    df = rows(spark, {"name": "CAMPBELLS SOUP", "price": "2.00USD"}, {"name": "Campbell's Soup", "price": "2.00USD"}, {"name": "CAMPBELL SOUPS", "price": "2.00USD"}, {"name": "TEA", "code": "1", "price": "2.00USD"}, {"name": "TEA", "code": "2", "price": "2.00USD"})
    assert sorted(r["item_idx"] for r in items.drop_fuzzy_repeats(df).collect()) == [0, 3, 4]
    assert sorted(r["item_idx"] for r in items.drop_exact_repeats(df).collect()) == [0, 2, 3, 4]


def test_late_filter(spark):
    df = rows(spark, {"name": "CASHEWS"}, {"name": "MILK 3.25%"}, {"name": "7UP GINGER ALE"}, {"name": "x"}, {"name": "123456789"}, {"name": "GOOD TEA"})
    assert [r["name"] for r in items.late_filter(df).collect()] == ["GOOD TEA"]


def test_merge_scalars(spark):
    df = spark.createDataFrame([("r", 0, "S", None, "1"), ("r", 1, "T", "2026.01.03", "2"), ("r", 2, "U", "x", None)], "receipt_id string, chunk_idx int, store string, date string, total string")
    row = chunks.merge_scalars(df, first=["store"], first_filled=["date"], last=["total"]).first()
    assert (row["store"], row["date"], row["total"]) == ("S", "2026.01.03", "2")


def test_score_of_a_perfect_and_a_partial_output(spark):
    schema = "stem string, item_idx int, name string, price string, amount string, store string, purchase_date string"
    truth = spark.createDataFrame([("a", 0, "Oat Milk", "4.79USD", "1", "The Vons", "2026.01.03"), ("a", 1, "Tea", "2.00USD", "2 lbs", "The Vons", "2026.01.03")], schema)
    assert evaluate.scores(truth, truth).first()["overall"] == 100.0
    part = spark.createDataFrame([("a", 0, "oat  milk", "4.79", "", "Vons Store", "2026-01-03"), ("a", 1, "Tea Bags", "9.00", "", "Vons Store", "2026-01-03")], schema)
    row = evaluate.scores(truth.withColumn("latitude", F.lit(1.0)), part.withColumn("latitude", F.lit(1.03)).withColumn("longitude", F.lit(2.0))).first()
    assert not row["lat_ok"] and not row["lon_ok"] and row["overall"] == 56.25
    row = evaluate.scores(truth, part).first()
    assert (row["store_ok"], row["date_ok"], row["count_ok"], row["names"], row["prices"], row["amounts"]) == (True, True, True, 2, 1, 0)
    assert row["overall"] == 81.25


def test_latency_parameters(spark):
    mu, sigma = resilience.lognormal_parameters(F.lit(5000), F.lit(11000))
    row = spark.range(1).select(mu.alias("mu"), sigma.alias("sigma")).first()
    assert math.isclose(row["mu"], math.log(5000)) and math.isclose(row["sigma"], (math.log(11000) - math.log(5000)) / 1.645)


def test_breaker_trips_cools_and_half_opens(spark):
    fails = [(0, True), (1, True), (2, True), (3, False), (33, True), (34, True), (35, False), (36, True)]
    df = spark.createDataFrame([("p", t, k, f) for k, (t, f) in enumerate(fails)], "provider string, t long, seq long, failed boolean")
    got = [(r["state"], r["passed"]) for r in resilience.breaker(df).orderBy("seq").collect()]
    assert got == [("closed", True), ("closed", True), ("closed", True), ("open", False), ("half-open", True), ("half-open", True), ("half-open", True), ("closed", True)]
    assert [r["tripped"] for r in resilience.breaker(df).orderBy("seq").collect()] == [False, False, True] + [False] * 5


def page_words(spark, *lines):
    """lines: (line_y, (token, x, y), ...) of one page of 100 x 100, so the tolerance is 1.5."""
    words, k = [], 0
    for i, (line_y, *tokens) in enumerate(lines):
        for token, x, y in tokens:
            words.append(("p", k, i, token, float(x), float(y), float(line_y), 100.0, 100.0))
            k += 1
    return spark.createDataFrame(words, "page_id string, word_idx long, line_idx long, token string, x double, y double, line_y double, width double, height double")


def spatial_lines(spark, *lines):
    return spatial.spatial_text(page_words(spark, *lines)).first()["spatial"].split("\n")


def test_anchored_rows(spark):
    words = page_words(spark, *((y, (f"t{y}", 0, y)) for y in (0, 1.2, 2.4)), (90, ("9", 80, 90)))
    assert [e["row"] for e in spatial.layout(words).first()["l"]] == [0, 0, 1]


def test_token_below_all_rows_goes_to_the_topmost(spark):
    words = page_words(spark, (10, ("A", 0, 10)), (50, ("B", 0, 50)), (95, ("1", 80, 95)), (30, ("2", 80, 30)))
    assert {e["text"]: e["row"] for e in spatial.layout(words).first()["r"]} == {"1": 0, "2": 1}


def test_words_of_pages(spark):
    from tillspark.schemas import OCR_PAGE

    word = lambda i, t, x, y: (i, t, [x, y, x + 10, y, x + 10, y + 10, x, y + 10])
    page = ("p", 0, 100.0, 100.0, [word(0, "MILK", 5.0, 5.0), word(1, "2.00", 80.0, 5.0)], [word(0, "MILK 2.00", 5.0, 5.0)])
    got = spatial.words_of_pages(spark.createDataFrame([page], OCR_PAGE)).orderBy("word_idx").collect()
    assert [(r["token"], r["x"], r["y"], r["line_idx"], r["line_y"]) for r in got] == [("MILK", 5.0, 10.0, 0, 10.0), ("2.00", 80.0, 10.0, 0, 10.0)]


def test_logs_round_trip(spark, tmp_path):
    (tmp_path / "etl_2026-01-03.jsonl").write_text('{"time": "2026-01-03T00:00:00", "event": "adi_ocr", "ocr_success": true}\n\nbroken\n{"time": "2026-01-03T00:00:01", "event": "llm_extraction"}\n')
    events = files.read_logs(spark, str(tmp_path))
    assert sorted(r["event"] for r in events.collect()) == ["adi_ocr", "llm_extraction"]
    files.write_logs(events, str(tmp_path / "out"))
    files.write_logs(events, str(tmp_path / "out"))
    assert sorted(map(str, files.read_logs(spark, str(tmp_path / "out")).collect())) == sorted(2 * list(map(str, events.collect())))


def test_receipts_written_and_read_back(spark, tmp_path):
    schema = "stem string, item_idx int, productName string, purchaseDate string, price string, amount string, storeName string, latitude double, longitude double"
    flat = spark.createDataFrame([("a", 1, "TEA", None, "2.00USD", "1", "S", None, None), ("a", 0, "OAT", None, "3.00USD", "1", "S", 1.5, 2.5), ("b", 0, "EGG", None, "4.00USD", "2", "S", None, None)], schema)
    for provider, model in (("openrouter", "x/Model-A"), ("clod", "Model-B"), ("clod", "Model-B")):
        assert files.write_receipts(flat, str(tmp_path), provider=provider, model=F.lit(model)) == 2
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.json")) == ["clod-model-b/a.json", "clod-model-b/b.json", "openrouter-model-a/a.json", "openrouter-model-a/b.json"]
    assert not [p for p in tmp_path.rglob("*") if p.is_file() and p.suffix != ".json"] and not list((tmp_path / "_staging").iterdir())
    back = {r["stem"]: [i["productName"] for i in r["items"]] for r in files.read_items(spark, str(tmp_path / "clod-model-b")).collect()}
    assert back == {"a": ["OAT", "TEA"], "b": ["EGG"]}


def test_content_types(spark):
    names = {"a.JPG": "image/jpeg", "a.png": "image/png", "a.tif": "image/tiff", "a.gif": "image/jpeg", "a": "image/jpeg", "a.heic": "image/jpeg"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r["n"]: r["t"] for r in df.select("n", files.content_type(F.col("n")).alias("t")).collect()} == names


def test_statuses_of_outputs(spark):
    truth = spark.createDataFrame([(s, 0) for s in "abcd"], "stem string, item_idx int")
    output = spark.createDataFrame([("a", 0), ("a", 1)], "stem string, item_idx int")
    listed = spark.createDataFrame([("a", "filled"), ("b", "empty"), ("c", "filled")], "stem string, status string")
    got = {r["stem"]: (r["out_items"], r["status"]) for r in evaluate.statuses(truth, output, listed).collect()}
    assert got == {"a": (2, "scored"), "b": (None, "empty output"), "c": (0, "scored"), "d": (None, "no output")}


def test_labels_of_cost_sources(spark):
    from tillspark.functions import stats

    rows_ = [("a", "api", True), ("a", None, False), ("b", "api", True), ("b", None, True), ("c", None, True), ("d", "estimate", True)]
    df = spark.createDataFrame(rows_, "g string, s string, ok boolean")
    assert {r["g"]: r["l"] for r in df.groupBy("g").agg(stats.cost_source_label(F.col("s"), F.col("ok")).alias("l")).collect()} == {"a": "api", "b": "mixed", "c": "est", "d": "est"}


def test_dollars(spark):
    df = spark.createDataFrame([(0.00385,), (0.0,), (None,)], "c double")
    assert [r[0] for r in df.select(logs.dollars(F.col("c"), 4)).collect()] == ["$0.0039", "$0.00", "—"]


def test_receipt_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"productName": "TEA", "latitude": 1.5}')
    (tmp_path / "b.json").write_text("")
    got = {r["stem"]: (r["status"], len(r["items"] or [])) for r in files.read_items(spark, str(tmp_path)).collect()}
    assert got == {"a": ("filled", 1), "b": ("empty", 0)}


def test_images(spark, tmp_path):
    for name in ("b.PNG", "a.jpg", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r["name"] for r in files.read_images(spark, str(tmp_path)).collect()) == ["a.jpg", "b.PNG"]
    sizes = iter([50, 40, 30, 20, 9])
    assert len(images.shrink(b"y" * 100, "a.png", lambda *_: b"z" * next(sizes), most=10)) == 9
    assert images.shrink(b"y", "a.png", None) == b"y"


def test_provider_failures_are_rows(spark):
    def provider(row):
        if row["id"] == 2:
            raise RuntimeError("down")
        return {"out": row["id"] * 10}

    got = {r["id"]: (r["out"], r["ok"], r["attempts"]) for r in providers.call_provider(spark.createDataFrame([(1,), (2,)], "id long"), provider, "out long", key="id", attempts=2, wait_s=0).collect()}
    assert got == {1: (10, True, 1), 2: (None, False, 2)}


def test_run_size_takes_the_smaller_of_equals(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 3), ("d", 5)], "trace_id string, calls long")
    assert logs.run_size(df).first()["run_size"] == 3


def test_continuations_join_the_row_above(spark):
    # Reach is 3 * 1.5 % of 100 = 4.5, from the first y of the row that is joined.
    left = [(y, (f"t{y}", 0, y)) for y in (10, 13, 14.6, 19, 30)]
    page = spatial.layout(page_words(spark, *left, (30, ("1", 80, 30)), (33, ("u", 0, 33)))).first()
    assert [e["row"] for e in page["lm"]] == [0, 0, 2, 2, 4, 5]


def test_prices_in_the_centre_keep_rows_apart(spark):
    got = spatial_lines(spark, (10, ("CREAM", 0, 10), ("2.99", 60, 10)), (13, ("BUTTER", 0, 13), ("3.99", 60, 13)), (90, ("9", 99, 90)))
    assert got == ["[L] CREAM  |  [C] 2.99  |  [R] 9", "[L] BUTTER  |  [C] 3.99"]


def test_close_names_are_printed_one_by_one(spark):
    got = spatial_lines(spark, (10, ("EGGS", 0, 10)), (11, ("MILK", 1, 11), ("2", 50, 11)), (11.2, ("3.99", 80, 11.2)))
    assert got == ["[L] EGGS", "[L] MILK  |  [C] 2  |  [R] 3.99"]
    got = spatial_lines(spark, (10, ("You", 0, 10), ("Saved", 5, 10)), (10.5, ("1.00", 80, 10.5)), (20, ("OAT", 0, 20), ("MILK", 8, 20), ("3", 50, 20), ("4.79", 80, 20)))
    assert got == ["[L] OAT MILK  |  [C] 3  |  [R] 1.00  |  [R] 4.79"]  # the savings line is noise here, its price finds the next row
    got = spatial_lines(spark, (10, ("Member", 0, 10), ("Savings", 5, 10), ("1.00", 80, 10)))
    assert got == ["[S] Member Savings  |  [R] 1.00"]
