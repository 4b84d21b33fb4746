"""Files that appear whole or not at all, the error channel, and the chain of all stages."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillspark import channel, pipeline, storage
from tillspark.sources import fetch, files, journal, providers, sink


def tree(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def bodies(spark, n, tasks=4):
    rows = spark.range(n).repartition(tasks, "id")
    return rows.select(F.concat(F.lit("d"), F.col("id") % 3).alias("folder"), F.concat(F.lit("f"), "id", F.lit(".json")).alias("name"), F.concat(F.lit("body ü "), "id").alias("body"))


def test_files_for_rows(spark, tmp_path):
    assert sink.write_files(bodies(spark, 50), str(tmp_path)) == 50
    first = tree(tmp_path)
    assert first == {f"d{k % 3}/f{k}.json": f"body ü {k}".encode() for k in range(50)}
    assert sink.write_files(bodies(spark, 50, 7), f"file://{tmp_path}") == 50 and tree(tmp_path) == first  # byte by byte the same
    assert sink.write_files(bodies(spark, 0), str(tmp_path)) == 0 and tree(tmp_path) == first


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    sink.write_files(bodies(spark, 3), str(tmp_path))
    before = tree(tmp_path)
    broken = bodies(spark, 40).withColumn("body", F.when(F.col("name") == "f33.json", F.raise_error(F.lit("no body"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="no body"):
        sink.write_files(broken, str(tmp_path))
    assert tree(tmp_path) == before


def test_a_committed_write_is_finished_by_the_next(spark, tmp_path):
    spark.dataSource.register(sink.RowFiles)
    bodies(spark, 9).write.format("row_files").mode("append").option("job", "j1").save(str(tmp_path))
    stray = tmp_path / "_staging" / "j0" / "000000-1" / "d0"
    stray.mkdir(parents=True)
    (stray / "half.json").write_text("x")
    # The driver died here: all is staged, nothing is in its place; j0 never got so far.
    assert not [n for n in tree(tmp_path) if not n.startswith("_staging")]
    moved = next((tmp_path / "_staging" / "j1").glob("0*/d*/*.json"))
    (tmp_path / moved.parent.name).mkdir()
    moved.rename(tmp_path / moved.parent.name / moved.name)  # and one file had been moved already
    assert sink.publish(spark, str(tmp_path)) == 8
    sink.discard_unfinished(str(tmp_path))
    assert tree(tmp_path) == {f"d{k % 3}/f{k}.json": f"body ü {k}".encode() for k in range(9)}


def test_ocr_cache(spark, tmp_path):
    folder = str(tmp_path / "cache")
    assert files.read_ocr_cache(spark, folder).count() == 0
    texts = spark.createDataFrame([("a", "TEA 2.00\nend"), ("b.x", "ÖL")], "stem string, text string")
    assert files.write_ocr_cache(texts, folder) == 2
    assert sorted(map(tuple, files.read_ocr_cache(spark, folder).collect())) == [("a", "TEA 2.00\nend"), ("b.x", "ÖL")]


def test_routes(spark):
    rows = channel.opened(spark.range(100).withColumn("half", F.when(F.col("id") < 90, F.col("id") / 2)))
    rows = channel.failing(rows, "odd", F.col("id") % 2 == 1, F.concat(F.lit("odd "), "id"))
    rows = channel.failing(rows, "large", F.col("half") > 40, "large")
    good, failed, counts = channel.route(rows, "routes", ["odd", "large", "never"])
    assert counts == {"good": 46, "odd": 50, "large": 4} and good.columns == ["id", "half"]
    assert {r["id"] for r in good.collect()} == {k for k in range(0, 100, 2) if not 80 < k < 90}
    assert Counter(r["error"]["stage"] for r in failed.collect()) == {"odd": 50, "large": 4}
    assert channel.route(rows.where("error is null"), "routes", ["odd"])[1].count() == 0


TEXT = "VONS STORE #2216\n123 North Main Street\nSpringfield CA 90210\n02/21/26 10:30\n\nOAT MILK\n4.79\nGREEN TEA\nRYE BREAD\nLOST ITEM\nTOTAL 9.79"


def say(*names, price="4.79", **head):
    return json.dumps(head | {"items": [{"productName": n, "price": price} for n in names]})


def batch(spark):
    listed = spark.createDataFrame([(r, f"{r}.jpg") for r in ("good", "empty", "unread", "down", "broken", "made", "missing", "bare")], "receipt_id string, file string")
    texts = [("good", TEXT, True, None), ("empty", " \n", True, None), ("unread", None, False, "OCR timed out"), *[(r, TEXT, True, None) for r in ("down", "broken", "made", "bare")]]
    return listed, spark.createDataFrame(texts, "receipt_id string, ocr string, ok boolean, error string")


def tables(spark):
    keyed = lambda rows: spark.createDataFrame(rows, "receipt_id string, chunk_idx int, answer string")
    good = json.dumps({"storeName": "VONS", "storeAddress": "short", "items": [{"productName": "OAT MILK", "price": "4.79"}, *[{"productName": n, "price": None} for n in ("GREEN TEA", "RYE BREAD", "LOST ITEM")]]})
    first = keyed([("good", 0, good), ("broken", 0, "I can't read this"), ("made", 0, say("LASER PRINTER", storeName="VONS")), ("bare", 0, '{"storeName": "VONS", "items": []}')])
    indexed = lambda rows: spark.createDataFrame(rows, "receipt_id string, item_idx long, answer string")
    place = spark.createDataFrame([("Vons 123 North Main Street, Springfield CA 90210", '{"latitude": 34.5, "longitude": -118.25}')], "text string, answer string")
    return {
        "extract": first, "again": keyed([("made", 0, say("OAT MILK", storeName="VONS"))]), "repair": indexed([("good", 1, "about 2.5 dollars"), ("good", 2, "no idea")]),
        "escalate": indexed([("good", 2, "3.00"), ("good", 3, "none")]), "geocode": place,
    }


def test_chain(spark):
    listed, texts = batch(spark)
    rows, failed, counts = pipeline.extract(listed, texts, pipeline.recorded(tables(spark)))
    got = sorted((r["receipt_id"], r["name"], r["price"], r["latitude"], r["longitude"]) for r in rows.collect())
    at = (34.5, -118.25)
    assert got == [("good", "GREEN TEA", "2.50USD", *at), ("good", "OAT MILK", "4.79USD", *at), ("good", "RYE BREAD", "3.00USD", *at), ("made", "OAT MILK", "4.79USD", *at)]
    assert counts == {"good": 3, "read": 3, "model": 1, "answer": 1}
    outcome = pipeline.results(listed, failed)
    fine, why = ("ETL completed successfully", True), "Failed to parse data from source: "
    assert {r["file"]: (r["message"], r["success"]) for r in outcome.collect()} == {
        "good.jpg": fine, "made.jpg": fine, "bare.jpg": fine, "empty.jpg": (why + "the text is empty", False), "unread.jpg": (why + "OCR timed out", False),
        "missing.jpg": (why + "no text was read", False), "down.jpg": (why + "no answer recorded", False), "broken.jpg": (why + "the model's answer holds no JSON", False),
    }
    assert tuple(pipeline.summary(outcome).first()) == (False, "3/8 succeeded")
    assert tuple(pipeline.summary(outcome.where("success")).first()) == (True, "3/3 succeeded")
    assert tuple(pipeline.summary(outcome.where("false")).first()) == (False, "0/0 succeeded")


def test_chain_with_services_calls_each_once(spark, tmp_path):
    """With a provider that is down for one receipt, through the journal: a second run asks only for that one."""
    log, up = str(tmp_path / "log"), str(tmp_path / "up")

    def extract(text):
        with open(log, "a") as f:
            f.write("extract\n")
        if "DOWN" in text and not os.path.exists(up):
            raise ConnectionError("refused")
        return say("OAT MILK", storeName="VONS")

    never = lambda text: json.dumps(None)
    ask = pipeline.journalled(journal.Journal(spark, f"file://{tmp_path}/j"), dict.fromkeys(("again", "repair", "escalate", "geocode"), never) | {"extract": extract}, wait_s=0.0, attempts=2)
    listed = spark.createDataFrame([(r, r) for r in "abc"], "receipt_id string, file string")
    texts = spark.createDataFrame([("a", TEXT), ("b", TEXT), ("c", TEXT + "\nDOWN")], "receipt_id string, ocr string")
    rows, failed, counts = pipeline.extract(listed, texts, ask)
    assert counts == {"good": 2, "model": 1} and rows.count() == 2
    assert [r["error"]["message"] for r in failed.collect()] == ["ConnectionError: refused"]
    assert len(open(log).readlines()) == 3  # a and b ask the same, once; c twice
    open(up, "w").close()
    more = pipeline.journalled(journal.Journal(spark, f"file://{tmp_path}/j"), dict.fromkeys(("again", "repair", "escalate", "geocode"), never) | {"extract": extract}, wait_s=0.0, attempts=3)
    assert pipeline.extract(listed, texts, more)[2] == {"good": 3}
    assert len(open(log).readlines()) == 4


def test_uploads_in_outcomes(spark):
    listed, _ = batch(spark)
    failed = spark.createDataFrame([("down", ("model", "refused"))], f"receipt_id string, error {channel.ERROR}")
    uploads = spark.createDataFrame([("good", ["u1", "u2"], None), ("made", ["u3"], "1/2 items failed: gone")], "receipt_id string, ids array<string>, error string")
    got = {r["file"]: (r["success"], r["message"], r["registry"]) for r in pipeline.results(listed, failed, uploads).collect()}
    assert got["good.jpg"] == (True, "ETL completed successfully", ["u1", "u2"])
    assert got["made.jpg"] == (False, "Unexpected error during ETL process: 1/2 items failed: gone", None)
    assert got["down.jpg"] == (False, "Failed to parse data from source: refused", None)


def test_replies_of_both_providers(spark):
    reply = {"id": "g1", "choices": [{"message": {"content": "{}"}}], "usage": {"prompt_tokens": 1000, "completion_tokens": 200}}
    rows = [("openrouter", "m", reply), ("clod", "m", reply), ("clod", "x", {"choices": [{"message": {"content": None}}], "usage": {"prompt_tokens": 9}}), ("other", "m", reply), ("openrouter", "m", reply | {"usage": {"cost": 0.5}}), ("clod", "m", None)]
    df = spark.createDataFrame([(k, p, m, json.dumps(r) if r else "broken") for k, (p, m, r) in enumerate(rows)], "k int, provider string, model string, reply string")
    prices = spark.createDataFrame([("openrouter", "m", 1.0, 5.0), ("clod", "m", 2.0, 10.0)], "provider string, model string, rate_in double, rate_out double")
    got = [tuple(r) for r in providers.normalised(df, F.col("provider"), F.col("model"), prices).orderBy("k").select("raw", "input_tokens", "output_tokens", "generation_id", "cost_usd", "cost_source", "error").collect()]
    assert got == [
        ("{}", 1000, 200, "g1", 0.002, "estimate", None), ("{}", 1000, 200, None, 0.004, "estimate", None), ("", 0, 0, None, 0.0, "estimate", None),
        ("{}", 1000, 200, None, 0.0, "estimate", "Unknown provider: other"), ("{}", 0, 0, "g1", 0.5, "api", None), ("", 0, 0, None, 0.0, "estimate", None),
    ]
    assert storage.children("/nowhere/at/all") == []


def test_mixed_sources(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"a" * 1000)
    (tmp_path / "b.PNG").write_bytes(b"b" * 10)
    (tmp_path / "c.csv").write_text("never read")
    drive = "https://drive.google.com/file/d/F1/view?usp=x"
    sources = [f"{tmp_path}/a.jpg", f"file://{tmp_path}/b.PNG", f"{tmp_path}/c.csv", f"{tmp_path}/gone.jpg", "odd://x/y.jpg", "http://h/down.jpg", drive, f"{tmp_path}/a.jpg", None]

    def get(address):
        if "down.jpg" in address:
            raise TimeoutError("60 s")
        return address.encode()

    df = spark.createDataFrame([(s,) for s in sources], "source string")
    got = {r["source"]: (r["name"], bytes(r["content"]) if r["content"] is not None else None, (r["error"] or "").partition(":")[0]) for r in fetch.read_sources(df, fetch=get, task_bytes=100).collect()}
    assert got == {
        sources[0]: ("a.jpg", b"a" * 1000, ""), sources[1]: ("b.PNG", b"b" * 10, ""), sources[2]: ("c.csv", None, "not an image"), sources[3]: ("gone.jpg", None, "File not found"),
        sources[4]: ("y.jpg", None, "ArrowInvalid"), sources[5]: ("down.jpg", None, "TimeoutError"), drive: ("view.jpg", b"https://drive.google.com/uc?export=download&id=F1", ""), None: (None, None, "no source"),
    }
    assert fetch.read_sources(df.where("false")).count() == 0
