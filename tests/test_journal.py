"""The journal of calls: nothing that was paid for is paid for twice."""

import json
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillspark.sources import events, files, journal, store, uploads

REPO = Path(__file__).resolve().parents[1]


def logged(folder, kill_at=None, fail=()):
    """A provider that notes every call in a file of its own, and ends its process once at the call of kill_at."""
    folder = str(folder)

    def provider(row):
        if row["n"] == kill_at and not os.path.exists(f"{folder}/killed"):
            open(f"{folder}/killed", "w").close()
            os._exit(1)
        with open(f"{folder}/calls", "a") as f:
            f.write(f"{row['n']}\n")
        if row["n"] in fail:
            raise ValueError(f"no answer to {row['n']}")
        return {"twice": 2 * row["n"]}

    return provider


def asks(spark, ns):
    return spark.createDataFrame([(f"r{k}", n) for k, n in enumerate(ns)], "receipt string, n long")


HOW = {"stage": "s", "columns": ["n"], "schema": "twice long", "wait_s": 0.0}


def test_equal_requests_are_asked_once_and_answers_last(spark, tmp_path):
    j = journal.Journal(spark, f"file://{tmp_path}/j")
    provider = logged(tmp_path, fail=(3,))
    got = {r["receipt"]: (r["twice"], r["ok"], r["attempts"], r["error"]) for r in j.call(asks(spark, [1, 2, 2, 3]), provider, **HOW).collect()}
    failed = (None, False, 3, "ValueError: no answer to 3")
    assert got == {"r0": (2, True, 1, None), "r1": (4, True, 1, None), "r2": (4, True, 1, None), "r3": failed}
    assert Counter((tmp_path / "calls").read_text().split()) == {"1": 1, "2": 1, "3": 3}
    j.pack()
    again = {r["receipt"]: r["twice"] for r in j.call(asks(spark, [3, 2, 5]), provider, **HOW).collect()}
    assert again == {"r0": None, "r1": 4, "r2": 10}
    assert Counter((tmp_path / "calls").read_text().split()) == {"1": 1, "2": 1, "3": 3, "5": 1}
    assert j.call(asks(spark, []), provider, **HOW).count() == 0
    # Another stage asks for itself, and a run with more attempts goes on where the last one ended.
    assert [r["twice"] for r in j.call(asks(spark, [1]), provider, **HOW | {"stage": "t"}).collect()] == [2]
    assert [r["attempts"] for r in j.call(asks(spark, [3]), provider, **HOW, attempts=4).collect()] == [4]
    assert Counter((tmp_path / "calls").read_text().split()) == {"1": 2, "2": 1, "3": 4, "5": 1}


def test_a_run_that_dies_is_taken_up(spark, tmp_path):
    j = journal.Journal(spark, f"file://{tmp_path}/j")
    how = HOW | {"concurrency": 1, "flush_every": 1, "tasks": 2}
    with pytest.raises(Exception, match=r"(?s)."):
        j.call(asks(spark, range(20)), logged(tmp_path, kill_at=11), **how).collect()
    before = Counter((tmp_path / "calls").read_text().split())
    assert 0 < before.total() < 20
    got = {r["n"]: r["twice"] for r in j.call(asks(spark, range(20)), logged(tmp_path, kill_at=11), **how).collect()}
    assert got == {n: 2 * n for n in range(20)}
    assert Counter((tmp_path / "calls").read_text().split()) == {str(n): 1 for n in range(20)}


def test_a_task_that_dies_is_taken_up_by_its_next_attempt(tmp_path):
    """On executors of their own, where Spark runs a task again."""
    code = f"""
import sys
sys.path[:0] = [{str(REPO)!r}]
from pyspark.sql import SparkSession
from tests.test_journal import HOW, asks, logged
from tillspark.sources import events, files, journal, store, uploads
spark = SparkSession.builder.master("local[2, 3]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
j = journal.Journal(spark, "file://{tmp_path}/j")
rows = j.call(asks(spark, range(12)), logged({str(tmp_path)!r}, kill_at=7), **HOW | {{"concurrency": 1, "flush_every": 1}}).collect()
assert {{r["n"]: r["twice"] for r in rows}} == {{n: 2 * n for n in range(12)}}
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, env=os.environ | {"PYTHONPATH": str(REPO)})
    assert (tmp_path / "killed").exists()
    assert Counter((tmp_path / "calls").read_text().split()) == {str(n): 1 for n in range(12)}


def test_read_through_cache(spark, tmp_path):
    pages = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    cache = spark.createDataFrame([("a", "old text"), ("a", "old text")], "stem string, text string")
    ask = lambda rows: rows.select("stem", F.when(F.col("stem") != "c", F.concat(F.lit("new "), "stem")).alias("text"), (F.col("stem") != "c").alias("ok"), F.when(F.col("stem") == "c", "down").alias("error"))
    texts, new = journal.read_through(pages, cache, ask)
    assert sorted(map(tuple, texts.collect())) == [("a", "old text", True, None), ("b", "new b", True, None), ("c", None, False, "down")]
    assert list(map(tuple, new.collect())) == [("b", "new b")]
    texts, new = journal.read_through(pages, cache, ask, use_cache=False)
    assert sorted(r["stem"] for r in new.collect()) == ["a", "b"] and texts.count() == 3


def test_answers_that_were_cut_off_are_dropped(spark, tmp_path):
    folder = tmp_path / "j" / "answers" / "run=x"
    folder.mkdir(parents=True)
    row = {"call_key": "k", "stage": "s", "at": 2.0, "place": 0, "attempt": 1, "ok": True, "answer": '{"twice": 1}', "error": None}
    (folder / "part-00000-0-1").write_text(json.dumps(row) + "\n" + json.dumps(row)[:40])
    (folder / "_half").write_text("{")
    assert [r["answer"] for r in journal.resolve(journal.Journal(spark, f"file://{tmp_path}/j").attempts()).collect()] == ['{"twice": 1}']


FLAT = "receipt_id string, item_idx int, productName string, purchaseDate string, price string, amount string, storeName string, latitude double, longitude double"


def test_items_are_uploaded_once(spark, tmp_path):
    log = str(tmp_path / "sent")

    def send(row):
        with open(log, "a") as f:
            f.write(row["productName"] + "\n")
        if row["productName"] == "EGG":
            raise ConnectionError("gone")
        return {"id": f"{row['receipt_id']}-{row['item_idx']}"}

    item = lambda r, k, name: (r, k, name, "2026.01.03", "2.00USD", "1", "S", None, None)
    flat = [item("a", 0, "TEA"), item("a", 1, "OAT"), item("b", 0, "TEA"), item("b", 1, "EGG")]
    j = journal.Journal(spark, f"file://{tmp_path}/j")
    for _ in range(2):  # the second run sends nothing
        _, by = uploads.upload(j, spark.createDataFrame(flat, FLAT), send, wait_s=0.0)
        got = {r["receipt_id"]: (r["items_uploaded"], r["items_failed"], r["ids"], r["error"]) for r in by.collect()}
        assert got == {"a": (2, 0, ["a-0", "a-1"], None), "b": (1, 1, ["b-0"], "1/2 items failed: ConnectionError: gone")}
        assert Counter(open(log).read().split()) == {"TEA": 2, "OAT": 1, "EGG": 3}
    uploads.upload(j, spark.createDataFrame([item("a", 0, "GREEN")], FLAT), send, wait_s=0.0)[1].collect()
    assert Counter(open(log).read().split())["GREEN"] == 1


def test_tokens():
    assert [uploads.token_for(t, "env") for t in ("Bearer abc", "abc", "Bearer ", "", None)] == ["abc", "abc", "env", "env", "env"]


def rows_of(s):
    return {r["image_stem"]: r["ids"] for r in s.read().collect()}


def updates(spark, *rows):
    return spark.createDataFrame(list(rows), "image_stem string, ids array<string>, seq long")


def test_registry_keeps_the_last_write(spark, tmp_path):
    s = store.upload_registry(spark, f"file://{tmp_path}/r")
    assert rows_of(s) == {} and s.upsert(updates(spark), order="seq") == 0
    assert s.upsert(updates(spark, ("a", ["1"], 1), ("b", ["2"], 1), ("a", ["3"], 2), (None, ["x"], 1)), order="seq") == 1
    first = {p: p.read_bytes() for p in (tmp_path / "r").rglob("*.parquet")}
    assert s.upsert(updates(spark, ("b", [], 1), ("c", ["4", "5"], 1)), order="seq") == 2
    assert rows_of(s) == {"a": ["3"], "b": [], "c": ["4", "5"]}
    assert all(p.read_bytes() == body for p, body in first.items())  # copy on write: a reader of the first version still can
    s.clean()
    assert rows_of(s) == {"a": ["3"], "b": [], "c": ["4", "5"]}


def test_registry_survives_a_crash_and_a_broken_bucket(spark, tmp_path):
    s = store.KeyedStore(spark, f"file://{tmp_path}/r", "image_stem", "ids array<string>", buckets=4)
    s.upsert(updates(spark, *[(f"k{n}", ["1"], 1) for n in range(40)]), order="seq")

    class Dies(store.KeyedStore):
        def _switch(self, *_):
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        Dies(spark, s.root, "image_stem", "ids array<string>", buckets=4).upsert(updates(spark, ("k1", ["2"], 1)), order="seq")
    assert rows_of(s) == {f"k{n}": ["1"] for n in range(40)}
    s.upsert(updates(spark, ("k2", ["3"], 1)), order="seq")
    s.clean()
    assert rows_of(s) == {f"k{n}": ["3" if n == 2 else "1"] for n in range(40)}
    broken = next(p for p in (tmp_path / "r").rglob("*.parquet"))
    lost = {r["image_stem"] for r in spark.read.parquet(str(broken)).collect()}
    broken.write_bytes(b"no parquet at all")
    for crc in broken.parent.glob(".*.crc"):
        crc.unlink()
    assert 0 < len(lost) < 40 and set(rows_of(s)) == {f"k{n}" for n in range(40)} - lost
    again = sorted(lost)[0]
    s.upsert(updates(spark, (again, ["9"], 1)), order="seq")
    assert rows_of(s)[again] == ["9"] and set(rows_of(s)) == {f"k{n}" for n in range(40)} - lost | {again}


def test_events_of_five_kinds(spark, tmp_path):
    measures = "trace_id string, user_id string, image_name string, success boolean, llm_success boolean, ocr_success boolean, latency_ms double, items_attempted long, items_failed long, llm_input_tokens long, llm_cost_usd double, error string"
    rows = spark.createDataFrame([("t", "u", "a.jpg", True, True, True, 10.25, 3, 0, 7, 0.123456789, None), ("t", "u", "b.jpg", False, False, None, 10.35, 3, 1, None, None, "down")], measures)
    for kind in events.KINDS:
        files.write_logs(events.built(rows, kind), str(tmp_path))
    back = {(r["event"], r["image_name"]): r for r in files.read_logs(spark, str(tmp_path)).collect()}
    assert len(back) == 10 and all(r["service"] == "etl" and r["time"].endswith("+00:00") and r["trace_id"] == "t" for r in back.values())
    assert {(k, i): r["level"] for (k, i), r in back.items()} == {(k, i): "INFO" if i == "a.jpg" else events.KINDS[k].failed for k, i in back}
    assert [(back[k, "a.jpg"]["endpoint"], back[k, "a.jpg"]["status"], back[k, "b.jpg"]["status"]) for k in ("mcp_upload", "mcp_delete")] == [("POST /api/v1/receipts", 201, None), ("DELETE /api/v1/receipts/{id}", 200, None)]
    call = back["llm_extraction", "a.jpg"]
    assert tuple(call["usage"]) == (7, None, 7) and call["cost"]["total_usd"] == 0.12345679 and call["llm_cost_source"] == "unknown" and call["latency_ms"] is None
    assert back["mcp_upload", "a.jpg"]["latency_ms"] == 10.2 and back["mcp_upload", "b.jpg"]["error"] == "down"
