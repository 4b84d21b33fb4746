"""Every query of the library against its SQL, other partition counts, the streaming form, and the import guard."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tillspark import plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
REPO = Path(__file__).resolve().parents[1]


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    text = lambda x: "null" if x is None else str(round(float(x), 6)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, duck, name):
    got = plans.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in plans.ORACLE_SQL:
        want = duck.execute(plans.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["flagship_store_totals", "w02_drop_fragments", "a06_a08_a09_j05_provider_summary", "g06_g07_layout"])
def test_partition_count_does_not_matter(spark, name):
    found = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(rows(plans.QUERIES[name](spark, SF).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


def test_filters_remove_rows(spark):
    from tillspark.operators import items
    from tillspark.plans.derive import derived
    from tillspark.plans.item_queries import valid_items

    valid = valid_items(spark, SF)
    flat = items.flatten(valid)
    counts = [derived(spark, SF, "items").count(), valid.count(), flat.count(), items.drop_fragments(flat).count()]
    assert counts == sorted(counts, reverse=True) and len(set(counts)) == 4


def test_line_context_covers_every_receipt(spark):
    """Against brute force over the whole texts, with those that carry a spatial layout."""
    from tillspark.plans.derive import ocr_texts

    def context(text):
        lines = text.splitlines()
        for k, line in enumerate(lines):
            if "MEMBER" in line.upper():
                return "\n".join(lines[max(0, k - 3) : k + 4])
        return text[:500]

    want = {r["receipt_id"]: context(r["ocr"]) for r in ocr_texts(spark, SF).collect()}
    got = {r["receipt_id"]: r["context"] for r in plans.QUERIES["t17_line_context"](spark, SF).collect()}
    assert got == want and any("SPATIAL LAYOUT" in c for c in got.values())


def test_stream_equals_batch(spark, tmp_path):
    from tillspark.streaming import logs

    src = tmp_path / "in"
    src.mkdir()
    line = '{"time": "2026-01-03T00:%02d:00", "event": "llm_extraction", "llm_provider": "p", "llm_model": "m", "llm_success": %s, "llm_latency_ms": %d}\n'
    (src / "etl_1.jsonl").write_text("".join(line % (k, "true" if k % 3 else "false", k) for k in range(20)) + "broken\n")
    out = str(tmp_path / "out")
    logs.run_available(logs.latency_windows(logs.read_stream(spark, str(src)), late="0 seconds"), out, str(tmp_path / "cp"))
    got = spark.read.parquet(out)
    assert got.agg({"calls": "sum"}).first()[0] in (15, 20)  # the last window stays open until a later event
    assert all(r["calls"] == 5 for r in got.collect())


def test_entry_works_without_the_corpus_operators(tmp_path):
    """The corpus subpackage and its pipeline can be deleted."""
    copy = tmp_path / "copy"
    copy.mkdir()
    for p in ("tillspark", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(REPO / p), str(copy)], check=True)
    subprocess.run(["rm", "-rf", str(copy / "tillspark" / "llm")], check=True)
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)


def test_extraction_from_recorded_answers(spark):
    import json

    from tillspark import pipeline

    text = "VONS STORE #2216\n123 North Main Street\n02/21/26 10:30\n\nH5\nH6\nOAT MILK\n4.79\nGRAPES RED\n1. 160 kg @ $ 1. 72 /kg 2.00\nTOTAL 6.79"
    answer = json.dumps({"storeName": "VONS", "currency": "CAD", "items": [{"productName": "OAT MILK", "price": "4.79", "amount": "1"}, {"productName": "GRAPES RED", "price": None}, {"productName": "TOTAL", "price": "6.79"}]})
    prepared = pipeline.prepare(spark.createDataFrame([("r", text)], "receipt_id string, ocr string"))
    answers = spark.createDataFrame([("r", 0, "Sure: " + answer), ("s", 0, "no json")], "receipt_id string, chunk_idx int, raw string")
    got = sorted((r["name"], r["price"], r["amount"], r["store"], r["purchase_date"]) for r in pipeline.structure(prepared, answers).collect())
    assert got == [("GRAPES RED", "2.00USD", "1.160 kg", "Vons", "2026.02.21"), ("OAT MILK", "4.79USD", "1", "Vons", "2026.02.21")]
