"""Reports, settings, prompts, the command line, and the stages around providers."""

import json

from pyspark.sql import functions as F

from tillspark import __main__ as cli
from tillspark import pipeline, reports
from tillspark.config import Settings
from tillspark.operators import resilience
from tillspark.sources import providers, uploads


def test_settings():
    made = Settings.from_env({"LLM_PROVIDER": "OpenRouter", "CLOD_RETRIES": "5"}, root="/data/")
    assert (made.provider, made.retries, made.output_dir) == ("openrouter", 5, "/data/output")
    assert made.model() == made.openrouter_model and made.model("x") == "x" and made.model(provider="clod") == made.clod_model


def test_prompts(spark):
    spatial = "Costco\n---\n## SPATIAL LAYOUT\nx"
    df = spark.createDataFrame([(spatial, 1), (spatial, 2), ("Shop", 1)], "ocr string, n int")
    got = [r[0] for r in df.select(reports.prompt(F.col("ocr"), F.col("n"), "rules<steps>", "<steps>", {"costco": "codes"})).collect()]
    assert got == ["rulescodes", "rules<steps>codes", "rules<steps>"]


def receipt(*items):
    return json.dumps([{"productName": n, "price": p, "amount": "1", "storeName": "Vons Store", "purchaseDate": "2026.01.03"} for n, p in items])


def test_eval_command(spark, tmp_path, capsys):
    out, truth = tmp_path / "out", tmp_path / "truth"
    out.mkdir(), truth.mkdir()
    for stem in "abc":
        (truth / f"{stem}.json").write_text(receipt(("OAT MILK", "4.79USD"), ("TEA", "2.00USD")))
    (out / "a.json").write_text(receipt(("OAT MILK", "4.79USD"), ("TEA", "9.00USD")))
    (out / "b.json").write_text("")
    assert cli.main(["eval", str(out), str(truth)]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert "| a.jpg | 2 | ✓ | ✓ | ✓ | ✓ | ✓ | 2/2 | 1/2 | 2/2 | 93.8% |" in lines
    assert "| b.jpg | 2 | — | — | — | — | — | — | — | — | empty output |" in lines
    assert "| c.jpg | 2 | — | — | — | — | — | — | — | — | no output |" in lines
    assert lines[-1] == "**Avg score: 93.8%** over 1 receipts"


def test_report_command(spark, tmp_path, capsys):
    call = {"event": "llm_extraction", "llm_success": True, "llm_input_tokens": 100, "llm_output_tokens": 10, "llm_cost_usd": 0.004, "items_extracted": 3}
    events = [call | {"time": f"2026-01-03T00:0{k}:00", "trace_id": f"t{k}", "image_name": "a.jpg", "llm_provider": p, "llm_model": "x/M", "llm_latency_ms": ms, "llm_cost_source": s} for k, (p, ms, s) in enumerate((("clod", 100.0, "api"), ("openrouter", 90000.0, "estimate")))]
    events.append({"time": "2026-01-03T00:00:00", "event": "adi_ocr", "image_name": "a.jpg", "trace_id": "t0", "ocr_latency_ms": 5000.0, "ocr_success": True})
    (tmp_path / "etl_1.jsonl").write_text("\n".join(map(json.dumps, events)))
    assert cli.main(["report", str(tmp_path)]) == 0
    printed = capsys.readouterr().out
    assert "| clod | M | 1 | 0/1 (0%) | — | — | — | 100 | 100 | 100 | 100 | 10 | — | $0.0040 | api | $0.0040 | — |" in printed
    assert "| a.jpg | t1 | — | 90,000 ⚠ | 3 | — |" in printed and "| a.jpg | t0 | 5,000 | 100 | 3 | — |" in printed
    assert "- **Recommended primary:** clod/m" in printed and "- **Fallback:** openrouter/m" in printed
    assert cli.main(["report", str(tmp_path), "--out", str(tmp_path / "r")]) == 0
    assert sorted(p.name for p in (tmp_path / "r").glob("section=*")) == ["section=Findings", "section=LLM Provider Comparison", "section=OCR", "section=Per-Receipt Breakdown"]


def test_run_command(spark, tmp_path, capsys):
    cache, answers = tmp_path / "cache", tmp_path / "answers"
    cache.mkdir(), answers.mkdir()
    (cache / "a.txt").write_text("VONS STORE #2216\n123 North Main Street\n02/21/26 10:30\n\nOAT MILK\n4.79\nTOTAL 4.79")
    (cache / "b.txt").write_text("nothing")
    (answers / "x.json").write_text(json.dumps({"receipt_id": "a", "chunk_idx": 0, "raw": json.dumps({"storeName": "VONS", "currency": "USD", "items": [{"productName": "OAT MILK", "price": "4.79"}]})}))
    assert cli.main(["run", str(cache), str(answers), "--provider", "clod", "--model", "x/Model-B", "--out", str(tmp_path / "out")]) == 1
    assert capsys.readouterr().out.splitlines() == ["✓ a ETL completed successfully", "✗ b Failed to parse data from source: no answer recorded", "1/2 succeeded"]
    written = json.loads((tmp_path / "out" / "clod-model-b" / "a.json").read_text())
    assert [(i["productName"], i["price"], i["latitude"]) for i in written] == [("OAT MILK", "4.79USD", None)]


def test_answers_that_are_not_in_the_text_are_asked_again(spark):
    texts = spark.createDataFrame([("a", "OAT MILK 4.79"), ("b", "GREEN TEA 2.00"), ("c", "RYE BREAD")], "receipt_id string, ocr string")
    raw = lambda name: json.dumps({"items": [{"productName": name}]})
    schema = "receipt_id string, chunk_idx int, raw string"
    first = spark.createDataFrame([("a", 0, raw("OAT MILK")), ("b", 0, raw("LASER PRINTER")), ("c", 0, raw("LAPTOP"))], schema)
    again = spark.createDataFrame([("a", 0, raw("OTHER")), ("b", 0, raw("GREEN TEA")), ("c", 0, "no json")], schema)
    got = sorted((r["receipt_id"], r["raw"]) for r in pipeline.without_hallucinations(texts, first, again).collect())
    assert got == [("a", raw("OAT MILK")), ("b", raw("GREEN TEA")), ("c", raw("LAPTOP"))]


def test_repair_asks_then_escalates_then_drops(spark):
    schema = "receipt_id string, item_idx long, name string, price string, currency string"
    rows = spark.createDataFrame([("r", 0, "OAT MILK", "4.79USD", "USD"), ("r", 1, "GREEN TEA", None, "USD"), ("r", 2, "RYE", "null", "USD"), ("r", 3, "EGG", "", "USD")], schema)
    texts = spark.createDataFrame([("r", "OAT MILK 4.79\nGREEN TEA 2.0")], "receipt_id string, ocr string")
    asked = providers.repair_requests(rows, texts).orderBy("item_idx").collect()
    assert [r["item_idx"] for r in asked] == [1, 2, 3] and "GREEN TEA 2.0" in asked[0]["prompt"]
    answers = spark.createDataFrame([("r", 1, "about 2.0 dollars"), ("r", 2, "unknown")], "receipt_id string, item_idx long, answer string")
    more = spark.createDataFrame([("r", 1, "7"), ("r", 2, "3")], "receipt_id string, item_idx long, answer string")
    got = sorted((r["item_idx"], r["price"]) for r in providers.repair_prices(rows, answers, more).collect())
    assert got == [(0, "4.79USD"), (1, "2.00USD"), (2, "3.00USD")]
    assert sorted(r["item_idx"] for r in providers.repair_prices(rows, answers).collect()) == [0, 1]


def test_upload_outcomes_and_results(spark):
    tried = spark.createDataFrame([("a", True, None), ("a", False, "down"), ("b", True, None)], "receipt_id string, ok boolean, error string")
    got = {r["receipt_id"]: (r["items_attempted"], r["items_uploaded"], r["items_failed"], r["error"]) for r in uploads.outcomes(tried).collect()}
    assert got == {"a": (2, 1, 1, "1/2 items failed: down"), "b": (1, 1, 0, None)}


def test_cost_aware_chain(spark, tmp_path):
    schema = "key long, ok boolean, items int"
    cheap = spark.createDataFrame([(1, True, 5), (2, True, 1), (3, False, None), (4, False, None)], schema)
    costly = spark.createDataFrame([(1, True, 6), (2, True, 7), (3, True, 8)], schema)
    got = sorted((r["key"], r["provider"], r["ok"], r["items"]) for r in resilience.cost_aware(cheap, costly).collect())
    assert got == [(1, "clod", True, 5), (2, "openrouter", True, 7), (3, "openrouter", True, 8), (4, "clod", False, None)]
    runs = spark.createDataFrame([("p", 10.0, True, 1, False), ("p", 30.0, False, 3, True)], "g string, latency_ms double, ok boolean, attempts int, tripped boolean")
    stats = resilience.run_statistics(runs, ["g"])
    assert stats.first().asDict() == {"g": "p", "success_pct": 50.0, "avg_attempts": 2.0, "trips": 1, "p50_ms": 10.0, "p99_ms": 30.0}
    resilience.write_run(stats, str(tmp_path / "run"), order=["g"])
    assert spark.read.json(str(tmp_path / "run" / "json")).count() == 1 and spark.read.text(str(tmp_path / "run" / "markdown")).count() == 3


def test_report_with_truth_and_outputs(spark, tmp_path, capsys):
    """Truth counts in the provider table, and the accuracy of two providers with a finding on their prices."""
    truth, out = tmp_path / "truth", tmp_path / "out"
    for folder, price in ((truth, "2.00USD"), (out / "clod-m", "2.00USD"), (out / "openrouter-m", "9.00USD")):
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(receipt(("OAT MILK", "4.79USD"), ("TEA", price)))
    (truth / "b.json").write_text(receipt(("EGG", "1.00USD")))
    call = {"event": "llm_extraction", "llm_success": True, "llm_input_tokens": 100, "llm_output_tokens": 10, "llm_cost_usd": 0.004, "items_extracted": 2, "image_name": "a.jpg", "llm_latency_ms": 5.0}
    (tmp_path / "logs").mkdir()
    events = [call | {"time": f"2026-01-03T00:0{k}:00", "trace_id": f"t{k}", "llm_provider": p, "llm_model": "x/M"} for k, p in enumerate(("clod", "openrouter"))]
    (tmp_path / "logs" / "etl_1.jsonl").write_text("\n".join(map(json.dumps, events)))
    assert cli.main(["report", str(tmp_path / "logs"), "--truth", str(truth), "--output", str(out)]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert any(line.startswith("| clod | M | 1 |") and line.endswith("| 1/1 |") for line in lines)
    assert "| a.jpg | 2 | ✓ | ✓ | ✓ | ✓ | ✓ | 2/2 | 2/2 | 2/2 | 100.0% |" in lines and "| a.jpg | 2 | ✓ | ✓ | ✓ | ✓ | ✓ | 2/2 | 1/2 | 2/2 | 93.8% |" in lines
    assert sum(line.startswith("| b.jpg | 1 |") and line.endswith("| no output |") for line in lines) == 2
    assert lines[-5:] == [
        "- **clod-m**: 100% overall price match", "- **openrouter-m**: 50% overall price match", "Receipts with a ≥ 30 percentage-point price match gap:", "- **a:** clod-m 100% vs openrouter-m 50%",
        "openrouter-m is extracting per-unit rates or subtotals instead of line-item totals on multi-column receipts. clod-m handles these layouts correctly.",
    ]


def test_boxed_table(spark):
    rows = spark.createDataFrame([(2, ["ä", None]), (1, ["long cell", "1"])], "k int, cells array<string>")
    lines = [r["line"] for r in reports.boxed(rows, ("A", "Count"), ["k"]).orderBy("place").collect()]
    assert lines == ["+-----------+-------+", "| A         | Count |", "+-----------+-------+", "| long cell | 1     |", "| ä         | —     |", "+-----------+-------+"]
    assert [r["line"] for r in reports.boxed(rows.where("false"), ("A", "Count"), ["k"]).orderBy("place").collect()][1] == "| A | Count |"
