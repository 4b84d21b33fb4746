"""Command line.

    python -m tillspark list
    python -m tillspark QUERY SF_DIR [--limit N]
    python -m tillspark report LOG_DIR [--truth DIR] [--output DIR] [--out DIR]
    python -m tillspark eval OUTPUT_DIR TRUTH_DIR [--out DIR]
    python -m tillspark run OCR_CACHE_DIR ANSWERS_DIR [--provider P] [--model M] [--user U] [--logs DIR] [--out DIR]

`report` and `eval` print their report, or write it with --out; a report given --truth and --output compares item counts and adds the
accuracy of each provider. `run` takes cached OCR texts (STEM.txt) and recorded answers (JSON lines with raw and what they answer:
receipt_id and chunk_idx; with a stage of "again" too; "repair" and "escalate": receipt_id and item_idx; "geocode": text), writes a file
for each receipt, an event for each with --logs, and prints the outcome of each; it exits with 1 if any failed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pipeline, plans, reports, storage
from .config import Settings
from .functions import text as T
from .operators import items
from .sources import events, files

CALL = (
    "time", "trace_id", "image_name", "llm_provider provider", "llm_model model", "llm_latency_ms latency_ms", "llm_success success", "llm_input_tokens input_tokens",
    "llm_output_tokens output_tokens", "llm_input_chars input_chars", "llm_cost_usd cost_usd", "llm_cost_source cost_source", "items_extracted",
    "xxhash64(time, trace_id, image_name, llm_provider) event_id",
)
OCR = ("image_name", "trace_id", "ocr_latency_ms latency_ms", "ocr_success success", "xxhash64(time, trace_id, image_name) event_id")
END = ("llm_provider provider", "llm_model model", "total_latency_ms latency_ms", "success")


def log_report(spark: SparkSession, path: str, truth: str | None = None, output: str | None = None) -> DataFrame:
    logged = files.read_logs(spark, path)
    of = lambda kind, columns: logged.where(F.col("event") == kind).selectExpr(*columns)
    counts = reports.truth_counts(spark, truth) if truth else spark.createDataFrame([], "stem string, truth long")
    lines = reports.baseline(of("llm_extraction", CALL), of("adi_ocr", OCR), of("pipeline_complete", END), counts)
    return lines.unionByName(reports.accuracy(spark, output, truth)) if truth and output else lines


def show(lines: DataFrame, out: str | None) -> None:
    if out:
        reports.write_report(lines, out)
        return
    for row in lines.orderBy("section", "place").toLocalIterator():
        print(row["line"])


def run(spark: SparkSession, cache: str, answers: str, provider: str, model: str, out: str, user: str = "unknown", logs_dir: str | None = None) -> bool:
    """Receipts from cached texts and recorded answers to files; whether all succeeded."""
    texts = files.read_ocr_cache(spark, cache).withColumnRenamed("stem", "receipt_id").withColumnRenamed("text", "ocr")
    said = spark.read.schema("stage string, receipt_id string, chunk_idx int, item_idx long, text string, raw string").json(answers).withColumnRenamed("raw", "answer")
    said = said.withColumn("stage", F.coalesce("stage", F.lit("extract")))
    keys = {"extract": ["receipt_id", "chunk_idx"], "again": ["receipt_id", "chunk_idx"], "repair": ["receipt_id", "item_idx"], "escalate": ["receipt_id", "item_idx"], "geocode": ["text"]}
    tables = {stage: said.where(F.col("stage") == stage).select(*on, "answer").dropDuplicates(on) for stage, on in keys.items()}
    listed = storage.written(texts.select("receipt_id", F.col("receipt_id").alias("file")), "files")
    rows, failed, _ = pipeline.extract(listed, texts, pipeline.recorded(tables))
    flat = items.output_rows(rows).withColumnRenamed("receipt_id", "stem").withColumn("item_idx", F.col("item_idx").cast("long"))
    # Receipts that succeeded without items get a file too: an empty list.
    whole = listed.join(failed.select("receipt_id"), "receipt_id", "left_anti").select(F.col("receipt_id").alias("stem")).join(flat, "stem", "left")
    files.write_receipts(whole, out, provider=provider, model=F.lit(model))
    outcome = storage.written(pipeline.results(listed, failed), "outcomes")
    if logs_dir:
        failure = F.when(~F.col("success"), F.col("message"))
        ends = outcome.select("success", F.col("file").alias("image_name"), failure.alias("error"), F.lit(user).alias("user_id"), F.lit(provider).alias("llm_provider"), F.lit(model).alias("llm_model"))
        files.write_logs(events.built(ends, "pipeline_complete"), logs_dir)
    for row in outcome.orderBy("file").toLocalIterator():
        print("✓" if row["success"] else "✗", row["file"], row["message"])
    total = pipeline.summary(outcome).first()
    print(total["message"])
    return total["success"]


def main(argv: list[str] | None = None) -> int:
    settings = Settings.from_env()
    parser = argparse.ArgumentParser(prog="tillspark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", help="a query's name, list, report, eval or run")
    parser.add_argument("paths", nargs="*")
    parser.add_argument("--limit", type=int, default=20)
    parser.add_argument("--out")
    parser.add_argument("--provider", default=settings.provider, choices=("openrouter", "clod"))
    parser.add_argument("--model")
    parser.add_argument("--user", default="unknown")
    parser.add_argument("--logs")
    parser.add_argument("--truth")
    parser.add_argument("--output")
    args = parser.parse_args(argv)
    if args.command == "list":
        print("\n".join(plans.QUERIES))
        return 0
    spark = SparkSession.builder.appName("tillspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "report":
        show(log_report(spark, args.paths[0], args.truth, args.output), args.out)
    elif args.command == "eval":
        show(reports.evaluation(spark, *args.paths[:2]), args.out)
    elif args.command == "run":
        return 0 if run(spark, *args.paths[:2], args.provider, settings.model(args.model, args.provider), args.out or settings.output_dir, args.user, args.logs) else 1
    else:
        plans.QUERIES[args.command](spark, *args.paths[:1]).show(args.limit, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
