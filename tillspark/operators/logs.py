"""Reports over pipeline event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import stats
from ..functions import text as T


def price_book(spark: SparkSession) -> DataFrame:
    """M16; a fixed table of a few rows, so joins may broadcast it."""
    return spark.createDataFrame(X.PRICE_BOOK, "provider string, model string, rate_in double, rate_out double")


def with_cost(events: DataFrame, book: DataFrame | None = None) -> DataFrame:
    """Dollars of a call from its tokens; unknown models cost nothing."""
    book = book if book is not None else F.broadcast(price_book(events.sparkSession))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    cost = zero("input_tokens") / 1e6 * zero("rate_in") + zero("output_tokens") / 1e6 * zero("rate_out")
    return events.join(book, ["provider", "model"], "left").withColumn("cost_usd", cost).drop("rate_in", "rate_out")


def since(events: DataFrame, start: str) -> DataFrame:
    """instants are ISO strings and compare as such."""
    return events.where(F.col("time") >= start)


def traces(calls: DataFrame) -> DataFrame:
    """A10: trace_id with its last provider and model, number of calls and last time."""
    last = F.max_by(F.struct("provider", "model"), F.struct("time", "event_id"))
    return calls.groupBy("trace_id").agg(last.alias("p"), F.count(F.lit(1)).alias("calls"), F.max("time").alias("last_time")).select("trace_id", "p.provider", "p.model", "calls", "last_time")


def run_size(found: DataFrame) -> DataFrame:
    """A5: the most frequent number of calls of a trace; of equals the smaller. One row."""
    return found.groupBy("calls").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("calls", F.struct("n", -F.col("calls"))).alias("run_size"))


def recent_complete_traces(calls: DataFrame, keep: int = X.RUNS_PER_PROVIDER) -> DataFrame:
    """The latest `keep` complete traces of each provider and model."""
    found = traces(calls)
    complete = found.crossJoin(F.broadcast(run_size(found))).where("calls >= run_size")  # run_size is one row
    order = Window.partitionBy("provider", "model").orderBy(F.desc("last_time"), F.desc("trace_id"))
    return complete.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).select("trace_id", "provider", "model", "last_time", "place")


def of_traces(events: DataFrame, valid: DataFrame) -> DataFrame:
    """J6."""
    return events.join(valid.select("trace_id").distinct(), "trace_id", "left_semi")


def ocr_summary(ocr: DataFrame) -> DataFrame:
    ok = ocr.where("success")
    lat, one = F.col("latency_ms"), ok.withColumn("_g", F.lit(1))
    means = one.groupBy("_g").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(lat), 4).alias("avg_ms"), F.min(lat).alias("min_ms"), F.max(lat).alias("max_ms")
    )
    return means.join(stats.summary(one, ["_g"], "latency_ms", median="p50_ms", indexed={"p95_ms": 0.95}), "_g", "left").drop("_g")


def provider_summary(calls: DataFrame, pipeline: DataFrame) -> DataFrame:
    """One row per provider and model that has a success, with end-to-end figures of its pipeline events."""
    ok = F.col("success")
    lat = F.when(ok, F.col("latency_ms"))
    by = ["provider", "model"]
    own = calls.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(ok).alias("successes"),
        F.count_if(~ok).alias("errors"),
        F.round(F.avg(lat), 4).alias("avg_ms"),
        F.round(F.avg(F.when(ok, F.col("input_tokens"))), 4).alias("avg_in"),
        F.round(F.avg(F.when(ok, F.col("input_chars"))), 4).alias("avg_chars"),
        F.round(F.avg(F.when(ok, F.col("output_tokens"))), 4).alias("avg_out"),
        F.count_distinct(F.when(ok, F.col("image_name"))).alias("receipts"),
        F.round(F.sum(F.when(ok, F.col("cost_usd"))), 9).alias("total_cost"),
        stats.cost_source_label(F.col("cost_source"), ok).alias("cost_src"),
    ).where("successes > 0")
    own = own.join(stats.summary(calls.where(ok), by, "latency_ms", median="p50_ms", indexed={"p95_ms": 0.95}), by, "left")
    done = pipeline.where("success")
    e2e = stats.summary(done, by, "latency_ms", median="e2e_p50", indexed={"e2e_p95": 0.95})
    both = own.join(e2e, by, "left")
    return both.withColumn("cost_per", F.round(F.col("total_cost") / F.col("successes"), 9)).withColumn("per_minute", F.round(F.lit(60000) / F.col("e2e_p50"), 6)).withColumn("fail_pct", F.round(F.lit(100.0) * F.col("errors") / F.col("calls"), 6))


def count_accuracy(calls: DataFrame, truth_counts: DataFrame) -> DataFrame:
    """Per provider, receipts whose most frequent item count (ties: the smaller) is the true one, of those with a truth."""
    by = ["provider", "model", "image_name"]
    counts = calls.where("success").groupBy(*by, "items_extracted").agg(F.count(F.lit(1)).alias("n"))
    modal = counts.groupBy(*by).agg(F.max_by("items_extracted", F.struct("n", -F.col("items_extracted"))).alias("modal"))
    both = modal.withColumn("stem", T.file_stem(F.col("image_name"))).join(truth_counts, "stem")
    return both.groupBy("provider", "model").agg(F.count_if(F.col("modal") == F.col("truth")).alias("correct"), F.count(F.lit(1)).alias("checked"))


def latest_per(events: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """W5."""
    return events.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def per_receipt(calls: DataFrame, ocr: DataFrame, truth_counts: DataFrame) -> DataFrame:
    """Each call with the last OCR event of its image and trace, and the true item count."""
    last = latest_per(ocr, ["image_name", "trace_id"], [F.desc("event_id")]).select("image_name", "trace_id", F.col("latency_ms").alias("ocr_ms"))
    both = calls.join(last, ["image_name", "trace_id"], "left").withColumn("stem", T.file_stem(F.col("image_name")))
    both = both.join(truth_counts, "stem", "left")
    mark = F.when(F.col("truth").isNull(), "—").when(F.col("truth") == F.col("items_extracted"), "✓").otherwise("✗")
    return both.select("event_id", "stem", "trace_id", "latency_ms", "ocr_ms", "items_extracted", "truth", mark.alias("mark"))


def dollars(cost: Column, digits: int) -> Column:
    """a cost with 4 or 6 digits; what costs nothing is shown short."""
    return F.when(cost > 0, F.format_string(f"$%.{digits}f", cost.cast("double"))).when(cost.isNotNull(), "$0.00").otherwise("—")


def display(rows: DataFrame) -> DataFrame:
    """text of a report's cells: thousands separators, a sign for slow calls, a dash for missing values."""
    shown = lambda c: F.coalesce(F.format_number(F.round(c).cast("bigint"), 0), F.lit("—"))
    slow = F.when(F.col("latency_ms") > 60000, F.lit(" ⚠")).otherwise(F.lit(""))
    return rows.select("event_id", F.concat(shown(F.col("latency_ms")), slow).alias("latency"), shown(F.col("ocr_ms")).alias("ocr"), F.substring("trace_id", 1, 3).alias("source"))


def findings(summary: DataFrame) -> DataFrame:
    """Fastest (which is the primary), cheapest, fallbacks, and the providers' speed and throughput in order of speed.

    One row; the summary has a row per provider and model.
    """
    speed = F.coalesce("e2e_p50", "p50_ms")
    named = F.concat_ws("/", "provider", T.model_slug(F.col("model")))
    pace = F.coalesce(F.format_string("~%.0f/min", F.col("per_minute")), F.lit("—"))
    ordered = F.array_sort(F.collect_list(F.struct(speed.alias("s"), named.alias("n"), pace.alias("t"))))
    joined = lambda rows, text: F.array_join(F.transform(rows, text), ", ")
    return summary.agg(ordered.alias("_o"), F.min_by(named, F.struct(F.col("cost_per"), named)).alias("cheapest")).select(
        F.col("_o")[0]["n"].alias("fastest"), "cheapest", joined(F.col("_o"), lambda x: x["n"]).alias("by_speed"),
        joined(F.col("_o"), lambda x: F.concat(x["n"], F.lit(" "), x["t"])).alias("throughput"),
        joined(F.slice("_o", 2, F.greatest(F.size("_o") - 1, F.lit(0))), lambda x: x["n"]).alias("fallbacks"),
    )
