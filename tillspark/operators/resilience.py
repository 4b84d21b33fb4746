"""Routing, retries and circuit breaking over recorded outcomes, and the statistics of such runs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats


def lognormal_parameters(p50: Column, p95: Column) -> tuple[Column, Column]:
    """Mu and sigma of a lognormal with these percentiles."""
    mu = F.log(p50)
    return mu, (F.log(p95) - mu) / F.lit(1.645)


def sample_latency(p50: float, p95: float, seed: int) -> Column:
    mu, sigma = math.log(p50), (math.log(p95) - math.log(p50)) / 1.645
    return F.exp(F.lit(mu) + F.lit(sigma) * F.randn(seed))


def route(calls: DataFrame, strategy: str, *, order: str = "key") -> DataFrame:
    """Provider of each call. Rows: key, group, cheap_ok, cheap_items. Round-robin alternates by the parity of the key's place in its group."""
    if strategy in ("openrouter", "clod"):
        chosen = F.lit(strategy)
    elif strategy == "round-robin":
        place = F.row_number().over(Window.partitionBy("group").orderBy(order)) - 1
        chosen = F.when(place % 2 == 0, "openrouter").otherwise("clod")
    elif strategy == "cost-aware":
        chosen = F.when(F.col("cheap_ok") & (F.col("cheap_items") >= 2), "clod").otherwise("openrouter")
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return calls.withColumn("provider", chosen)


def cost_aware(cheap: DataFrame, costly: DataFrame, *, least_items: int = 2) -> DataFrame:
    """E3's chain over results: the cheap provider's where it succeeded with least_items or more, else the costly one's.

    Rows: key, ok, items and any other columns, the same on both sides. Adds provider; a failure of both is a row that isn't ok.
    """
    names = [c for c in cheap.columns if c != "key"]
    both = cheap.select("key", F.struct(*names).alias("c")).join(costly.select("key", F.struct(*names).alias("d")), "key", "left")
    enough = F.coalesce(F.col("c.ok") & (F.col("c.items") >= least_items), F.lit(False))
    chosen = F.when(enough, F.col("c")).otherwise(F.coalesce("d", "c"))
    provider = F.when(enough | F.col("d").isNull(), "clod").otherwise("openrouter")
    return both.select("key", provider.alias("provider"), chosen.alias("r")).select("key", "provider", "r.*")


def write_run(statistics: DataFrame, path: str, *, order: list[str]) -> None:
    """The statistics of a sweep as JSON lines and as a Markdown table, in two folders below path. A small result."""
    from ..sources.files import markdown_table

    statistics.coalesce(1).write.mode("overwrite").json(f"{path}/json")
    markdown_table(statistics, statistics.columns, order=order).select("report").write.mode("overwrite").text(f"{path}/markdown")


def injected_failure(key: Column, attempt: Column, percent: Column) -> Column:
    """A fault at a given rate, by arithmetic on the key, so a run can be repeated."""
    return F.pmod(key * 7919 + attempt * 104729, F.lit(100)) < percent


def retried(calls: DataFrame, *, attempts: int = 3, first_wait: float = 1.0, factor: float = 1.0) -> DataFrame:
    """E5: attempts until the first success; waits lie between attempts. Rows: key, percent. Adds ok, attempts, waited_s."""
    tries = F.transform(F.sequence(F.lit(1), F.lit(attempts)), lambda a: ~injected_failure(F.col("key"), a, F.col("percent")))
    at = F.array_position(tries, F.lit(True)).cast("int")
    used = F.when(at > 0, at).otherwise(F.lit(attempts))
    waits = F.aggregate(F.sequence(F.lit(0), F.lit(attempts)), F.lit(0.0), lambda s, k: s + F.when(k < used - 1, F.lit(first_wait) * F.pow(F.lit(factor), k)).otherwise(0.0))
    return calls.withColumn("ok", at > 0).withColumn("attempts", used).withColumn("waited_s", waits)


def breaker(events: DataFrame, *, threshold: int = 3, cooldown: int = 30) -> DataFrame:
    """Per provider, in order of time (seconds), the state before each call and whether the call went through.

    Closed until `threshold` failures in a row, open for `cooldown` seconds, then half open: a success closes it, and it takes
    `threshold` more failures to open again. A provider's calls follow each other, so one task walks them, in sorted batches and
    with a few numbers as its state; providers share the tasks. Rows: provider, t, seq, failed. tripped: the call opened it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = state = None
        fails = since = 0
        for b in batches:
            out = []
            for provider, t, failed in zip(*(b.column(c).to_pylist() for c in ("provider", "t", "failed")), strict=True):
                if of is None or provider != of[0]:
                    of, state, fails, since = (provider,), "closed", 0, 0
                if state == "open" and t - since >= cooldown:
                    state, fails = "half-open", 0
                before, passed = state, state != "open"
                if passed:
                    fails = fails + 1 if failed else 0
                    if fails >= threshold:
                        state, since = "open", t
                    elif not failed:
                        state = "closed"
                out.append((before, passed, passed and state == "open"))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.bool_(), pa.bool_()), strict=True)] if out else None
            if columns:
                yield pa.RecordBatch.from_arrays([b.column("provider"), b.column("seq"), *columns], names=["provider", "seq", "state", "passed", "tripped"])

    kind = events.schema["provider"].dataType.simpleString()
    rows = events.select("provider", F.col("t").cast("long").alias("t"), F.col("seq").cast("long").alias("seq"), F.coalesce("failed", F.lit(False)).alias("failed"))
    ordered = rows.repartition("provider").sortWithinPartitions("provider", "t", "seq")
    return ordered.mapInArrow(run, f"provider {kind}, seq long, state string, passed boolean, tripped boolean")


def run_statistics(rows: DataFrame, by: list[str], *, throughput: bool = False) -> DataFrame:
    """Of calls with ok, latency_ms, attempts: success rate, P50 of successes, P99 of all, mean attempts, the
    breaker's trips where rows have tripped, and with throughput the calls a minute that their latencies allow one after another."""
    pace = [F.round(F.lit(60000.0) * F.count(F.lit(1)) / F.sum("latency_ms"), 6).alias("per_minute")] if throughput else []
    trips = [F.count_if("tripped").alias("trips")] if "tripped" in rows.columns else []
    means = rows.groupBy(*by).agg(
        F.round(stats.rate(F.col("ok")), 6).alias("success_pct"),
        F.round(F.avg("attempts"), 6).alias("avg_attempts"),
        *pace,
        *trips,
    )
    p50 = stats.indexed_percentile(rows.where("ok"), by, "latency_ms", 0.50, "p50_ms")
    return means.join(p50, by, "left").join(stats.indexed_percentile(rows, by, "latency_ms", 0.99, "p99_ms"), by, "left")


def run_averages(runs: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Means over the runs that have a value."""
    return runs.groupBy(*by).agg(*[F.round(F.avg(m), 6).alias(m) for m in measures])


def cyclic(available: DataFrame, n: int, *, order: str) -> DataFrame:
    """The rows of a list again and again until there are n. available is a small list: its size is counted, not collected."""
    placed = available.withColumn("_i", F.row_number().over(Window.orderBy(order)) - 1)
    size = available.count()
    return available.sparkSession.range(n).withColumnRenamed("id", "place").withColumn("_i", (F.col("place") % F.lit(max(1, size))).cast("int")).join(placed, "_i").drop("_i")


def micro_batches(rows: DataFrame, size: int, *, by: list[str], order: str) -> DataFrame:
    """The batch number of each row, in order."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1) / size))


def suppress_repeats(rows: DataFrame, column: str, *, by: list[str], order: list[str]) -> DataFrame:
    """A table's column with values that repeat the row above left out."""
    before = F.lag(column).over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("shown", F.when(before.eqNullSafe(F.col(column)), "").otherwise(F.col(column).cast("string")))


def batch_outcome(results: DataFrame, by: list[str]) -> DataFrame:
    """A15."""
    ok, n = F.count_if("success"), F.count(F.lit(1))
    return results.groupBy(*by).agg((ok == n).alias("success"), F.concat(ok.cast("string"), F.lit("/"), n.cast("string"), F.lit(" succeeded")).alias("message"))
