"""An error channel beside the rows of a pipeline: a step that fails a row says so in the row, and the job goes on.

Rows carry `error`, struct<stage, message>, null while all is well. `failing` marks rows, the first failure staying; `route` writes all
rows once, the good and the failed ones to folders of their own, and counts failures by stage while it writes, so neither the split nor
the counts take another pass. What comes after reads the good folder alone; the failed rows are the quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import storage

ERROR = "struct<stage:string,message:string>"


def opened(rows: DataFrame) -> DataFrame:
    """rows, none of which has failed yet."""
    return rows if "error" in rows.columns else rows.withColumn("error", F.lit(None).cast(ERROR))


def failing(rows: DataFrame, stage: str, when: Column, message: Column | str) -> DataFrame:
    """Rows that hold `when` (null counts as no) fail at this stage, unless they failed before."""
    said = F.struct(F.lit(stage).alias("stage"), (F.lit(message) if isinstance(message, str) else message.cast("string")).alias("message"))
    return rows.withColumn("error", F.coalesce("error", F.when(F.coalesce(when, F.lit(False)), said)).cast(ERROR))


def route(rows: DataFrame, name: str, stages: list[str]) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The good rows without `error`, the failed ones with it, and the number of rows: good, and failed by stage."""
    spark, path, seen = rows.sparkSession, storage.fresh(rows.sparkSession, name), Observation(name)
    at = F.coalesce(F.col("error.stage"), F.lit(""))
    counts = [F.count_if(F.col("error").isNull()).alias("good"), *[F.count_if(at == s).alias(f"s{k}") for k, s in enumerate(stages)]]
    status = F.when(F.col("error").isNull(), "good").otherwise("failed")
    rows.observe(seen, *counts).withColumn("_status", status).write.partitionBy("_status").parquet(path)
    found = seen.get
    return _part(rows, path, "good").drop("error"), _part(rows, path, "failed"), {"good": found["good"], **{s: found[f"s{k}"] for k, s in enumerate(stages) if found[f"s{k}"]}}


def _part(rows: DataFrame, path: str, which: str) -> DataFrame:
    spark, folder = rows.sparkSession, f"{path}/_status={which}"
    return spark.read.schema(rows.schema).parquet(folder) if storage.exists(folder) else spark.createDataFrame([], rows.schema)
