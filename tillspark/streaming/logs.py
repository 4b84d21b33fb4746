"""Structured Streaming over event logs, beyond what batch reports need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOG_EVENT


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """Events of a folder of JSON lines as a stream; malformed lines are dropped."""
    rows = spark.readStream.schema(LOG_EVENT).option("mode", "DROPMALFORMED").json(path)
    return rows.where("event is not null")


def latency_windows(events: DataFrame, *, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Calls, failures and mean latency per provider, model and tumbling window; later events than the watermark are dropped."""
    timed = events.where("event = 'llm_extraction'").withColumn("ts", F.try_to_timestamp("time")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", window), "llm_provider", "llm_model").agg(F.count(F.lit(1)).alias("calls"), F.count_if(~F.col("llm_success")).alias("failures"), F.avg("llm_latency_ms").alias("avg_ms"))


def run_available(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> None:
    """Process what is there, write Parquet, and stop."""
    stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()
