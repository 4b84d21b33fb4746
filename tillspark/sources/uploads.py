"""K4: items sent one by one, each once however often a run is taken up again, with the outcome of each receipt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import items
from .journal import Journal


def token_for(request_token: str | None, environment_token: str) -> str:
    """The request's own token, without its "Bearer " prefix, goes before the environment's."""
    return (request_token or "").removeprefix("Bearer ").strip() or environment_token


def upload(journal: Journal, flat: DataFrame, send: Callable[[dict], dict], *, attempts: int = 3, wait_s: float = 1.0, **how) -> tuple[DataFrame, DataFrame]:
    """Items (receipt_id, item_idx and the output columns) through `send`, which gets the five uploaded columns and the item's place and
    returns {"id": ...}; and per receipt: items_attempted, items_uploaded, items_failed, ids in order of items, error where any failed.

    The journal knows an item by receipt, place and content: a changed item is sent again, an unchanged one isn't.
    """
    rows = items.upload_rows(flat)
    sent = journal.call(rows, send, stage="upload", columns=rows.columns, schema="id string", attempts=attempts, wait_s=wait_s, **how)
    return sent, outcomes(sent)


def outcomes(results: DataFrame) -> DataFrame:
    """Per receipt, items attempted, uploaded and failed, the ids, and the error to raise where any failed. Rows: receipt_id, ok, error and,
    where there are any, item_idx and id."""
    ok = F.coalesce("ok", F.lit(False))
    numbers = [F.count(F.lit(1)).alias("items_attempted"), F.count_if(ok).alias("items_uploaded"), F.count_if(~ok).alias("items_failed")]
    ids = F.array_sort(F.collect_list(F.when(ok, F.struct("item_idx", "id")))) if "id" in results.columns else F.array().cast("array<struct<item_idx:int,id:string>>")
    by = results.groupBy("receipt_id").agg(*numbers, ids.alias("_ids"), F.min(F.when(~ok, F.col("error"))).alias("_first"))
    share = F.concat(F.col("items_failed").cast("string"), F.lit("/"), F.col("items_attempted").cast("string"))
    text = F.concat(share, F.lit(" items failed: "), F.coalesce("_first", F.lit("unknown")))
    return by.select("receipt_id", "items_attempted", "items_uploaded", "items_failed", F.col("_ids.id").alias("ids"), F.when(F.col("items_failed") > 0, text).alias("error"))
