"""Overlapping chunks of long texts, and the merge of what a model says about each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T
from .items import once


def needs_chunks(ocr: Column) -> Column:
    """C1."""
    return T.has_spatial(ocr) | (F.length(ocr) > X.CHUNK_THRESHOLD)


def chunk_header(ocr: Column) -> Column:
    """Lines that every chunk begins with: the first clean ones and the date, or the first six."""
    clean = F.slice(F.filter(F.slice(T.lines(T.raw_part(ocr)), 1, 10), lambda x: ~T.is_garbled(x)), 1, 3)
    date = T.header_date(T.raw_part(ocr))
    dated = F.when(date.isNull(), clean).otherwise(F.concat(clean, F.array(F.concat(F.lit("Purchase date: "), date))))
    return F.when(T.has_spatial(ocr), dated).otherwise(F.slice(T.lines(ocr), 1, X.CHUNK_HEADER))


def line_runs(sizes: Column) -> Column:
    """Which lines each chunk has, of the lines' lengths: array of (first, n), lines counted from 0.

    A fold over numbers alone: what it carries from line to line is a few of them and the list of chunks, whatever the texts.
    """

    def step(acc: Column, size: Column) -> Column:
        full = (acc["chars"] + size > X.CHUNK_CHARS) & (acc["n"] > 0)
        # tail: lengths of the last lines, which the next chunk repeats.
        kept = F.when(full, F.size(acc["tail"])).otherwise(acc["n"])
        chars = F.when(full, F.aggregate(acc["tail"], F.lit(0), lambda a, x: a + x)).otherwise(acc["chars"])
        tail = F.concat(acc["tail"], F.array(size))
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(F.struct(acc["first"].alias("first"), acc["n"].alias("n"))))).otherwise(acc["done"]).alias("done"),
            F.when(full, acc["first"] + acc["n"] - kept).otherwise(acc["first"]).alias("first"),
            (kept + 1).alias("n"),
            (chars + size).alias("chars"),
            F.slice(tail, F.greatest(F.lit(1), F.size(tail) - X.CHUNK_OVERLAP + 1), F.lit(X.CHUNK_OVERLAP)).alias("tail"),
        )

    zero, none = F.lit(0), F.array().cast("array<int>")
    start = F.struct(F.array().cast("array<struct<first:int,n:int>>").alias("done"), zero.alias("first"), zero.alias("n"), zero.alias("chars"), none.alias("tail"))
    last = lambda acc: F.when(acc["n"] > 0, F.concat(acc["done"], F.array(F.struct(acc["first"].alias("first"), acc["n"].alias("n"))))).otherwise(acc["done"])
    return F.aggregate(sizes, start, step, last)


def with_runs(texts: DataFrame, *, ocr_col: str = "ocr") -> DataFrame:
    """texts with `_head` and `_body`, arrays of lines, and `_runs`, the part of the body that each chunk has.

    Each array is made once for a text, and nothing is shuffled; a text that isn't chunked is one line of one chunk.
    """
    ocr = F.col(ocr_col)
    none = F.array().cast("array<string>")
    rows = once(texts, _whole=~needs_chunks(ocr), _head=F.when(needs_chunks(ocr), chunk_header(ocr)).otherwise(none))
    body = F.when(T.has_spatial(ocr), T.lines(T.spatial_part(ocr))).otherwise(F.slice(T.lines(ocr), X.CHUNK_HEADER + 1, 1 << 30))
    rows = once(rows, _body=F.when(F.col("_whole"), F.array(ocr)).otherwise(body))
    rows = once(rows, _body=F.when(F.size("_body") > 0, F.col("_body")).otherwise(F.array(ocr)))
    rows = once(rows, _sizes=F.transform("_body", F.length))
    return rows.withColumn("_runs", line_runs(F.col("_sizes"))).drop("_sizes", "_whole")


def split(texts: DataFrame, *, id_col: str = "receipt_id", ocr_col: str = "ocr", with_header: bool = True) -> DataFrame:
    """Id, chunk_idx, text. Time and memory are linear in a text's lines."""
    lines = lambda r: F.slice(F.col("_body"), r["first"] + 1, r["n"])
    text = lambda r: F.array_join(F.concat("_head", lines(r)) if with_header else lines(r), "\n")
    rows = once(with_runs(texts.select(id_col, ocr_col), ocr_col=ocr_col), _texts=F.transform("_runs", text))
    return rows.select(id_col, F.posexplode("_texts").alias("chunk_idx", "text"))


def first_items(items: DataFrame, *, keys: list[str], order: list[str]) -> DataFrame:
    """The first item of each name and price key within keys, in order."""
    w = Window.partitionBy(*keys, T.merge_name_key(F.col("name")), T.merge_price_key(F.col("price"))).orderBy(*order)
    return items.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_scalars(chunks: DataFrame, *, id_col: str = "receipt_id", first: list[str] = (), first_filled: list[str] = (), last: list[str] = ()) -> DataFrame:
    """C4: per receipt the first chunk's values, the first non-empty ones and the last non-null ones; one pass with partial aggregation."""
    aggs = [F.min_by(c, "chunk_idx").alias(c) for c in first]
    aggs += [F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("chunk_idx"))).alias(c) for c in first_filled]
    aggs += [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("chunk_idx"))).alias(c) for c in last]
    return chunks.groupBy(id_col).agg(*aggs)


def usage(calls: DataFrame, *, id_col: str = "receipt_id") -> DataFrame:
    """Tokens and cost of all calls for a receipt."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return calls.groupBy(id_col).agg(total("input_tokens"), total("output_tokens"), total("cost_usd"))
