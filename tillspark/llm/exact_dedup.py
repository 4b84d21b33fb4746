"""Exact de-duplication in DataFrame functions only.

A document's text is reduced to a 128-bit content hash. Grouping by (hash, text) compares the bytes inside each hash group,
so two texts that collide never share a class. Map-side combining collapses copies before the shuffle, so a group that holds
a third of all rows reaches the reducers as at most one row per task. Verdicts return to the documents by a join of narrow
columns on the hash; only groups of two or more take part, and adaptive execution splits a hot hash there.

Defined results: a null text counts as empty; ties cannot occur because ids are compared; rows that repeat an id together
with its text are one document stored several times: each counts in group_size and all get the same verdict in
`exact_dedup`, while `unique_rows` keeps exactly one row per text. Rows with a null id take part and stay only if no row of
their group has an id; keep_id is then null. Texts of any length are hashed and compared whole. An empty table gives an empty result. Other columns are ignored, whatever their
names, by `exact_dedup`, and carried along by `unique_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty


def _hashed(docs: DataFrame, id_col: str, text_col: str, normalise) -> DataFrame:
    text = normalise(text_or_empty(text_col)) if normalise else text_or_empty(text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    return narrow.withColumn("_h", F.unhex(F.md5(F.col("_text").cast("binary"))))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise=None) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256.

    keep: "smallest" or "largest" id of a group of equal texts stays. normalise: Column -> Column applied before comparison.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    pick: Column = (F.min if keep == "smallest" else F.max)("doc_id")
    rows = _hashed(docs, id_col, text_col, normalise)
    classes = rows.groupBy("_h", "_text").agg(pick.alias("_keep"), F.count(F.lit(1)).alias("_n"))
    # One narrow row for each class; classes of a colliding hash carry a second digest that tells them apart.
    per_hash = classes.select("_h", "_keep", "_n", F.sha2(F.col("_text").cast("binary"), 256).alias("_sha")).where("_n > 1")
    left = rows.select("doc_id", "_h", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"))
    joined = left.join(per_hash, (left["_h"] == per_hash["_h"]) & (left["text_sha256"] == per_hash["_sha"]), "left")
    size = F.coalesce(F.col("_n"), F.lit(1).cast("long"))
    keep_id = F.when(F.col("_n").isNull(), F.col("doc_id")).otherwise(F.col("_keep"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        size.alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def unique_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """docs with one row left of each group of equal texts: all its columns, the row of the smallest (or largest) id.

    Rows that tie on the id are told apart by their other columns' values, so the outcome does not depend on row order.
    """
    names = docs.columns
    rest = [c for c in names if c not in (id_col, text_col)]
    pick = F.min if keep == "smallest" else F.max
    # Ids are compared first; nulls sort below every id for the largest and are replaced above every id for the smallest.
    first = F.col(id_col).isNull() if keep == "smallest" else F.col(id_col).isNotNull()
    # A struct of the narrow columns rides along as the aggregate's value; the text itself is the key.
    packed = docs.select(
        text_or_empty(docs[text_col]).alias("_text"),
        docs[text_col].isNull().alias("_null"),
        F.struct(first.alias("f"), docs[id_col].alias("i"), *[docs[c].alias(f"c{k}") for k, c in enumerate(rest)]).alias("_row"),
    ).withColumn("_h", F.unhex(F.md5(F.col("_text").cast("binary"))))
    best = packed.groupBy("_h", "_text").agg(pick("_row").alias("_row"), F.min("_null").alias("_null"))
    back = {id_col: F.col("_row.i"), text_col: F.when(F.col("_null") & (F.col("_text") == ""), F.lit(None).cast("string")).otherwise(F.col("_text"))}
    back |= {c: F.col(f"_row.c{k}") for k, c in enumerate(rest)}
    return best.select(*[back[c].alias(c) for c in names])
