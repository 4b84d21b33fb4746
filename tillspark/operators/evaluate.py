"""Scoring of extracted items against ground truth. Rows: stem, item_idx, name, price, amount, store, purchase_date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T


def statuses(truth: DataFrame, output: DataFrame, files: DataFrame) -> DataFrame:
    """Every truth receipt with its numbers of items and a status. files: stem and status ("empty" or other) of the output
    files, as read_items gives them; a file without text is an empty output, one with an empty list is scored."""
    t = truth.groupBy("stem").agg(F.count(F.lit(1)).alias("gt_items"))
    o = output.groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    both = t.join(files.select("stem", "status").withColumnRenamed("status", "file"), "stem", "left").join(o, "stem", "left")
    scored = F.col("file").isNotNull() & (F.col("file") != "empty")
    status = F.when(F.col("file").isNull(), "no output").when(F.col("file") == "empty", "empty output").otherwise("scored")
    return both.select("stem", "gt_items", F.when(scored, F.coalesce("n", F.lit(0))).alias("out_items"), status.alias("status"))


def _keyed(rows: DataFrame, prefix: str) -> DataFrame:
    name = T.name_key(F.coalesce(F.col("name"), F.lit("none")))
    return rows.select("stem", F.col("item_idx").alias(f"{prefix}_idx"), name.alias(f"{prefix}_name"), T.eval_price(F.col("price")).alias(f"{prefix}_price"), T.eval_amount(F.col("amount")).alias(f"{prefix}_amount"))


def matches(truth: DataFrame, output: DataFrame, *, fuzzy: bool = False) -> DataFrame:
    """The best output item of each truth item: an equal name, else the first that contains or is contained, else (fuzzy) the closest.

    Pairs are formed inside a receipt only; exact and containment legs are expressions, the fuzzy one sees what they left.
    """
    t, o = _keyed(truth, "t"), _keyed(output, "o")
    pairs = t.join(o, "stem")
    exact, inside = F.col("t_name") == F.col("o_name"), (F.col("t_name") != "") & (F.contains("o_name", "t_name") | F.contains("t_name", "o_name"))
    ranked = pairs.where(exact | inside).select("*", F.struct(F.when(exact, 0).otherwise(1).alias("leg"), F.col("o_idx")).alias("r"))
    best = ranked.groupBy("stem", "t_idx").agg(F.min_by(F.struct("o_idx", "o_price", "o_amount"), "r").alias("b"), F.min("r.leg").alias("leg"))
    found = best.select("stem", "t_idx", "leg", "b.*")
    if fuzzy:
        lists = o.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("o_idx", "o_name", "o_price", "o_amount"))).alias("all"))
        rest = t.join(found.select("stem", "t_idx"), ["stem", "t_idx"], "left_anti").join(lists, "stem")
        near = S.with_closest(rest, "t_name", "all", lambda x: x["o_name"], "b").where("b is not null")
        found = found.unionByName(near.select("stem", "t_idx", F.lit(2).alias("leg"), "b.o_idx", "b.o_price", "b.o_amount"))
    return t.join(found, ["stem", "t_idx"], "left")


def scores(truth: DataFrame, output: DataFrame, *, fuzzy: bool = False) -> DataFrame:
    """Five scalars and three rates of each receipt that has output.

    Coordinates agree within 0.02 degrees, or where neither side has any; rows without such columns have none.
    """

    def first(rows: DataFrame, p: str) -> DataFrame:
        head = {c: F.col(c) if c in rows.columns else F.lit(None).cast("double") for c in ("store", "purchase_date", "latitude", "longitude")}
        one = F.min_by(F.struct(*[v.alias(c) for c, v in head.items()]), "item_idx")
        found = rows.groupBy("stem").agg(one.alias("h"), F.count(F.lit(1)).alias(f"{p}_n"))
        names = {"store": "store", "purchase_date": "date", "latitude": "latitude", "longitude": "longitude"}
        return found.select("stem", f"{p}_n", *[F.col("h")[c].alias(f"{p}_{n}") for c, n in names.items()])

    heads = first(truth, "t").join(first(output, "o"), "stem")
    hit = F.col("o_idx").isNotNull()
    close = hit & (F.abs(F.col("t_price") - F.col("o_price")) <= 0.01)
    same = hit & (F.col("t_amount") != "") & (F.col("t_amount") == F.col("o_amount"))
    items = matches(truth, output, fuzzy=fuzzy).groupBy("stem").agg(F.count_if(hit).alias("names"), F.count_if(close).alias("prices"), F.count_if(same).alias("amounts"))
    store = F.arrays_overlap(T.store_words(F.col("t_store")), T.store_words(F.col("o_store")))
    date = T.date_key(F.col("t_date")).eqNullSafe(T.date_key(F.col("o_date")))
    count = F.col("t_n") == F.col("o_n")
    none = lambda c: F.col(f"t_{c}").isNull() & F.col(f"o_{c}").isNull()
    near = lambda c: none(c) | F.coalesce(F.abs(F.col(f"t_{c}") - F.col(f"o_{c}")) <= 0.02, F.lit(False))
    lat, lon = near("latitude"), near("longitude")
    scalar = sum((c.cast("int") for c in (store, date, count, lat, lon)), F.lit(0))
    overall = (scalar + (F.col("names") + F.col("prices") + F.col("amounts")) / F.col("t_n")) / 8 * 100
    flags = [c.alias(n) for n, c in (("store_ok", store), ("date_ok", date), ("lat_ok", lat), ("lon_ok", lon), ("count_ok", count))]
    return heads.join(items, "stem").select("stem", *flags, "names", "prices", "amounts", F.col("t_n").alias("n"), F.round(overall, 6).alias("overall"))


def summary(scored: DataFrame, by: list[str]) -> DataFrame:
    """A12, A13."""
    from ..functions.stats import ratio_of_sums

    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("receipts"), F.round(F.avg("overall"), 6).alias("avg_score"), F.min("overall").alias("min_score"), F.max("overall").alias("max_score"),
        F.round(ratio_of_sums(F.col("prices"), F.col("n")), 9).alias("price_match"),
    )


def price_ranks(scored: DataFrame) -> DataFrame:
    """provider, price_match over all its receipts, and its rank by it (of equals the first by name). A row per provider."""
    from ..functions.stats import ratio_of_sums

    found = scored.groupBy("provider").agg(ratio_of_sums(F.col("prices"), F.col("n")).alias("price_match"))
    return found.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("price_match"), "provider")))


def provider_gaps(scored: DataFrame, gap: float = 0.30) -> DataFrame:
    """Receipts whose shares of matched prices differ between two providers by gap or more, each with the first such pair
    in order of the providers' ranks. Rows: provider, stem, prices, n."""
    ranked = scored.join(price_ranks(scored).select("provider", "rank"), "provider")
    ratio = F.coalesce(F.col("prices") / F.nullif("n", F.lit(0)), F.lit(0.0))
    side = lambda p: ranked.select("stem", F.struct(F.col("rank").alias("rank"), F.col("provider").alias("provider"), ratio.alias("ratio")).alias(p))
    pairs = side("a").join(side("b"), "stem").where("a.rank < b.rank").where(F.abs(F.col("a.ratio") - F.col("b.ratio")) >= gap)
    first = pairs.groupBy("stem").agg(F.min_by(F.struct("a", "b"), F.struct("a.rank", "b.rank")).alias("p"))
    a, b = F.col("p.a"), F.col("p.b")
    more = a["ratio"] >= b["ratio"]
    pick = lambda c, x, y: F.when(more, x[c]).otherwise(y[c])
    return first.select(
        "stem", pick("provider", a, b).alias("stronger"), pick("ratio", a, b).alias("high"), pick("provider", b, a).alias("weaker"), pick("ratio", b, a).alias("low")
    )
