"""Aggregates with the definitions that reports use."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage


#: Values of a group that are sorted in one array; larger groups are narrowed first.
FEW = 4096
#: Parts that a round of narrowing cuts a range into.
PARTS = 64

Place = Callable[[Column], Column]


def lower_middle(n: Column) -> Column:
    return F.floor((n - 1) / 2)


def upper_middle(n: Column) -> Column:
    return F.ceil((n - 1) / 2)


def at_index(p: float) -> Place:
    """A3, A4: min(int(p n), n - 1)."""
    return lambda n: F.least(F.floor(F.lit(p) * n), n - 1)


def order_statistics(df: DataFrame, by: list[str], value: str, places: dict[str, Place], *, few: int = FEW, parts: int = PARTS) -> DataFrame:
    """by and, for each name, the value that stands at its place (from 0, by the group's number of values) when the group is sorted.

    No task sorts a large group. A group of up to `few` values is one array. Of a larger one, quantile sketches give the bounds of
    parts, exact counts say which part holds the place, and only that part is looked at again, until it is short or one value; a value
    that is a bound itself is a part of its own, so repeated values end the search at once. A round keeps about 1/parts of the rows
    however values are distributed, so the rounds are few. Nulls aren't values; groups without values have no row.
    """
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    rows = df.where(F.col(value).isNotNull()).select(group.alias("_g"), F.col(value).alias("_v"))
    sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    most = sizes.agg(F.max("_n")).first()[0] or 0
    if most <= few:
        found = _sorted(rows, ["_g"], places)
    else:
        sizes = storage.written(sizes, "sizes")
        short = _sorted(rows.join(sizes.where(F.col("_n") <= few), "_g", "left_semi"), ["_g"], places)
        each = F.array(*[F.struct(F.lit(name).alias("name"), place(F.col("_n")).cast("long").alias("at")) for name, place in places.items()])
        large = _narrowed(rows, sizes.where(F.col("_n") > few).select("_g", F.inline(each)), few, parts)
        found = short.unionByName(large.groupBy("_g").agg(*[F.max(F.when(F.col("name") == name, F.col("_v"))).alias(name) for name in places]))
    return found.select(*[F.col(f"_g.{c}").alias(c) for c in by], *places)


def _sorted(rows: DataFrame, keys: list[str], places: dict[str, Place]) -> DataFrame:
    lists = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("_v")).alias("_l"))
    return lists.select(*keys, *[F.get("_l", place(F.size("_l")).cast("int")).alias(name) for name, place in places.items()])


def _narrowed(rows: DataFrame, sought: DataFrame, few: int, parts: int) -> DataFrame:
    """_g, name, _v: the values at the places `at` of groups (_g, name, at), each of more than few rows."""
    kind = rows.schema["_v"].dataType
    key = ["_g", "name"]
    state = sought.withColumns({"low": F.lit(None).cast(kind), "high": F.lit(None).cast(kind)})
    ended = []
    while True:
        inside = (F.col("low").isNull() | (F.col("_v") > F.col("low"))) & (F.col("high").isNull() | (F.col("_v") < F.col("high")))
        near = rows.join(state, "_g").where(inside)
        bounds = F.percentile_approx("_v", F.array(*[F.lit(k / parts) for k in range(1, parts)]), 20 * parts)
        cuts = storage.written(near.groupBy(*key).agg(F.array_sort(F.array_distinct(bounds)).alias("cuts")), "cuts")
        below = F.size(F.filter("cuts", lambda x: x < F.col("_v")))
        part = below * 2 + F.array_contains("cuts", F.col("_v")).cast("int")  # odd: equal to a bound
        counts = near.join(cuts, key).groupBy(*key, part.alias("part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"), F.max("_v").alias("_most"))
        # Of each group 2 * parts rows at most.
        before = F.sum("_n").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        chosen = counts.withColumn("_before", F.coalesce(before, F.lit(0))).join(state, key).where((F.col("_before") <= F.col("at")) & (F.col("at") < F.col("_before") + F.col("_n")))
        place = (F.col("part") / 2).cast("int")
        low, high = F.coalesce(F.get("cuts", place - 1), F.col("low")), F.coalesce(F.get("cuts", place), F.col("high"))
        single = F.col("_v") == F.col("_most")
        moved = chosen.join(cuts, key).select(*key, (F.col("at") - F.col("_before")).alias("at"), low.alias("low"), high.alias("high"), "_n", "_v", single.alias("single"))
        moved = storage.written(moved, "places")
        ended.append(moved.where("single").select(*key, "_v"))
        short = moved.where(~F.col("single") & (F.col("_n") <= few)).drop("_v")
        lists = rows.join(short, "_g").where(inside).groupBy(*key, "at").agg(F.array_sort(F.collect_list("_v")).alias("_l"))
        ended.append(lists.select(*key, F.get("_l", F.col("at").cast("int")).alias("_v")))
        state = moved.where(~F.col("single") & (F.col("_n") > few)).select(*key, "at", "low", "high")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, ended)


def indexed_percentile(df: DataFrame, by: list[str], value: str, p: float, name: str) -> DataFrame:
    """A3, A4: by and the value at min(int(p n), n - 1) of each group."""
    return order_statistics(df, by, value, {name: at_index(p)})


def summary(df: DataFrame, by: list[str], value: str, *, median: str | None = None, indexed: dict[str, float] | None = None) -> DataFrame:
    """A2 to A4: by, the median (the mean of both middle values) and the percentiles by index, all in one search."""
    places = {name: at_index(p) for name, p in (indexed or {}).items()}
    found = order_statistics(df, by, value, places | ({"_low": lower_middle, "_high": upper_middle} if median else {}))
    middle = [((F.col("_low") + F.col("_high")) / 2).alias(median)] if median else []
    return found.select(*by, *middle, *places)


def cost_source_label(sources: Column, counted: Column) -> Column:
    """Over the distinct sources of a group's rows that count, nulls as unknown."""
    found = F.collect_set(F.when(counted, F.coalesce(sources, F.lit("unknown"))))
    return F.when(F.array_contains(found, "api") & (F.size(found) == 1), "api").when(~F.array_contains(found, "api"), "est").otherwise("mixed")


def ratio_of_sums(num: Column, den: Column) -> Column:
    """0 for an empty denominator."""
    return F.coalesce(F.sum(num) / F.nullif(F.sum(den), F.lit(0)), F.lit(0.0))


def rate(flag: Column) -> Column:
    """Share of rows that hold, in percent."""
    return F.avg(F.when(flag, 100.0).otherwise(0.0))
