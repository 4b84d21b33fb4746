"""Validation, flattening and de-duplication of receipt items. Rows: receipt_id, item_idx, store, purchase_date, currency, name, code, price, amount."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import similarity as S
from ..functions import text as T


def is_product(name: Column) -> Column:
    """The name tests of F1; a null name is none."""
    n = F.coalesce(name, F.lit(""))
    return (
        (n != "") & ~n.rlike(X.NON_PRODUCT) & ~n.rlike(X.JUNK_NAME) & (F.length(n) > 2) & ~n.rlike(r"^[\d\s\.\,\-]+$")
        & (F.length(n) <= 100) & ~n.rlike(X.METADATA_NAME) & ~T.is_mostly_cjk(n)
    )


def clean_name(name: Column) -> Column:
    """Without "(SALE)" and without a leading item code, unless nothing else is left."""
    return F.regexp_replace(name, r"(?i)^(?:\(sale\)\s+)?(?:\d{4,}\s+(?=\S))?", "")


def once(rows: DataFrame, **more: Column) -> DataFrame:
    """rows with more columns that are computed once each, whatever refers to them: optimiser rules would otherwise put their
    expressions in the place of every reference, filters that move below them included."""
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in more.items()])))
    return rows.select(*[c for c in rows.columns if c not in more], made).select(*rows.columns, *[n for n in more if n not in rows.columns])


def validate(items: DataFrame) -> DataFrame:
    """product names, prices inside the bounds with their currency, amounts that are amounts. Narrow work, no shuffle.

    Bounds hold for the number as it is written, before it is rounded to cents; one too long for a decimal is too high.
    """
    kept = once(items, name=T.strip(F.col("name")), _digits=T.price_digits(F.col("price"))).where(is_product(F.col("name")))
    number = F.col("_digits").try_cast("decimal(38,18)")
    low, high = (F.lit(c).cast("decimal(10,2)") / 100 for c in (X.MIN_CENTS, X.MAX_CENTS))
    kept = kept.where((F.col("_digits") == "") | F.coalesce(number.between(low, high), F.lit(False)))
    kept = once(kept, name=clean_name(F.col("name")), _cents=T.digits_cents(F.col("_digits"))).drop("_digits")
    tidy = F.regexp_replace(T.strip(F.coalesce(F.col("amount"), F.lit(""))), r"^(\d+\.\d{2})\s*[A-Za-z]$", "$1")
    swapped = F.col("_cents").isNull() & tidy.rlike(r"^\d+\.\d{2}\s*[A-Za-z]?$")
    price = F.when(swapped, F.concat(tidy, F.col("currency"))).when(F.col("_cents").isNotNull(), T.format_cents(F.col("_cents"), F.col("currency"))).otherwise(F.col("price"))
    amount = F.coalesce(F.nullif(T.clean_amount(F.col("amount"), F.col("_cents").isNotNull()), F.lit("")), F.lit("1"))
    return kept.withColumn("price", price).withColumn("amount", amount).drop("_cents")


def flatten(items: DataFrame) -> DataFrame:
    """F2 without de-duplication: rows fit for the output table. Flat rows pass unchanged, so applying it twice is applying it once."""
    items = once(items, name=T.strip(F.coalesce(F.col("name"), F.lit(""))), price=T.strip(F.coalesce(F.col("price"), F.lit(""))))
    n, p, store = F.col("name"), F.col("price"), F.lower(F.coalesce(F.col("store"), F.lit("")))
    garbled = (n == F.lower(n)) & n.rlike(r"\p{L}")
    keep = (n != "") & p.rlike(r"^\d+\.\d{2}[A-Z]{3}$") & ~n.rlike(X.FLAT_NON_PRODUCT) & ~garbled & ~((store != "") & F.contains(F.lower(n), store))
    return items.where(keep).withColumn("amount", F.coalesce(F.nullif(F.col("amount"), F.lit("")), F.lit("1")))


def explode_receipts(receipts: DataFrame) -> DataFrame:
    """F2's 1 to n step: nested receipts (schemas.RECEIPT with receipt_id, latitude, longitude) to item rows."""
    rows = receipts.select("receipt_id", F.col("storeName").alias("store"), F.col("purchaseDate").alias("purchase_date"), "currency", "latitude", "longitude", F.posexplode("items").alias("item_idx", "i"))
    return rows.select("receipt_id", "item_idx", "store", "purchase_date", "currency", "latitude", "longitude", F.col("i.productName").alias("name"), F.col("i.itemCode").alias("code"), F.col("i.price").alias("price"), F.col("i.amount").alias("amount"))


def drop_fragments(items: DataFrame) -> DataFrame:
    """A name inside another name at the same price of the receipt goes. One shuffle on the receipt and price; the names of a price are few."""
    at = Window.partitionBy("receipt_id", "price")
    names = F.collect_set(F.lower("name")).over(at)
    inside = F.exists("_names", lambda o: (o != F.lower(F.col("name"))) & F.contains(o, F.lower(F.col("name"))))
    return items.withColumn("_names", names).where(~inside).drop("_names")


def output_order(items: DataFrame) -> DataFrame:
    """The place of an item in a receipt's output: prices by their first item, then the item's own order."""
    first = F.min("item_idx").over(Window.partitionBy("receipt_id", "price"))
    return items.withColumn("_first", first).withColumn("place", F.row_number().over(Window.partitionBy("receipt_id").orderBy("_first", "item_idx"))).drop("_first")


def drop_exact_repeats(items: DataFrame) -> DataFrame:
    """The exact leg of W3: the first of equal names and prices stays, unless codes tell them apart."""
    key = [T.dedup_key(F.col("name")), T.merge_price_key(F.col("price")), F.coalesce("code", F.lit(""))]
    w = Window.partitionBy("receipt_id", *key).orderBy("item_idx")
    return items.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def repeat_groups(items: DataFrame) -> DataFrame:
    """W3's lists: receipt_id, _price, g (items in order with their keys) and pairs, the places of items that may be alike."""
    rows = items.withColumn("_key", T.dedup_key(F.col("name"))).withColumn("_price", T.merge_price_key(F.col("price")))
    row = F.struct("item_idx", F.col("_key").alias("key"), F.coalesce("code", F.lit("")).alias("code_key"), F.struct(*items.columns).alias("row"))
    groups = rows.groupBy("receipt_id", "_price").agg(F.array_sort(F.collect_list(row)).alias("g"))
    apart = lambda x, y: (x["code_key"] != "") & (y["code_key"] != "") & (x["code_key"] != y["code_key"])
    return once(groups, pairs=S.candidate_pairs(F.col("g"), lambda x: x["key"], apart, 0.85))


def drop_fuzzy_repeats(items: DataFrame) -> DataFrame:
    """In order, an item goes if one that was kept has its price and nearly its name (ratio 0.85), and not another code.

    The outcome depends on the order; the items of a receipt and price are a short list. Bounds say which pairs can be so similar; a
    list without such pairs and without equal keys never leaves the JVM.
    """
    groups = repeat_groups(items)
    work = (F.size("pairs") > 0) | (F.size(F.array_distinct("g.key")) < F.size("g"))
    flags = F.when(work, S.first_of_similar(F.when(work, F.col("g.key")), F.when(work, F.col("g.code_key")), F.when(work, F.col("pairs"))))
    kept = groups.withColumn("f", flags).select(F.explode(F.filter("g", lambda x, i: F.coalesce(F.get(F.col("f"), i), F.lit(True)))).alias("x"))
    return kept.select("x.row.*")


def late_filter(items: DataFrame) -> DataFrame:
    """F3."""
    n = F.coalesce(F.col("name"), F.lit(""))
    barcode = (n.rlike(r"^\d+$") & (F.length(n) > 8)) | ((F.length(n) > 10) & F.substring(n, 1, 8).rlike(r"\d"))
    stop = F.exists(F.array(*map(F.lit, [*X.LATE_STOPS, "TAX"])), lambda w: F.contains(F.upper(n), w))
    return items.where(~barcode & ~F.contains(n, F.lit("%")) & ~stop & (F.length(n) > 1))


def output_rows(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """the seven columns of the output table, with the keys and the columns to keep."""
    return items.select("receipt_id", "item_idx", F.col("name").alias("productName"), F.col("purchase_date").alias("purchaseDate"), "price", "amount", F.col("store").alias("storeName"), "latitude", "longitude", *keep)


def upload_rows(flat: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """F4 for the upload: five columns, with the keys and the columns to keep; a missing date column, not a null date, becomes zeros."""
    date = F.col("purchaseDate") if "purchaseDate" in flat.columns else F.lit("0000.00.00")
    return flat.select("receipt_id", "item_idx", "productName", date.alias("purchaseDate"), "price", "amount", "storeName", *keep)


def weight_items(texts: DataFrame, *, id_col: str = "receipt_id", ocr_col: str = "ocr") -> DataFrame:
    """Id, items: array of (name, weight, total) of weight-priced lines, in order; with equal names the last counts. No shuffle."""
    rows = once(texts.select(id_col, ocr_col), _lines=T.weight_body(F.col(ocr_col)))
    rows = once(rows.select(id_col, "_lines"), _priced=T.weight_lines(F.col("_lines")))
    rows = once(rows.select(id_col, "_lines", "_priced"), _found=T.priced_by_weight(F.col("_lines"), F.col("_priced")))
    return rows.select(id_col, T.last_of_each_name(F.col("_found")).alias("items"))


def weight_rows(texts: DataFrame, *, id_col: str = "receipt_id", ocr_col: str = "ocr") -> DataFrame:
    """Id, name, weight, total, a row for each."""
    return weight_items(texts, id_col=id_col, ocr_col=ocr_col).select(id_col, F.inline("items"))


def inject_weights(items: DataFrame, weights: DataFrame, *, fuzzy: bool = False) -> DataFrame:
    """Weight-priced lines override the items of their name; those without an item are appended.

    items: rows as above; weights: receipt_id, name, weight, total, a name once a receipt, as T16 gives them. With fuzzy, an item
    without an exact name takes the closest. Each side is read once: the first item of a receipt brings in its weights as rows beside
    the items, and windows inside the receipt say which item and weight belong together. Nothing is shuffled where both sides have
    their receipts together.
    """
    lists = weights.groupBy("receipt_id").agg(F.collect_list(F.struct("name", "weight", "total")).alias("items"))
    return inject_closest(items, lists) if fuzzy else inject_exact(items, lists)


def inject_exact(items: DataFrame, lists: DataFrame) -> DataFrame:
    """J8 by exact names; lists: receipt_id, items: its weights, as T16 gives them."""
    lists = lists.select("receipt_id", F.transform("items", lambda w: F.struct(w["name"].alias("key"), w["weight"].alias("weight"), w["total"].alias("total"))).alias("_ws"))
    nothing = lambda c: F.lit(None).cast(items.schema[c].dataType).alias(c)
    starts = F.row_number().over(Window.partitionBy("receipt_id").orderBy("item_idx")) == 1
    both = items.withColumn("_starts", starts).join(lists, "receipt_id", "left")
    others = [c for c in items.columns if c != "receipt_id"]
    own = F.struct(*others, F.upper(F.coalesce("name", F.lit(""))).alias("_upper"), F.lit(True).alias("_item"), F.lit(None).cast(lists.schema["_ws"].dataType.elementType).alias("_w"))
    line = lambda w: F.struct(*map(nothing, others), w["key"].alias("_upper"), F.lit(False).alias("_item"), w.alias("_w"))
    brought = F.when(F.col("_starts") & F.col("_ws").isNotNull(), F.concat(F.array(own), F.transform("_ws", line))).otherwise(F.array(own))
    rows = both.select("receipt_id", F.inline(brought))
    receipt, same = Window.partitionBy("receipt_id"), Window.partitionBy("receipt_id", "_upper")
    rows = rows.withColumn("_hit", F.max("_w").over(same))
    first = F.min_by(F.when(F.col("_item"), F.struct("store", "purchase_date", "currency")), F.when(F.col("_item"), F.col("item_idx"))).over(receipt)
    rows = rows.withColumn("_used", F.max("_item").over(same)).where(F.col("_item") | ~F.col("_used"))
    rows = rows.withColumn("_first", first).withColumn("_last", F.max(F.when(F.col("_item"), F.col("item_idx"))).over(receipt))
    place = F.row_number().over(Window.partitionBy("receipt_id", "_item").orderBy("_upper"))
    old, added = F.col("_item"), {"item_idx": F.col("_last") + place, "name": F.col("_upper"), "code": F.lit("")} | {c: F.col(f"_first.{c}") for c in ("store", "purchase_date", "currency")}
    return _weighed(rows.select("receipt_id", "_item", "_hit", "price", "amount", *[F.when(old, F.col(c)).otherwise(v).alias(c) for c, v in added.items()]))


def inject_closest(items: DataFrame, lists: DataFrame) -> DataFrame:
    """J8 by exact names, else the closest; lists: receipt_id, items: its weights, as T16 gives them.

    A receipt's names are compared with its weights in one row, so nothing is shuffled or sorted after Python has seen it.
    """
    others = ["item_idx", "store", "purchase_date", "currency", "name", "code", "price", "amount"]
    groups = items.groupBy("receipt_id").agg(F.collect_list(F.struct(*others)).alias("_items"))
    lists = once(lists, _ws=F.array_sort(F.transform("items", lambda w: F.struct(w["name"].alias("key"), w["weight"].alias("weight"), w["total"].alias("total"))))).drop("items")
    both = once(groups, _first=F.array_min("_items"), _last=F.array_max("_items")["item_idx"]).join(lists, "receipt_id", "left")
    some = F.size("_ws") > 0
    names = F.transform("_items", lambda x: F.upper(F.coalesce(x["name"], F.lit(""))))
    both = both.withColumn("_at", S.closest_of_lists(F.when(some, names), F.when(some, F.transform("_ws", lambda w: w["key"]))))
    hit = lambda i: F.get(F.col("_ws"), F.get(F.col("_at"), i))
    old = F.transform("_items", lambda x, i: F.struct(*[x[c].alias(c) for c in others], F.lit(True).alias("_item"), hit(i).alias("_hit")))
    unused = F.array_except(F.sequence(F.lit(0), F.size("_ws") - 1), "_at")

    def added(j: Column, n: Column) -> Column:
        w = F.get(F.col("_ws"), j)
        own = {"item_idx": F.col("_last") + n + 1, "name": w["key"], "code": F.lit(""), "price": F.lit(""), "amount": F.lit("")}
        return F.struct(*[own.get(c, F.col(f"_first.{c}")).alias(c) for c in others], F.lit(False).alias("_item"), w.alias("_hit"))

    return _weighed(both.select("receipt_id", F.inline(F.when(some, F.concat(old, F.transform(unused, added))).otherwise(old))))


def _weighed(rows: DataFrame) -> DataFrame:
    """Items, and weights as new items, with the price and amount of their _hit."""
    hit = F.col("_hit").isNotNull()
    return rows.select(
        "receipt_id", "item_idx", "store", "purchase_date", "currency", F.when(F.col("_item"), F.col("name")).otherwise(T.title_case(F.col("name"))).alias("name"), "code",
        F.when(hit, T.format_cents(T.price_cents(F.col("_hit.total")), F.col("currency"))).otherwise(F.col("price")).alias("price"),
        F.when(hit, F.concat("_hit.weight", F.lit(" kg"))).otherwise(F.col("amount")).alias("amount"),
    )


def process(items: DataFrame) -> DataFrame:
    """Validation, flattening, both de-duplications and the late filter, in the order of the extraction."""
    return late_filter(drop_fragments(flatten(drop_fuzzy_repeats(validate(items)))))
