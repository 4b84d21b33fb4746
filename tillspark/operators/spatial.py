"""Rows of a receipt from the places of its words.

Words: page_id, word_idx, line_idx, token, x (left edge), y (middle), line_y (middle of the word's line), width, height of the page.
Word numbers rise along lines and from line to line. A page is one receipt, so what is collected per page is small: words are
shuffled once, to their page, windows work inside it, and rows are folds over the page's arrays. No step joins across pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T

ENTRY = "struct<y:double,line_idx:bigint,seq:bigint,x:double,text:string>"
ROW = "struct<y:double,line_idx:bigint,seq:bigint,x:double,text:string,row:int>"


def words_of_pages(pages: DataFrame) -> DataFrame:
    """Words of pages in schemas.OCR_PAGE with page_no 0; a word's line is the first whose box holds its middle."""
    part = lambda p, at: F.filter(p, lambda v, i: i % 2 == at)
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)
    w = pages.where("page_no = 0").select("page_id", "width", "height", "lines", F.inline("words"))
    xs, ys = part(F.col("polygon"), 0), part(F.col("polygon"), 1)
    y = mean(ys)
    holds = lambda x: (F.array_min(part(x["polygon"], 1)) <= F.col("y")) & (F.array_max(part(x["polygon"], 1)) >= F.col("y"))
    line = F.get(F.filter("lines", holds), F.lit(0))
    placed = w.withColumn("x", F.array_min(xs)).withColumn("y", y)
    return placed.select(
        "page_id", F.col("idx").cast("long").alias("word_idx"), line["idx"].cast("long").alias("line_idx"), F.col("content").alias("token"),
        "x", "y", mean(part(line["polygon"], 1)).alias("line_y"), "width", "height",
    )


def token_places(words: DataFrame) -> DataFrame:
    """G1: the place of a token's last occurrence on the page, and its number of occurrences."""
    last = F.max_by(F.struct("x", "y"), "word_idx")
    return words.groupBy("page_id", "token").agg(last.alias("p"), F.count(F.lit(1)).alias("n")).select("page_id", "token", "p.x", "p.y", "n")


def placed(words: DataFrame) -> DataFrame:
    """Words with G1's place (px, py, n), the line's text, G2's tilt, and G3 and G4's column: L, C or R by the share of the page's
    largest left edge. One shuffle, by page."""
    of_token, of_line, of_page = (Window.partitionBy("page_id", *more) for more in (["token"], ["line_idx"], []))
    place = F.max_by(F.struct("x", "y"), "word_idx").over(of_token)
    own = words.repartition("page_id").withColumns({"_p": place, "n": F.count(F.lit(1)).over(of_token)})
    own = own.withColumns({"px": F.col("_p.x"), "py": F.col("_p.y")}).drop("_p")
    tokens = F.array_sort(F.collect_list(F.struct("word_idx", "token")).over(of_line))
    lines = own.withColumns({
        "line_text": F.array_join(F.transform(tokens, lambda s: s["token"]), " "),
        "_k": F.count(F.lit(1)).over(of_line), "_most": F.max("n").over(of_line), "_first": F.min("word_idx").over(of_line),
        "_x0": F.min("px").over(of_line), "_x1": F.max("px").over(of_line),
        "_y0": F.min_by("py", "px").over(of_line), "_y1": F.max_by("py", "px").over(of_line),
    })
    noise = T.is_spatial_noise(F.col("line_text"))
    good = (
        (F.col("word_idx") == F.col("_first")) & (F.col("_k") >= 2) & (F.col("_most") == 1) & (F.col("line_y") <= 0.6 * F.col("height"))
        & (F.col("_x1") - F.col("_x0") >= 0.05 * F.col("width")) & ~noise
    )
    slope = F.when(good, (F.col("_y1") - F.col("_y0")) / (F.col("_x1") - F.col("_x0")))
    found = lines.withColumns({
        "noise": noise, "tilt": F.coalesce(F.percentile(slope, 0.5).over(of_page), F.lit(0.0)), "eff_width": F.max("px").over(of_page),
    })
    share = F.col("px") / F.col("eff_width")
    col = F.when(share < X.LEFT_END, "L").when(share < X.CENTRE_END, "C").otherwise("R")
    return found.withColumn("col", col).drop("_k", "_most", "_first", "_x0", "_x1", "_y0", "_y1")


def tilt(words: DataFrame) -> DataFrame:
    """Median slope of lines of two or more tokens, each alone of its kind, in the upper 60 % and wide enough; 0 without any."""
    return placed(words).groupBy("page_id").agg(F.first("tilt").alias("tilt"))


def entries(words: DataFrame) -> DataFrame:
    """What a line holds: its left words as one entry, each centre word, its right words as one; lines of noise are left out.

    page_id, tilt, height, col, y, line_idx, seq (number of the first word), x (of that word), text.
    """
    rows = placed(words).where(~F.col("noise"))
    alone = F.when(F.col("col") == "C", F.col("word_idx")).otherwise(F.lit(-1))
    first = F.min_by("px", "word_idx")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_idx", "token"))), lambda s: s["token"]), " ")
    grouped = rows.groupBy("page_id", "tilt", "height", "col", F.col("line_y").alias("y"), "line_idx", alone.alias("_alone"))
    return grouped.agg(F.min("word_idx").alias("seq"), first.alias("x"), text.alias("text")).drop("_alone")


def group_rows(left: Column, tolerance: Column) -> Column:
    """The ordered left entries with their row: a new one where y leaves the tolerance around the row's first y. An anchored fold."""
    start = F.struct(F.lit(-1).alias("row"), F.lit(-1e300).alias("anchor"), F.array().cast(f"array<{ROW}>").alias("out"))

    def step(acc: Column, e: Column) -> Column:
        new = F.abs(e["y"] - acc["anchor"]) > tolerance
        row = F.when(new, acc["row"] + 1).otherwise(acc["row"])
        anchor = F.when(new, e["y"]).otherwise(acc["anchor"])
        return F.struct(row.alias("row"), anchor.alias("anchor"), F.concat(acc["out"], F.array(_in_row(e, row))).alias("out"))

    return F.aggregate(left, start, step, lambda acc: acc["out"])


def _in_row(e: Column, row: Column) -> Column:
    return F.struct(*[e[c].alias(c) for c in ("y", "line_idx", "seq", "x", "text")], row.cast("int").alias("row"))


def _rows_of(grouped: Column, numbers: Column, slope: Column) -> Column:
    """Rows as (cy, row): the corrected height (G6) of a row is its last entry's."""
    last = lambda k: F.element_at(F.filter(grouped, lambda e: e["row"] == k), -1)
    height = lambda e, k: F.struct((e["y"] - slope * e["x"]).alias("cy"), k.alias("row"))
    return F.transform(numbers, lambda k: height(last(k), k))


def assign(others: Column, heights: Column, slope: Column, tolerance: Column) -> Column:
    """Entries of another column with their row: the smallest height at least its own less half the tolerance, else the topmost."""

    def best(e: Column) -> Column:
        near = F.array_min(F.filter(heights, lambda h: h["cy"] >= e["y"] - slope * e["x"] - 0.5 * tolerance))
        return F.coalesce(near["row"], F.array_min(heights)["row"])

    return F.transform(others, lambda e: _in_row(e, best(e)))


def merge_continuations(rows: Column, reach: Column) -> Column:
    """The row that each row (y, priced) goes to: one without a price joins a price-less row above that begins within reach."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("anchor"), F.lit(True).alias("priced"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, r: Column) -> Column:
        joins = (acc["last"] >= 0) & ~acc["priced"] & ~r["priced"] & (r["y"] - acc["anchor"] <= reach)
        pick = lambda c, other: F.when(joins, acc[c]).otherwise(other)
        to = pick("last", r["row"])
        return F.struct(
            to.alias("last"), pick("anchor", r["y"]).alias("anchor"), pick("priced", r["priced"]).alias("priced"),
            F.concat(acc["out"], F.array(to)).alias("out"),
        )

    return F.aggregate(rows, start, step, lambda acc: acc["out"])


def layout(words: DataFrame) -> DataFrame:
    """One row per page: page_id, slope, tol, and the entries l, c, r with the rows they are in before (row) and after merging (lm, cm, rm)."""
    of = lambda c: F.array_sort(F.collect_list(F.when(F.col("col") == c, F.struct("y", "line_idx", "seq", "x", "text"))))
    made = entries(words).groupBy("page_id").agg(
        F.first("tilt").alias("slope"), (F.first("height") * X.ROW_TOLERANCE).alias("tol"), of("L").alias("l"), of("C").alias("c"), of("R").alias("r")
    )
    slope, tol = F.col("slope"), F.col("tol")
    made = made.where(F.size("l") > 0).withColumn("l", group_rows(F.col("l"), tol))
    numbers = F.sequence(F.lit(0), F.element_at("l", -1)["row"])
    made = made.withColumn("heights", _rows_of(F.col("l"), numbers, slope))
    made = made.withColumns({c: assign(F.col(c), F.col("heights"), slope, tol) for c in "cr"})
    has = lambda c, k: F.exists(c, lambda e: e["row"] == k)
    top = lambda k: F.get(F.filter("l", lambda e: e["row"] == k), F.lit(0))["y"]
    rows = F.transform(numbers, lambda k: F.struct(k.alias("row"), top(k).alias("y"), (has("c", k) | has("r", k)).alias("priced")))
    made = made.withColumn("to", merge_continuations(rows, 3 * tol))
    moved = lambda c: F.transform(c, lambda e: _in_row(e, F.get("to", e["row"])))
    made = made.withColumns({"lm": moved("l"), "rm": moved("r")})
    made = made.withColumn("heights", _rows_of(F.col("lm"), F.array_distinct("to"), slope))
    return made.withColumn("cm", assign(F.col("c"), F.col("heights"), slope, tol))


def _cell(mark: Column | str, text: Column) -> Column:
    return F.concat(F.lit("["), F.lit(mark) if isinstance(mark, str) else mark, F.lit("] "), text)


def render(page: DataFrame) -> DataFrame:
    """page_id, spatial: the rows of a page, "[L] name  |  [C] quantity  |  [R] price", with S for savings.

    A row of several left entries that are no savings is printed as one line for each, every centre entry with the nearest of
    them and the right ones with the last.
    """
    by = lambda a, c: F.transform(F.array_sort(F.transform(a, lambda e: F.struct(e[c].alias("k"), e["line_idx"].alias("i"), e["seq"].alias("s"), e.alias("e")))), lambda s: s["e"])
    of = lambda c, k: F.filter(c, lambda e: e["row"] == k)
    corrected = lambda e: e["y"] - F.col("slope") * e["x"]

    def rows(k: Column) -> Column:
        names = F.array_join(F.transform(of("lm", k), lambda e: e["text"]), " ")
        parts = F.struct(k.alias("row"), T.row_label(names).alias("label"), of("lm", k).alias("l"), by(of("cm", k), "y").alias("c"), by(of("rm", k), "x").alias("r"))
        return parts

    def several(p: Column) -> Column:
        ordered = by(p["l"], "y")
        apart = lambda c: F.array_min(F.transform(ordered, lambda e, i: F.struct(F.abs(corrected(e) - corrected(c)).alias("d"), i.alias("i"))))["i"]
        near = F.transform(p["c"], lambda c: F.struct(apart(c).alias("i"), c["text"].alias("text")))
        right = lambda i: F.when(i == F.size(p["l"]) - 1, F.transform(p["r"], lambda e: _cell("R", e["text"]))).otherwise(F.array().cast("array<string>"))
        centre = lambda i: F.transform(F.filter(near, lambda c: c["i"] == i), lambda c: _cell("C", c["text"]))
        return F.transform(ordered, lambda e, i: F.array_join(F.concat(F.array(_cell("L", e["text"])), centre(i), right(i)), "  |  "))

    def single(p: Column) -> Column:
        marked = lambda a, m, o: F.transform(a, lambda e, i: F.struct(e["x"].alias("x"), F.lit(o).alias("o"), i.alias("i"), _cell(m, e["text"]).alias("t")))
        cells = F.transform(F.array_sort(F.concat(marked(p["l"], p["label"], 0), marked(p["c"], "C", 1))), lambda s: s["t"])
        return F.array(F.array_join(F.concat(cells, F.transform(p["r"], lambda e: _cell("R", e["text"]))), "  |  "))

    made = page.withColumn("rows", F.transform(F.array_distinct("to"), rows))
    lines = F.transform("rows", lambda p: F.when((F.size(p["l"]) > 1) & (p["label"] == "L"), several(p)).otherwise(single(p)))
    return made.select("page_id", F.array_join(F.flatten(lines), "\n").alias("spatial"))


def spatial_text(words: DataFrame) -> DataFrame:
    """page_id, spatial: the rendered rows of a page; a page without left entries has none."""
    return render(layout(words))
