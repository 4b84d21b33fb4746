"""Column functions over OCR text, names, prices and dates: JVM expressions only, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X

def null_text() -> Column:
    return F.lit(None).cast("string")


def strip(c: Column) -> Column:
    """All white space off both ends; Spark's trim takes spaces alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def body_lines(c: Column) -> Column:
    """Lines at any line break; a trailing break opens no line."""
    return F.split(F.regexp_replace(c, r"\R$", ""), r"\R", -1)


def raw_part(ocr: Column) -> Column:
    """The text before the spatial layout."""
    return F.split(ocr, r"\n---\n## SPATIAL LAYOUT\n", 2)[0]


def spatial_part(ocr: Column) -> Column:
    return F.get(F.split(ocr, r"\n---\n## SPATIAL LAYOUT\n", 2), F.lit(1))


def has_spatial(ocr: Column) -> Column:
    return F.contains(ocr, F.lit(X.SPATIAL_MARKER))


def on_raw(ocr: Column, change) -> Column:
    """Apply change to the raw part and leave the spatial part as it is."""
    return F.when(has_spatial(ocr), F.concat(change(raw_part(ocr)), F.lit(X.SPATIAL_MARKER), spatial_part(ocr))).otherwise(change(ocr))


def join_spaced_decimals(ocr: Column) -> Column:
    """T1: "1. 160" -> "1.160"."""
    return F.regexp_replace(ocr, r"(\d)\.\s+(\d)", "$1.$2")


def join_price_lines(ocr: Column) -> Column:
    """A line that holds a price alone joins the last line with content, and is lost where that one has a price.

    Lines become letters, one each: b blank, p a price alone, e with a price at its end, c other content. Two replacements in the
    word of letters say what happens to every line: of the prices that follow a c the first moves to it (C, m); a price that nothing
    precedes stays (k); other prices go. Work is linear in the lines. Two noncharacters of Unicode mark places in between.
    """
    price = r"\$?\d+\.\d{2}\s*$"
    end, moved = "\ufdd0", "\ufdd1"
    bare_end = lambda x: F.regexp_replace(x, r"(?U)\s+$", "")

    def letter(x: Column) -> Column:
        return F.when(strip(x) == "", "b").when(strip(x).rlike("^" + price), "p").when(bare_end(x).rlike(price), "e").otherwise("c")

    def change(t: Column) -> Column:
        word = F.regexp_replace(F.array_join(F.transform(lines(t), letter), ""), "^(b*)p", "$1k")
        letters = F.regexp_extract_all(F.regexp_replace(word, "c(b*)p", "C$1m"), F.lit("."), F.lit(0))
        placed = lambda x, k: F.when(k == "C", F.concat(bare_end(x), F.lit(end))).when(k == "m", F.concat(F.lit(moved), strip(x))).when(k != "p", x)
        joined = F.array_join(F.array_compact(F.zip_with(lines(t), letters, placed)), "\n")
        return F.regexp_replace(joined, f"{end}([^{moved}]*)\n{moved}([^\n]*)", "  $2$1")

    return on_raw(ocr, change)


def drop_noise_lines(ocr: Column) -> Column:
    """T3."""
    return on_raw(ocr, lambda t: F.array_join(F.filter(body_lines(t), lambda x: ~x.rlike(X.NOISE_LINE)), "\n"))


def is_spatial_noise(line: Column) -> Column:
    """T4."""
    return line.rlike(X.SPATIAL_NOISE_LINE)


def row_label(line: Column) -> Column:
    """T5: S for savings, else L."""
    return F.when(line.rlike(X.SAVINGS_LINE), F.lit("S")).otherwise(F.lit("L"))


def is_garbled(line: Column) -> Column:
    """T6."""
    s = strip(line)
    digit = s.rlike(r"\p{Nd}")
    dense = F.try_divide(F.length(F.regexp_replace(s, r"(?U)[^\p{L}\p{N}\s]", "")), F.length(s))
    return (s == "") | (dense < 0.55) | (~digit & s.rlike(r"^\p{Ll}")) | (~digit & ~s.rlike(r"^[\p{L}\p{N}]"))


def header_date(t: Column) -> Column:
    """T7."""
    full, short = r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b", r"\b(\d{2})/(\d{2})/(\d{2})\b"
    g = lambda p, k: F.regexp_extract(t, p, k)
    a, c = g(short, 1).try_cast("int"), g(short, 3).try_cast("int")
    return (
        F.when(g(full, 3) != "", F.concat_ws(".", g(full, 3), F.lpad(g(full, 1), 2, "0"), F.lpad(g(full, 2), 2, "0")))
        .when(a > 12, F.concat(F.lit("20"), F.concat_ws(".", g(short, 1), g(short, 2), g(short, 3))))
        .when(c > 12, F.concat(F.lit("20"), F.concat_ws(".", g(short, 3), g(short, 1), g(short, 2))))
    )


def transaction_date(ocr: Column) -> Column:
    """The first date with a time that no promotion announces, else the first such written date.

    Every match is taken with the text before it: the text is split at the matches, so what precedes a match is the
    concatenation of the pieces up to it.
    """
    raw = F.split(ocr, r"\n---\n", 2)[0]

    def first_valid(pattern: str, window, read) -> Column:
        hits, gaps = F.regexp_extract_all(raw, F.lit(pattern), F.lit(0)), F.split(raw, pattern, -1)
        piece = lambda k, i: F.concat(F.get(gaps, k), F.when(k < i, F.get(hits, k)).otherwise(F.lit("")))
        before = lambda i: F.array_join(F.transform(F.sequence(F.lit(0), i), lambda k: piece(k, i)), "")
        dates = F.transform(hits, lambda h, i: F.when(~window(before(i)).rlike(X.PROMOTION), read(h)))
        return F.get(F.filter(dates, lambda x: x.isNotNull()), F.lit(0))

    def near_line(before: Column) -> Column:
        """From 80 characters before the match's line."""
        start = F.length(before) - F.length(F.regexp_extract(before, r"([^\n]*)\z", 1))
        begin = F.greatest(F.lit(0), start - 80)
        return F.substr(before, begin + 1, F.length(before) - begin)

    def numeric(h: Column) -> Column:
        p = F.split(F.regexp_extract(h, r"^\S+", 0), r"[/\-]")
        a, b, c = (p[k].cast("int") for k in range(3))
        year_first = F.length(p[0]) == 4
        year = F.when(year_first, a).when(c >= 100, c).otherwise(c + 2000)
        month_first = (a <= 12) & (b <= 31)
        month = F.when(year_first, b).when(month_first, a).otherwise(b)
        day = F.when(year_first, c).when(month_first, b).otherwise(a)
        return F.when((year >= 2022) & month.between(1, 12) & day.between(1, 31), _dotted(year, month, day))

    def written(h: Column) -> Column:
        month = F.array_position(F.array(*map(F.lit, X.MONTHS)), F.lower(F.substring(h, 1, 3))).cast("int")
        year, day = F.regexp_extract(h, X.WRITTEN_DATE, 3).cast("int"), F.regexp_extract(h, X.WRITTEN_DATE, 2).cast("int")
        return F.when(year.between(2022, 2030) & day.between(1, 31), _dotted(year, month, day))

    last80 = lambda before: F.substr(before, F.greatest(F.lit(1), F.length(before) - 79), F.lit(80))
    return F.coalesce(first_valid(X.DATE_WITH_TIME, near_line, numeric), first_valid(X.WRITTEN_DATE, last80, written))


def _dotted(year: Column, month: Column, day: Column) -> Column:
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat_ws(".", year.cast("string"), two(month), two(day))


def currency_in_text(ocr: Column) -> Column:
    """T9."""
    out = F.when(F.lit(False), null_text())
    for pattern, code in X.CURRENCY_MARKS:
        out = out.when(ocr.rlike(pattern), F.lit(code))
    return out.when(ocr.rlike(X.US_STORE_IN_TEXT), F.lit("USD"))


def currency_of_store(store: Column) -> Column:
    """T10."""
    name = strip(F.coalesce(store, F.lit("")))
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.upper(name), w))
    return F.when(name.isin(X.CANADIAN_STORES), F.lit("CAD")).when(has(X.CANADIAN_KEYWORDS), F.lit("CAD")).when(has(X.US_KEYWORDS), F.lit("USD"))


def receipt_currency(ocr: Column, store: Column, claimed: Column) -> Column:
    """T11."""
    return F.coalesce(currency_in_text(ocr), currency_of_store(store), F.nullif(claimed, F.lit("")), F.lit("USD"))


def store_alias(store: Column) -> Column:
    """T12."""
    table = F.create_map(*[F.lit(x) for pair in X.STORE_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(strip(F.coalesce(store, F.lit(""))))), store)


def title_case(c: Column) -> Column:
    """A capital after every character that isn't a letter, small letters elsewhere."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20))), "")


def store_from_header(store: Column, ocr: Column) -> Column:
    """T13."""
    found = F.regexp_extract(F.array_join(F.slice(body_lines(ocr), 1, 10), "\n"), X.KNOWN_CHAIN, 1)
    names = F.create_map(*[F.lit(x) for pair in X.CHAIN_NAMES.items() for x in pair])
    return F.when(store.rlike(X.KNOWN_CHAIN) | (found == ""), store).otherwise(F.coalesce(F.try_element_at(names, F.split(F.lower(found), r"\s+")[0]), title_case(found)))


def address_from_text(ocr: Column, store: Column) -> Column:
    """A street line of the first 30, with the next line if that has city, state and ZIP; else a line with those."""
    top = F.slice(body_lines(ocr), 1, 30)
    street = F.array_position(F.transform(top, lambda x: x.rlike(X.STREET_LINE)), F.lit(True)).cast("int")
    here, following = strip(F.get(top, street - 1)), strip(F.coalesce(F.get(top, street), F.lit("")))
    with_next = F.when(~here.rlike(X.CITY_STATE_ZIP) & following.rlike(X.CITY_STATE_ZIP), F.concat(here, F.lit(", "), following)).otherwise(here)
    line = F.get(F.filter(top, lambda x: x.rlike(X.CITY_STATE_ZIP)), F.lit(0))
    city = F.regexp_extract(line, X.CITY_STATE_ZIP, 0)
    before = F.substr(line, F.lit(1), F.position(city, line) - 1)
    near, dangling = F.regexp_extract(before, r"^(?s:.*)(\b\d{3,5}\s+[A-Za-z].*)$", 1), F.regexp_extract(before, r"\b(\d{3,5})\s*$", 1)
    by_city = (
        F.when(near != "", strip(F.concat(near, city)))
        .when(dangling != "", F.concat(dangling, F.lit(" "), strip(city)))
        .when(F.coalesce(store, F.lit("")) != "", F.concat(store, F.lit(" "), strip(city)))
        .otherwise(strip(city))
    )
    return F.when(street > 0, with_next).when(line.isNotNull(), by_city).otherwise(F.lit(""))


def address_for_geocoder(address: Column) -> Column:
    """T15."""
    marked = lambda x: F.exists(F.array(*map(F.lit, X.STAFF_MARKS)), lambda w: F.contains(x, w))
    kept = F.filter(F.transform(lines(F.coalesce(address, F.lit(""))), strip), lambda x: ~marked(x) & ~x.rlike(X.PHONE_IN_LINE))
    return strip(F.replace(F.array_join(kept, " "), F.lit(X.REMOVED_FROM_ADDRESS), F.lit("")))


def weight_body(ocr: Column) -> Column:
    """The lines of the raw part."""
    return body_lines(F.split(ocr, r"\n---\n", 2)[0])


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where value is computed once, however often f refers to it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def weight_lines(lines_: Column) -> Column:
    """Of the lines of the raw part those that are weight-priced: array of (at, weight, total), total empty where it is missing."""

    def read(x: Column, i: Column) -> Column:
        parts = lambda c: F.struct(i.alias("at"), F.regexp_extract(c, X.WEIGHT_LINE, 1).alias("weight"), F.regexp_extract(c, X.WEIGHT_LINE, 3).alias("total"))
        return F.when(F.contains(F.lower(x), F.lit("kg")), _let(strip(join_spaced_decimals(x)), lambda c: F.when(c.rlike(X.WEIGHT_LINE), parts(c))))

    return F.array_compact(F.transform(lines_, read))


def priced_by_weight(lines_: Column, priced: Column) -> Column:
    """Of the lines and their weight_lines() the items in order: a missing total from the 3 lines ahead, the name from the 4 before.

    The nearest line that has one ends the search, so other lines are not looked at.
    """

    def number(at: Column) -> Column:
        return _let(strip(join_spaced_decimals(F.get(lines_, at))), lambda c: F.when(c.rlike(r"^\d+\.\d+$"), c))

    def name(at: Column) -> Column:
        name_of = lambda x: strip(F.regexp_replace(F.regexp_replace(x, r"^\d+\s+", ""), r"(?i)\s+MRJ\s*$", ""))
        usable = lambda x: F.when((x != "") & (F.upper(x) != "MRJ"), _let(name_of(x), lambda n: F.when(~n.rlike(r"^\d+-[A-Z]+$"), n)))
        return _let(strip(F.get(lines_, at)), usable)

    def read(x: Column) -> Column:
        total = F.coalesce(F.nullif(x["total"], F.lit("")), *[number(x["at"] + n) for n in (1, 2, 3)])
        return F.struct(F.upper(F.coalesce(*[name(x["at"] - n) for n in (1, 2, 3, 4)])).alias("name"), x["weight"].alias("weight"), total.alias("total"))

    return F.filter(F.transform(priced, read), lambda s: (s["name"] != "") & s["total"].isNotNull())


def last_of_each_name(found: Column) -> Column:
    """Of equal names the last counts."""
    return F.filter(found, lambda s, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda o: o["name"] == s["name"]))


def line_context(ocr: Column, name: Column, window: int = 3) -> Column:
    """The lines around the first one with the name's first word, else the first 500 characters."""
    all_lines, word = body_lines(ocr), F.upper(F.coalesce(F.get(F.split(strip(name), r"\s+"), F.lit(0)), F.lit("")))
    at = F.array_position(F.transform(all_lines, lambda x: F.contains(F.upper(x), word)), F.lit(True)).cast("int")
    first = F.greatest(F.lit(1), at - window)
    return F.when((word != "") & (at > 0), F.array_join(F.slice(all_lines, first, at + window - first + 1), "\n")).otherwise(F.substring(ocr, 1, 500))


def price_digits(price: Column) -> Column:
    """The first number of a price, after trailing letters, as text; empty if there is none."""
    bare = F.regexp_replace(strip(F.coalesce(price, F.lit(""))), r"^(\d+\.?\d*)[A-Za-z]+$", "$1")
    return F.regexp_extract(bare, r"(\d+\.?\d*)", 1)


def digits_cents(digits: Column) -> Column:
    """Cents of a number's text; rounding is by decimal arithmetic, never by doubles."""
    return F.round(digits.try_cast("decimal(20,6)") * 100, 0).cast("long")


def price_cents(price: Column) -> Column:
    """The first number in cents; null without one, or above 14 digits before the point."""
    return digits_cents(price_digits(price))


def format_cents(cents: Column, currency: Column) -> Column:
    return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"), currency)


def eval_price(price: Column) -> Column:
    """T18 as scoring reads it: all characters but digits and points dropped; null if that is no number."""
    return F.regexp_replace(price, r"[^0-9.]", "").try_cast("double")


def clean_amount(amount: Column, has_price: Column) -> Column:
    """Tax letter, price-like values, units; empty if nothing is left."""
    a = strip(F.coalesce(amount, F.lit("")))
    a = F.regexp_replace(a, r"^(\d+\.\d{2})\s*[A-Za-z]$", "$1")
    price_like = a.rlike(r"^\d+\.\d{2}\s*[A-Za-z]?$")
    return F.when(price_like, F.lit("")).otherwise(strip(F.regexp_replace(a, X.UNIT_CODES, "")))


def eval_amount(amount: Column) -> Column:
    a = F.regexp_replace(F.lower(strip(F.coalesce(amount, F.lit("")))), r"\s+", "")
    return F.regexp_replace(F.regexp_replace(a, r"\blbs?\b", "lb"), r"\bkgs?\b", "kg")


def name_key(name: Column) -> Column:
    """Lower case, runs of white space as one space."""
    return F.regexp_replace(F.lower(strip(name)), r"\s+", " ")


def dedup_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")


def merge_name_key(name: Column) -> Column:
    return F.lower(F.regexp_replace(strip(F.coalesce(name, F.lit(""))), r"^\d+\s+", ""))


def merge_price_key(price: Column) -> Column:
    return F.regexp_replace(strip(F.coalesce(price, F.lit(""))), r"[A-Za-z]+$", "")


def store_words(store: Column) -> Column:
    words = F.split(F.lower(F.coalesce(store, F.lit(""))), r"\W+")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 3) & ~w.isin(X.STORE_STOP_WORDS)))


def date_key(date: Column) -> Column:
    return F.regexp_replace(strip(date), "[-/]", ".")


def is_mostly_cjk(name: Column) -> Column:
    """T21."""
    return F.length(F.regexp_replace(name, r"[^\x{4e00}-\x{9fff}]", "")) > F.length(name) * 0.4


def prompt_path(ocr: Column, n_chunks: Column) -> Column:
    """Which prompt a receipt takes, as the log labels it."""
    costco = F.contains(F.substring(F.upper(ocr), 1, 500), F.lit("COSTCO"))
    return F.concat(F.when((n_chunks == 1) & has_spatial(ocr), "direct").otherwise("cot"), F.when(costco, "+costco").otherwise(""))


def model_json(raw: Column) -> Column:
    """The JSON text in a model's answer, ready for from_json; null where there is none."""
    s = strip(raw)
    tagged = F.regexp_extract(s, r"(?s)<json>\s*(.*?)\s*</json>", 1)
    fenced = F.regexp_extract(s, r"(?s)```(?:json)?\s*\n(.*?)\n```", 1)
    inner = F.when(fenced != "", strip(fenced)).otherwise(s)
    found = F.regexp_extract(inner, r"(?s)(\{.*\}|\[.*\])", 1)
    repaired = F.regexp_replace(F.when(found != "", strip(found)).otherwise(inner), r",\s*([}\]])", "$1")
    return F.when(s == "", null_text()).when(tagged != "", strip(tagged)).otherwise(repaired)


def bearer_token(header: Column) -> Column:
    """T25."""
    return F.nullif(strip(F.regexp_replace(F.coalesce(header, F.lit("")), "^Bearer ", "")), F.lit(""))


def first_word(c: Column) -> Column:
    return F.split(c, " ")[0]


def model_slug(model: Column) -> Column:
    return F.lower(F.element_at(F.split(model, "/"), -1))


def file_stem(name: Column) -> Column:
    """The last path component without its last extension; a leading point is no extension."""
    base = F.element_at(F.split(name, "/"), -1)
    return F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")


def file_suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(F.element_at(F.split(name, "/"), -1), r"(?<=.)(\.[^.]+)$", 1))


def is_hallucinated(names: Column, ocr: Column) -> Column:
    """Of the first five names with a word of over 3 letters, none has such a word in the text."""
    words = lambda n: F.filter(F.split(F.lower(strip(F.coalesce(n, F.lit("")))), r"(?U)\W+"), lambda w: F.length(w) > 3)
    checked = F.filter(F.transform(F.slice(names, 1, 5), words), lambda w: F.size(w) > 0)
    return (F.size(checked) > 0) & ~F.exists(checked, lambda ws: F.exists(ws, lambda w: F.contains(F.lower(ocr), w)))
