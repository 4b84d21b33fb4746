"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Numbers and dates that pass their validation are permuted by a keyed Feistel network inside the set of valid values of their
format, so a card number becomes another card number that passes the Luhn test, a date another date. A permutation maps equal
values to equal pseudonyms and different values to different ones, in every document, as long as the key is the same.

Found, in this order at each place of a text:
- e-mail addresses: local part and domain become "u", 16 hexadecimal digits of a keyed hash of the lower-cased address, and
  "@example.invalid" (an address has no small set of valid values to permute);
- IPv4 addresses with octets up to 255: all 32 bits;
- dates from 1900 to 2099 that exist: year-month-day with "-", "/" or ".", also ahead of a time ("T10:00"), day.month.year, and
  month/day/year: the day's number. Digits keep their count, so 2024-1-5 gives two-digit month and day only if needed. Where only
  day/month/year exists, the permutation is taken again until that holds for the pseudonym too, so both are read alike;
- telephone numbers: ten digits of the North American plan, whose area and exchange begin with 2 to 9, inside that plan, after +1 in
  any grouping or none, else in groups. All ways to write one number have one pseudonym, whether +1 or 1 stands before it or not.
  Ten digits after +1 that are outside the plan are permuted among such. Other numbers of 7 to 15 digits after "+": all but the
  country code's digits (the first group, of up to three). After +1 and ten digits the number is complete; others take the groups
  that follow them up to 15 digits, but not a value that is found by itself;
- social security numbers ddd-dd-dddd with valid parts, inside the valid ones;
- payment card numbers of 13 to 19 digits, bare or in groups, that begin with 2 to 6 and pass the Luhn test: all but the first
  digit, which stays, and the last, which is computed.
Punctuation stays as it is; values that fail validation stay unchanged.

A null text stays null and an empty one empty, with n_replaced 0; texts are read whole. Rows are independent of each other, so
ties and repeated rows need no rule; columns of any other names are carried along by `pseudonymise`. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DAYS, DAY_A, DAY_B = 73049, 17, 4297  # days of 1900 to 2099, and factors of their number
WALK = 48

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
DATE = r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([./])\d{1,2}\2\d{4})(?!(?!T\d\d:)\w|[./-]\d)"
NANP = r"(?<![\w+])(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?!\w)"
PLUS_ONE = r"(?<!\w)\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
#: Ten digits of the plan.
IN_PLAN = r"^[2-9]\d{2}[2-9]\d{6}$"
#: Values that may follow a number of 7 digits or more after a space and don't belong to it, without groups of their own.
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
NEXT = "|".join((
    r"[A-Za-z0-9._%+-]++@[A-Za-z0-9]",
    rf"{OCTET}(?:\.{OCTET}){{3}}(?!\w|\.\d)",
    r"(?:19|20)\d\d(?:-\d{1,2}-|/\d{1,2}/|\.\d{1,2}\.)\d{1,2}(?!(?!T\d\d:)\w|[./-]\d)",
    r"\d{1,2}(?:/\d{1,2}/|\.\d{1,2}\.)(?:19|20)\d\d(?!(?!T\d\d:)\w|[./-]\d)",
    r"(?:1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?!\w)",
    r"\d{3}-\d{2}-\d{4}(?![\w-])",
    # A phone's last group and the start of a card may look like a card; then the card is the later one.
    r"[2-6]\d{3}(?:(?! [2-6]\d{3}(?: \d{4}){2} \d{1,7}(?!\w))(?: \d{4}){2} \d{1,7}|(?:-\d{4}){2}-\d{1,7}|[ -]\d{6}[ -]\d{5})(?!\w)",
))
ABROAD = rf"(?<!\w)\+[1-9](?:[ .-]?\(?\d\)?){{6}}(?:(?! (?:{NEXT}))[ .-]?\(?\d\)?){{0,8}}(?!\w)"  # digits are bounded here, so a match ends with a group of a number of 7 to 15
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<!\w)(?:\d{13,19}|\d{4}([ -])\d{4}\3\d{4}\3\d{1,7}|\d{4}([ -])\d{6}\4\d{5})(?!\w)"
ALL = "|".join((EMAIL, IPV4, DATE, NANP, PLUS_ONE, ABROAD, SSN, CARD))
#: Every match holds a sign that this finds fast.
LIKELY = r"@|\d\W{0,3}\d"


def _hash(key: str, *parts: Column) -> Column:
    """60 bits of SHA-256 over the key and the parts, as a number."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, radix_a: Column, radix_b: Column, key: str, kind: str) -> Column:
    """Struct(a, b): a keyed permutation of the pairs below the radices. Rounds add, in turn, a hash of one half to the other."""

    def step(state: Column, i: Column) -> Column:
        even = (i % 2) == 0
        by_b = (state["a"] + F.pmod(_hash(key, F.lit(kind), i, radix_a, radix_b, state["b"]), radix_a)) % radix_a
        by_a = (state["b"] + F.pmod(_hash(key, F.lit(kind), i, radix_a, radix_b, state["a"]), radix_b)) % radix_b
        return F.struct(F.when(even, by_b).otherwise(state["a"]).alias("a"), F.when(even, state["b"]).otherwise(by_a).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def _power(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**k) for k in range(10)]), n + 1)


def _pad(x: Column, n: Column) -> Column:
    return F.lpad(x.cast("string"), n, F.lit("0"))


def permute_digits(d: Column, key: str, kind: str) -> Column:
    """A string of 2 to 18 digits, permuted among those of its length."""
    n = F.length(d)
    u = F.floor(n / 2).cast("int")
    v = n - u
    out = feistel(F.substr(d, F.lit(1), u), F.substr(d, u + 1, v), _power(u), _power(v), key, kind)
    return F.transform(F.array(out), lambda s: F.concat(_pad(s["a"], u), _pad(s["b"], v)))[0]


def refill(m: Column, d: Column) -> Column:
    """m with its digits replaced, in order, by those of d."""
    place = lambda i: F.length(_digits(F.substr(m, F.lit(1), i)))
    each = lambda i: F.when(F.substr(m, i, F.lit(1)).rlike("[0-9]"), F.substr(d, place(i), F.lit(1))).otherwise(F.substr(m, i, F.lit(1)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), each), "")


def luhn_sum(d: Column, first_doubled: bool) -> Column:
    """Sum of the digits from the right, every second one doubled with its digits added; the last itself first if asked."""

    def add(total: Column, i: Column) -> Column:
        x = F.substr(d, F.length(d) + 1 - i, F.lit(1)).cast("int")
        twice = x * 2 - F.when(x > 4, 9).otherwise(0)
        return total + F.when((i % 2) == (1 if first_doubled else 0), twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)


def _email(m: Column, key: str) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m))
    return F.concat(F.lit("u"), F.substring(F.sha2(text.cast("binary"), 256), 1, 16), F.lit("@example.invalid"))


def _ipv4(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    out = feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, "ipv4")
    text = lambda s: F.concat_ws(".", *[x.cast("string") for x in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256)])
    return F.when(F.array_max(octets) < 256, F.transform(F.array(out), text)[0]).otherwise(m)


def _date(m: Column, key: str) -> Column:
    parts = F.split(m, r"[-/.]")
    sign = F.regexp_extract(m, r"\D", 0)
    year_first = F.length(parts[0]) == 4
    make = lambda y, mo, d: F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    ymd, dmy, mdy = make(parts[0], parts[1], parts[2]), make(parts[2], parts[1], parts[0]), make(parts[2], parts[0], parts[1])
    month_first = ~year_first & (sign == "/") & mdy.isNotNull()
    day = F.when(year_first, ymd).when(month_first, mdy).otherwise(dmy)
    number = F.datediff(day, F.lit("1900-01-01").cast("date"))
    permuted = lambda a, b: feistel(a, b, F.lit(DAY_A), F.lit(DAY_B), key, "date")
    first = permuted(F.floor(number / DAY_B), number % DAY_B)
    day_of = lambda s: F.date_add(F.lit("1900-01-01").cast("date"), (s["a"] * DAY_B + s["b"]).cast("int"))
    # Of the days, three in five are above the 12th, so a walk this long always ends.
    walk = lambda s, _: F.when(F.dayofmonth(day_of(s)) > 12, s).otherwise(permuted(s["a"], s["b"]))
    day_first = ~year_first & ~month_first & (sign == "/")
    out = F.when(day_first, F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda s, i: walk(s, i))).otherwise(first)

    def text(s: Column) -> Column:
        new = day_of(s)
        y, mo, d = F.date_format(new, "yyyy"), F.date_format(new, "MM"), F.date_format(new, "dd")
        bare = lambda x, like: F.when(F.length(like) == 1, F.regexp_replace(x, "^0", "")).otherwise(x)
        return (
            F.when(year_first, F.concat(y, sign, bare(mo, parts[1]), sign, bare(d, parts[2])))
            .when(month_first, F.concat(bare(mo, parts[0]), sign, bare(d, parts[1]), sign, y))
            .otherwise(F.concat(bare(d, parts[0]), sign, bare(mo, parts[1]), sign, y))
        )

    return F.when((number >= 0) & (number < DAYS), F.transform(F.array(out), text)[0]).otherwise(m)


def _nanp(m: Column, key: str) -> Column:
    d = _digits(m)
    prefix = F.substr(d, F.lit(1), F.length(d) - 10)
    ten = F.substr(d, F.length(d) - 9, F.lit(10))
    a, b = F.substring(ten, 1, 3).cast("int") - 200, (F.substring(ten, 4, 3).cast("int") - 200) * 10000 + F.substring(ten, 7, 4).cast("int")
    out = feistel(a, b, F.lit(800), F.lit(8_000_000), key, "nanp")
    number = lambda s: F.concat((s["a"] + 200).cast("string"), (F.floor(s["b"] / 10000) + 200).cast("string"), _pad(s["b"] % 10000, F.lit(4)))
    return refill(m, F.concat(prefix, F.transform(F.array(out), number)[0]))


def _outside_plan(m: Column, key: str) -> Column:
    """+1 and ten digits that are no number of the plan: permuted again until they are none again, so both sets stay apart."""
    ten = F.substring(_digits(m), 2, 10)
    step = lambda d: F.when(d.rlike(IN_PLAN), permute_digits(d, key, "plus one")).otherwise(d)
    out = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), permute_digits(ten, key, "plus one"), lambda d, _: step(d))
    return refill(m, F.concat(F.lit("1"), out))


def _abroad(m: Column, key: str) -> Column:
    d = _digits(m)
    group = F.length(F.regexp_extract(m, r"^\+(\d+)", 1))
    keep = F.when(group <= 3, group).otherwise(F.lit(2))
    rest = F.substr(d, keep + 1, F.length(d) - keep)
    return F.when(F.length(d).between(7, 15), refill(m, F.concat(F.substr(d, F.lit(1), keep), permute_digits(rest, key, "phone")))).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    d = _digits(m)
    area, group, serial = (F.substring(d, at, n).cast("int") for at, n in ((1, 3), (4, 2), (6, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    out = feistel(F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")

    def number(s: Column) -> Column:
        return F.concat_ws("-", _pad(F.when(s["a"] >= 665, s["a"] + 2).otherwise(s["a"] + 1), F.lit(3)), _pad(F.floor(s["b"] / 9999) + 1, F.lit(2)), _pad(s["b"] % 9999 + 1, F.lit(4)))

    return F.when(valid, F.transform(F.array(out), number)[0]).otherwise(m)


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_digits(F.substr(d, F.lit(2), F.length(d) - 2), key, "card"))
    whole = F.transform(F.array(body), lambda b: F.concat(b, ((10 - luhn_sum(b, True) % 10) % 10).cast("string")))[0]
    return F.when(F.length(d).between(13, 19) & d.rlike("^[2-6]") & (luhn_sum(d, False) % 10 == 0), refill(m, whole)).otherwise(m)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match, or the match itself if it fails validation."""
    return (
        F.when(F.contains(m, F.lit("@")), _email(m, key))
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), _ipv4(m, key))
        .when(m.rlike(r"^(\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[./]\d{1,2}[./]\d{4})$"), _date(m, key))
        .when(m.rlike(r"^(\+?1[ .-]?)?(\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}$"), _nanp(m, key))
        .when(m.rlike(PLUS_ONE) & F.substring(_digits(m), 2, 10).rlike(IN_PLAN), _nanp(m, key))
        .when(m.rlike(PLUS_ONE), _outside_plan(m, key))
        .when(F.startswith(m, F.lit("+")), _abroad(m, key))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), _ssn(m, key))
        .otherwise(_card(m, key))
    )


def pseudonymise(docs: DataFrame, *, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """docs with the personal data in text_col replaced; with count_col, a column of the number of values replaced is added."""
    names = [c for c in docs.columns if c != count_col]
    text = docs[text_col].cast("string")
    packed = docs.select(F.struct(*[docs[c].alias(f"c{k}") for k, c in enumerate(names)]).alias("_row"), text.alias("_text"))
    likely = F.col("_text").rlike(LIKELY)
    hits = packed.withColumn("_hits", F.when(likely, F.regexp_extract_all("_text", F.lit(ALL), F.lit(0))))
    subs = hits.withColumn("_subs", F.when(F.size("_hits") > 0, F.transform("_hits", lambda m: pseudonym(m, key))))
    joined = F.array_join(F.zip_with(F.split("_text", ALL, -1), F.col("_subs"), lambda gap, sub: F.concat(gap, F.coalesce(sub, F.lit("")))), "")
    done = F.when(F.col("_subs").isNull(), F.col("_text")).otherwise(joined)
    count = F.when(F.col("_subs").isNull(), F.lit(0)).otherwise(F.size(F.filter(F.zip_with("_hits", "_subs", lambda a, b: a != b), lambda x: x)))
    at = {c: F.col(f"_row.c{k}") for k, c in enumerate(names)} | {text_col: done}
    return subs.select(*[at[c].alias(c) for c in names], *([count.cast("long").alias(count_col)] if count_col else []))


def with_new_length(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """length_col, where docs has it, set to the text's number of characters (null for a null text)."""
    if length_col not in docs.columns:
        return docs
    return docs.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
