"""URL rules as a sort-merge range join.

A host is keyed by its labels in reverse ("www.example.com" -> "com.example.www."), so a rule's host and all its subdomains are
one interval of keys, and intervals of different rules nest or are disjoint. Rules and URLs are laid on the same sorted axis of
(key, salt), cut into ranges at bounds that come from a deterministic sample of bounded size. Each range is swept once in sorted
order: a stack holds the rules whose interval is open, a URL tests the rules on the stack against its path, and the longest
fitting rule decides. The salt spreads a hot host over as many ranges as its share asks for; a rule is copied to those ranges
that its interval meets.

Host: what follows the first "://" up to "/", "?", "#" or the end, with A-Z lower-cased; path: from there up to "?", "#" or the
end. A null URL, or one without "://", has an empty host and path and fits no rule. Of fitting rules the longest (characters of
host and path together) wins; ties go to the longer host, then to "block", then to the smaller rule text. Repeated URLs get one
row each, also those without a page_id; URLs are judged whole, however long. Repeated rules count once, a null or empty rule host
fits nothing, and an empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import input_partitions

#: Rows of the sample that sets the ranges' bounds, at most about twice this; 40 bytes or so each.
SAMPLE_ROWS = 20_000

RULES = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("verdict", T.StringType())])
RESULT = "page_id long, host string, path string, rule string, verdict string"
HIGH = "\U0010ffff"  # above every character of a host


def split_url(df: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """page_id, host, path, key of each URL, by DataFrame functions."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    out = df.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return out.withColumn("key", F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit(".")))


def host_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class _Sweep:
    """A stack of the rules whose interval of keys holds the present key."""

    def __init__(self):
        self.stack: list[tuple[str, list[tuple[int, int, int, str, str, str]]]] = []

    def close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, host: str, path: str, verdict: str) -> None:
        self.close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, []))
        rules = self.stack[-1][1]
        rule = (-len(host) - len(path), -len(host), verdict != "block", host + path, path, verdict)
        if rule not in rules:
            bisect.insort(rules, rule)

    def judge(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.close(key)
        best = None
        for _, rules in self.stack:
            for rule in rules:
                if best is not None and rule >= best:
                    break
                if path.startswith(rule[4]):
                    best = rule
                    break
        return (best[3], best[5]) if best else (None, None)


def _bounds(urls: DataFrame, n_ranges: int) -> list[tuple[str, int]]:
    """Up to n_ranges - 1 bounds (key, salt), from rows whose hash falls in a share of the hash range: the same for the same rows."""
    if n_ranges < 2:
        return []
    total = urls.count()
    share = max(1, total // SAMPLE_ROWS)
    sample = urls.where(F.pmod(F.col("salt"), F.lit(share)) == 0).select("key", "salt").orderBy("key", "salt").limit(4 * SAMPLE_ROWS).collect()
    if not sample:
        return []
    found = {(sample[i * len(sample) // n_ranges]["key"], sample[i * len(sample) // n_ranges]["salt"]) for i in range(1, n_ranges)}
    return sorted(found)


def judge_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow", n_ranges: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict per row of pages. rules: host, path, verdict ("allow" or "block")."""
    spark = pages.sparkSession
    n_ranges = n_ranges or input_partitions(pages)
    urls = split_url(pages, id_col, url_col).withColumn("salt", F.xxhash64("page_id", "path"))
    bounds = _bounds(urls, n_ranges)
    keys, salts = [b[0] for b in bounds], [b[1] for b in bounds]

    def range_of(key: str, salt: int) -> int:
        at = bisect.bisect_left(keys, key)
        to = bisect.bisect_right(keys, key, lo=at)
        return at + bisect.bisect_right(salts, salt, lo=at, hi=to) - at

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, salt = b.column("key").to_pylist(), b.column("salt").to_pylist()
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([range_of(k, s) for k, s in zip(key, salt, strict=True)], pa.int32()), b.column("key"), pa.array([1] * n, pa.int32()), b.column("page_id"), b.column("host"), b.column("path"), pa.nulls(n, pa.string())],
                names=["range", "key", "kind", "page_id", "host", "path", "verdict"],
            )

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for host, path, verdict in zip(*(b.column(c).to_pylist() for c in ("host", "path", "verdict")), strict=True):
                key = host_key(host)
                first, last = bisect.bisect_left(keys, key), bisect.bisect_left(keys, key + HIGH)
                out += [(r, key, 0, None, host, path, verdict) for r in range(first, last + 1)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["range", "key", "kind", "page_id", "host", "path", "verdict"])

    placed = "range int, key string, kind int, page_id long, host string, path string, verdict string"
    known = rules.select(F.lower(F.col("host")).alias("host"), F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict").where("host is not null and host <> '' and verdict is not null").distinct()
    both = urls.mapInArrow(place_urls, placed).unionByName(known.mapInArrow(place_rules, placed))
    dealt = both.repartition(n_ranges, "range").sortWithinPartitions("range", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stack = None, _Sweep()
        for b in batches:
            rows = {c: [] for c in ("page_id", "host", "path", "rule", "verdict")}
            for r, key, kind, page, host, path, verdict in zip(*(b.column(c).to_pylist() for c in ("range", "key", "kind", "page_id", "host", "path", "verdict")), strict=True):
                if r != at:
                    at, stack = r, _Sweep()
                if kind == 0:
                    stack.open(key, host, path, verdict)
                    continue
                rule, found = stack.judge(key, path)
                for c, v in zip(rows, (page, host, path, rule, found or default), strict=True):
                    rows[c].append(v)
            kinds = [pa.int64()] + [pa.string()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))

    return dealt.mapInArrow(sweep, RESULT)


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES)
