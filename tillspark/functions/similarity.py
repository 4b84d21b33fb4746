"""Matching-block similarity (Ratcliff and Obershelp): bounds as column expressions, the ratio itself as an Arrow function.

No JVM expression computes the ratio, but two say what it can't exceed: the matched characters are at most those of the shorter
text, and at most the characters that both have, each as often as in the text that has it less often. Both bounds are computed as the
ratio is, so a pair whose bound lies below a threshold has its ratio below it too. Only pairs that may reach the threshold leave the
JVM, and equal pairs are compared once by a worker that remembers them.
"""

from __future__ import annotations

import difflib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType

#: Pairs that a worker remembers.
REMEMBERED = 1 << 16
#: Pairs of a batch that are looked at together.
TOGETHER = 1 << 16


def length_bound(a: Column, b: Column) -> Column:
    """The ratio is at most this, by the lengths alone; 1 for two empty texts."""
    both = F.length(a) + F.length(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(F.lit(2.0) * F.least(F.length(a), F.length(b)) / both)


def common_characters(a: Column, b: Column) -> Column:
    """Number of characters that both texts have, counted as often as in the one that has each less often."""
    count = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    return F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(count(a, c), count(b, c))))


def character_bound(a: Column, b: Column) -> Column:
    """The ratio is at most this, by the characters of both; never above the length bound."""
    both = F.length(a) + F.length(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(F.lit(2.0) * common_characters(a, b) / both)


def may_reach(a: Column, b: Column, threshold: float) -> Column:
    """Whether the ratio may be this high; the cheaper bound goes first."""
    return F.when(length_bound(a, b) < threshold, F.lit(False)).otherwise(character_bound(a, b) >= threshold)


@lru_cache(REMEMBERED)
def compare(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matched characters over both lengths; null where either is null."""
    return pd.Series([None if x is None or y is None else compare(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(IntegerType())
def _closest(name: pd.Series, names: pd.Series) -> pd.Series:
    """Index of the name with the highest ratio of 0.6 or more, of equal ones the greatest text; null if there is none."""
    out = []
    for x, ys in zip(name, names, strict=True):
        near = [(score, y) for y in ys if (score := compare(y, x)) >= 0.6] if x and ys is not None else []
        out.append(list(ys).index(max(near)[1]) if near else None)
    return pd.Series(out, dtype="Int32")


def with_closest(df: DataFrame, name: str, rows: str, text, out: str) -> DataFrame:
    """df with `out`, of the array in column rows the element whose text is closest to the column name, of a ratio of 0.6 or more, else null.

    Elements that can't reach it are left out before; where none is left, nothing is compared.
    """
    near = F.when(F.col(name) != "", F.filter(rows, lambda r: may_reach(text(r), F.col(name), 0.6)))
    # Made once a row, by a generator: the optimiser would else copy it to where the Arrow function's result is used.
    found = df.select("*", F.inline(F.array(F.struct(near.alias("_near")))))
    some = F.size("_near") > 0
    at = found.withColumn("_at", _closest(F.when(some, F.col(name)), F.when(some, F.transform("_near", text))))
    return at.withColumn(out, F.get("_near", F.col("_at"))).drop("_near", "_at")


def _characters(texts: list[str]) -> np.ndarray:
    """Characters of each text, counted in 64 classes of their code points."""
    at = np.repeat(np.arange(len(texts)), np.array([len(t) for t in texts], dtype="int64"))
    kind = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4") & 63
    return np.bincount(at * 64 + kind, minlength=len(texts) * 64).reshape(len(texts), 64).astype(np.int32)


def _scores(names: list[str], keys: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of pairs of places 2 for equal texts, a ratio of 0.6 or more, else -1. The same bounds as above go first."""
    (a, to_a), (b, to_b) = (np.unique(c, return_inverse=True) for c in (x, y))
    a, b = [names[i] for i in a], [keys[i] for i in b]
    of_a, of_b = (np.array([len(t) for t in texts], dtype="int64") for texts in (a, b))
    both = np.maximum(of_a[to_a] + of_b[to_b], 1)
    left = np.flatnonzero((2.0 * np.minimum(of_a[to_a], of_b[to_b]) / both >= 0.6) | (of_a[to_a] + of_b[to_b] == 0))
    common = np.minimum(_characters(a)[to_a[left]], _characters(b)[to_b[left]]).sum(axis=1)
    out = np.full(len(x), -1.0)
    for p in left[(2.0 * common / both[left] >= 0.6) | (both[left] == 1)].tolist():
        name, key = a[to_a[p]], b[to_b[p]]
        score = 2.0 if name == key else compare(key, name) if name else -1.0
        out[p] = score if score >= 0.6 else -1.0
    return out


@F.arrow_udf(ArrayType(IntegerType()))
def closest_of_lists(names: pa.Array, keys: pa.Array) -> pa.Array:
    """Of two lists a row, for each name the place of the equal key, else of the key with the highest ratio of 0.6 or more, of equal ones
    the greatest text; null if there is none, or no list of keys. Equal pairs of a batch are compared once; pairs are made TOGETHER at a
    time, so long lists take no more memory."""
    sizes, many = (pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype("int64") for c in (names, keys))
    names_, keys_ = (c.flatten().dictionary_encode() for c in (names, keys))
    x_all, y_all = (pc.fill_null(c.indices, -1).to_numpy(zero_copy_only=False).astype("int64") for c in (names_, keys_))
    name_texts, key_texts = names_.dictionary.to_pylist(), keys_.dictionary.to_pylist()
    rank = np.empty(len(key_texts), dtype="int64")
    rank[sorted(range(len(key_texts)), key=key_texts.__getitem__)] = np.arange(len(key_texts))
    start, count = np.repeat(np.cumsum(many) - many, sizes), np.repeat(many, sizes)
    best = np.full(len(x_all), -1, dtype="int64")
    asked = np.flatnonzero((count > 0) & (x_all >= 0))
    ends = np.cumsum(count[asked])
    at = 0
    while at < len(asked):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOGETHER, "right")))
        some, n = asked[at:to], count[asked[at:to]]
        opens = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(opens, n)
        x, y = np.repeat(x_all[some], n), y_all[np.repeat(start[some], n) + place]
        pairs, back = np.unique(x * (len(key_texts) + 1) + y + 1, return_inverse=True)
        real = pairs % (len(key_texts) + 1) > 0  # a null key equals nothing
        score = np.full(len(pairs), -1.0)
        score[real] = _scores(name_texts, key_texts, pairs[real] // (len(key_texts) + 1), pairs[real] % (len(key_texts) + 1) - 1)
        score = score[back]
        top = np.repeat(np.maximum.reduceat(score, opens), n)
        order = np.where((score == top) & (score >= 0.6), rank[y], -1)
        chosen = np.repeat(np.maximum.reduceat(order, opens), n)
        hit = np.flatnonzero((order == chosen) & (chosen >= 0))
        best[np.repeat(some, n)[hit]] = place[hit]
        at = to
    values = pa.array(best, pa.int32(), mask=best < 0)
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32(), mask=np.append(names.is_null().to_numpy(zero_copy_only=False), False))
    return pa.ListArray.from_arrays(offsets, values)


def candidate_pairs(rows: Column, text, apart, threshold: float) -> Column:
    """Of an array of rows the pairs of places (i < j) whose texts differ and may be this similar, unless apart(a, b) holds."""

    def of(j: Column, b: Column) -> Column:
        earlier = F.transform(F.slice(rows, F.lit(1), j), lambda a, i: F.when((text(a) != text(b)) & (text(a) != "") & (text(b) != "") & ~apart(a, b) & may_reach(text(a), text(b), threshold), F.struct(i.alias("i"), j.alias("j"))))
        return F.array_compact(earlier)

    return F.flatten(F.transform(rows, lambda b, j: of(j, b)))


@F.pandas_udf(ArrayType(BooleanType()))
def first_of_similar(keys: pd.Series, codes: pd.Series, pairs: pd.Series) -> pd.Series:
    """Which items of an ordered list stay: those that equal or resemble (ratio 0.85, of the candidate pairs) none of the kept ones
    before, or differ from them in code."""

    def flags(names, code_list, candidates):
        if names is None:
            return None
        near: dict[int, list[int]] = {}
        for p in candidates:
            if compare(names[p["j"]], names[p["i"]]) >= 0.85:
                near.setdefault(p["j"], []).append(p["i"])
        kept: dict[str, list[str]] = {}  # codes of the kept items of a name
        out: list[bool] = []
        for j, (name, code) in enumerate(zip(names, code_list, strict=True)):
            equal = any(not (code and c and code != c) for c in kept.get(name, ()))
            same = equal or any(out[i] for i in near.get(j, ()))  # pairs apart in code are no candidates
            out.append(not same)
            if not same:
                kept.setdefault(name, []).append(code)
        return out

    return pd.Series([flags(n, c, p) for n, c, p in zip(keys, codes, pairs, strict=True)])
