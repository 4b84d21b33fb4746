"""Language identification by Bayesian fusion of evidence.

For each row and language, log odds add up from
- the text: byte trigrams under a smoothed multinomial model per language, tempered so that n trigrams weigh like at most TEMPER,
- the language that the markup or metadata declares, believed with probability DECLARED,
- the address: a prior of the host that is smoothed towards its domain, that towards its address suffix, that towards the whole
  corpus. The counts behind it are sums of first-round posteriors (text and declaration) by grouped aggregation over all rows, so
  a host's own habit shows once it has rows enough.

The model is fitted on a sample of labelled rows, whole texts: of each label those whose hash falls in a share chosen so that about
SAMPLE_ROWS rows take part in all, and LEAST_ROWS of a label that has so many. Labels are counted over all rows, so no language is
lost for being rare. Only trigram counts reach the driver. Everything else covers all rows. A row is rejected (kept = false) if no evidence about it exists: no letters in its text, or a
final posterior under MIN_POSTERIOR, or a text in no known language. That is judged on its words, without the runs of ASCII letters
and signs that hold a digit (keys, digests; a text of such runs alone is judged on them): MIN_TRIGRAMS trigrams or more, whose mean
log likelihood lies with confidence, that is by MARGIN standard errors, more than JUNK_DEVIATIONS of a trigram's deviations below
the sample's mean in every language.

A null or empty text has no letters, so it is rejected, with the language that the other evidence suggests. A null or unknown
declaration and a null host are no evidence (the host's prior is then the corpus's). Ties between languages go to the first in
alphabetical order. Very long texts are scored whole, in batches of their own. Repeated rows are each judged and counted. Columns of the input may have any other names; they are carried
by `keep_languages` and ignored by `identify`. An empty table gives an empty result; without labelled rows a ValueError is raised
only if there is a row to judge.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches, text_or_empty, tidy, worker_slot

SAMPLE_ROWS, LEAST_ROWS = 3000, 50
BUCKETS = 1 << 16
TEMPER, DECLARED, STRENGTH = 60.0, 0.9, 20.0
MIN_POSTERIOR, JUNK_DEVIATIONS, MIN_TRIGRAMS = 0.5, 2.5, 20
MARGIN = 3.0 * 3**0.5  # three standard errors; neighbouring trigrams share letters, so only a third of them count as independent


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages, log probabilities
    mean: np.ndarray  # of a trigram's log likelihood in each language's own texts
    deviation: np.ndarray  # of a single trigram's

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams and summed log likelihoods, per text and language."""
        keys, counts = trigrams(texts)
        out = np.zeros((len(texts), len(self.languages)))
        if len(keys):
            ends = np.cumsum(counts)
            for k in range(len(self.languages)):
                sums = np.concatenate([[0.0], np.cumsum(self.table[keys, k], dtype=np.float64)])
                out[:, k] = sums[ends] - sums[ends - counts]
        return counts, out

    def junk(self, texts: list[bytes], counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Whether each text, with the trigrams and sums that scores() gives, is in no known language."""
        counts, sums = counts.copy(), sums.copy()
        mixed = [i for i, t in enumerate(texts) if _DIGIT.search(t)]
        if mixed:
            n, words = self.scores([_MIXED.sub(b" ", texts[i]) for i in mixed])
            for k, i in enumerate(mixed):
                if n[k]:
                    counts[i], sums[i] = n[k], words[k]
        below = ((sums / np.maximum(counts, 1)[:, None] - self.mean) / self.deviation).max(axis=1)
        # JUNK_DEVIATIONS isn't scaled by length: a text of several known languages lies below each one's mean, but not by whole deviations.
        return (counts >= MIN_TRIGRAMS) & (below + MARGIN / np.sqrt(np.maximum(counts, 1)) < -JUNK_DEVIATIONS)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams, text after text, and each text's number. ASCII letters are lower-cased, runs of other ASCII count as one space."""
    cleaned = [b" " + b" ".join(t.translate(_FOLD).split()) + b" " for t in texts]
    counts = np.array([max(0, len(c) - 2) if len(c) > 2 else 0 for c in cleaned], np.int64)
    data = np.frombuffer(b"".join(cleaned) + b"  ", np.uint8).astype(np.uint32)
    mixed = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA77)) ^ (data[2:] * np.uint32(0xC2B2AE3D))
    keys = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)
    wanted = np.ones(len(keys), bool)
    at = np.cumsum([len(c) for c in cleaned])
    for back in (1, 2):  # trigrams that would reach into the next text
        wanted[np.maximum(at - back, 0)] = False
    wanted[int(at[-1]) if len(at) else 0 :] = False
    short = np.array([len(c) <= 2 for c in cleaned])
    if short.any():
        for i in np.flatnonzero(short):
            wanted[int(at[i]) - len(cleaned[i]) : int(at[i])] = False
    return keys[wanted], counts


_FOLD = bytes((c + 32) if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_DIGIT = re.compile(rb"\d")
_MIXED = re.compile(rb"(?<![\w+/=-])[A-Za-z_+/=-]*+\d[\w+/=-]*+")


def fit(labelled: DataFrame, *, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from about sample_rows labelled rows, or LEAST_ROWS of each label, chosen by hashing their ids."""
    hashed = F.xxhash64(F.col(id_col), F.lit("langid")).alias("h")
    rows = labelled.select(hashed, F.col(text_col).alias("text"), F.col(label_col).alias("label")).where("text is not null and label is not null")
    found = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    if not found:
        return None
    languages = sorted(found)
    each = max(LEAST_ROWS, sample_rows // len(languages))
    shares = F.create_map(*chain.from_iterable((F.lit(label), F.lit(max(1, n // each))) for label, n in found.items()))
    sample = rows.where(F.pmod("h", shares[F.col("label")]) == 0)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in small_batches(batches, ["text"], 1 << 20):
            label = np.array(b.column("label").to_pylist())
            texts = [t.encode() for t in b.column("text").to_pylist()]
            for one in set(label.tolist()):
                keys = trigrams([texts[i] for i in np.flatnonzero(label == one)])[0]
                seen[one] = seen.get(one, np.zeros(BUCKETS, np.int64)) + np.bincount(keys, minlength=BUCKETS)
        for one, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([one] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at])], names=["label", "bucket", "n"])

    partial = sample.select("label", "text").mapInArrow(count, "label string, bucket long, n long")
    totals = partial.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows for each language
    column = np.searchsorted(languages, totals.column("label").to_pylist()) if totals.num_rows else np.zeros(0, np.int64)
    counts = np.zeros((BUCKETS, len(languages)))
    counts[totals.column("bucket").to_numpy(), column] = totals.column("n").to_numpy()
    table = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * BUCKETS))
    total = np.maximum(counts.sum(axis=0), 1)
    mean = (counts * table).sum(axis=0) / total
    deviation = np.sqrt((counts * (table - mean) ** 2).sum(axis=0) / total)
    return Model(languages, table.astype(np.float32), mean, deviation)


def html_text(html: Column) -> Column:
    """Text of a page: without scripts, styles, tags and character references."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&#?\w{1,20};", " ")


def declared_language(html: Column) -> Column:
    """The language code that the markup declares, without region, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#:]*)", 1))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def identify(rows: DataFrame, model: Model | None, *, id_col: str, text: Column, declared: Column, host: Column, strength: float = STRENGTH) -> DataFrame:
    """id, lang, confidence, kept per row."""
    spark = rows.sparkSession
    schema = f"{id_col} {rows.schema[id_col].dataType.simpleString()}, lang string, confidence double, kept boolean"
    if model is None:
        if rows.isEmpty():
            return spark.createDataFrame([], schema)
        raise ValueError("there are no labelled rows to learn the languages from")
    languages, L = model.languages, len(model.languages)
    names = ["id", "host", "evidence", "letters", "junk", *[f"p{k}" for k in range(L)]]

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_slot("langid")
        for b in small_batches(batches, ["text"], 2 << 20):
            texts = [t.encode() for t in b.column("text").to_pylist()]
            n, sums = model.scores(texts)
            each = sums / np.maximum(n, 1)[:, None]
            evidence = each * (n * TEMPER / (n + TEMPER))[:, None]
            junk = model.junk(texts, n, sums)
            for i, d in enumerate(b.column("declared").to_pylist()):
                if d in languages:
                    evidence[i] += np.log((1 - DECLARED) / max(1, L - 1)) if L > 1 else 0.0
                    evidence[i, languages.index(d)] += np.log(DECLARED) - (np.log((1 - DECLARED) / max(1, L - 1)) if L > 1 else 0.0)
            first = _softmax(evidence)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("host"), pa.array(list(evidence), pa.list_(pa.float64())), pa.array(n > 0), pa.array(junk), *(pa.array(first[:, k]) for k in range(L))], names=names
            )

    kind = rows.schema[id_col].dataType.simpleString()
    asked = rows.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"), F.lower(F.coalesce(declared, F.lit(""))).alias("declared"), F.coalesce(host, F.lit("")).alias("host"))
    scored = materialise(asked.mapInArrow(score, f"id {kind}, host string, evidence array<double>, letters boolean, junk boolean, " + ", ".join(f"p{k} double" for k in range(L))), "langid")

    # Sums of posteriors per host; hosts roll up to domains, domains to suffixes, suffixes to the corpus.
    sums = [F.sum(f"p{k}").alias(f"p{k}") for k in range(L)]
    by_host = scored.groupBy("host").agg(*sums)
    labels = F.split("host", r"\.")
    by_host = by_host.withColumn("suffix", F.element_at(labels, -1)).withColumn("domain", F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")))
    by_domain = by_host.groupBy("suffix", "domain").agg(*[F.sum(f"p{k}").alias(f"d{k}") for k in range(L)])
    by_suffix = by_domain.groupBy("suffix").agg(*[F.sum(f"d{k}").alias(f"s{k}") for k in range(L)])
    whole = by_suffix.agg(*[F.sum(f"s{k}").alias(f"g{k}") for k in range(L)]).first()  # one number for each language
    given = [whole[k] or 0.0 for k in range(L)]
    top = [F.lit((g + strength / L) / (sum(given) + strength)) for g in given]

    def smooth(own: str, above: list[Column]) -> list[Column]:
        total = sum((F.col(f"{own}{k}") for k in range(L)), F.lit(0.0))
        return [(F.col(f"{own}{k}") + F.lit(strength) * above[k]) / (total + F.lit(strength)) for k in range(L)]

    suffix = by_suffix.select("suffix", *[c.alias(f"s{k}") for k, c in enumerate(smooth("s", top))])
    domain = by_domain.join(suffix, "suffix").select("domain", *[c.alias(f"d{k}") for k, c in enumerate(smooth("d", [F.col(f"s{k}") for k in range(L)]))])
    prior = by_host.drop("suffix").join(domain, "domain").select("host", F.array(*[F.log(c) for c in smooth("p", [F.col(f"d{k}") for k in range(L)])]).alias("prior"))

    fused = scored.select("id", "host", "evidence", "letters", "junk").join(prior, "host")
    odds = F.zip_with("evidence", "prior", lambda a, b: a + b)
    most = F.array_max("odds")
    confidence = 1 / F.aggregate("odds", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    named = fused.withColumn("odds", odds).withColumn("most", most).withColumn("confidence", confidence)
    lang = F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position("odds", F.col("most")).cast("int"))
    return named.select(F.col("id").alias(id_col), lang.alias("lang"), F.round("confidence", 6).alias("confidence"), (F.col("letters") & ~F.col("junk") & (F.col("confidence") >= MIN_POSTERIOR)).alias("kept"))


def identify_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang, confidence, kept of rows with doc_id, text, lang (declared) and source (host)."""
    return identify(docs, model, id_col="doc_id", text=F.col("text"), declared=F.col("lang"), host=F.col("source"))


def identify_pages(pages: DataFrame, model: Model | None) -> DataFrame:
    """page_id, lang, confidence, kept of rows with page_id, url and html."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return identify(pages, model, id_col="page_id", text=html_text(html), declared=declared_language(html), host=host_of(F.col("url")))


def keep_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs without the rows that are rejected; rows that repeat an id stay or go together."""
    judged = identify_documents(docs, model).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    rejected = judged.where("not kept").select(F.col("doc_id").alias("_rejected"))
    return docs.join(rejected, docs["doc_id"].eqNullSafe(rejected["_rejected"]), "left_anti")
