"""The corpus pipeline: five stages over `documents`, each of them written as Parquet and reread as the next one's input.

All but the last return the columns of their input, whatever others there are beside doc_id, text, lang, source and n_chars and
however they are named. Texts are read whole, of any length. An empty table gives an empty result at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillspark.llm import exact_dedup, langid, ngram_join, packing, pii
from tillspark.llm.common import scratch
from tillspark.llm.queries import PII_KEY


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go; the model is fitted on the stage's own labelled rows.

    A null, empty or blank text has no language and goes. A null language or source is no evidence. Rows that repeat an id stay or
    go together, those without an id too; languages that tie go by the alphabet.
    """
    return langid.keep_languages(docs, langid.fit(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the smallest doc_id stays.

    Null counts as the empty text. Of repeated rows one stays; rows that tie on the id go by their other columns. A row without an
    id stays only where no row of its text has one.
    """
    return exact_dedup.unique_rows(docs, keep="smallest")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more over five-word shingles the smallest doc_id stays.

    A null, empty or blank text links with nothing and stays, and so does a row without an id. Rows that repeat an id are one
    document and stay or go together. Links chain: of a component one document stays.
    """
    return ngram_join.keep_one(docs, words=5, num=80, den=100)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, key: str = PII_KEY) -> DataFrame:
    """Personal data is replaced by format-preserving pseudonyms under the key; n_chars follows the new text.

    A null text stays null, with n_chars null, and an empty one empty. Rows are changed each by itself, repeated ones alike.
    """
    return pii.with_new_length(pii.pseudonymise(docs, key=key))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with the sequence and offset they are packed at.

    A null or empty text is one piece of the end id alone. Every row is packed, those that repeat an id or have none too; pieces of
    equal length are placed in order of salt, id, piece and checksum.
    """
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    # Executors come here with the heap that the stages before have filled, so workers get less memory than the operator's default.
    return packing.pack(docs, tokenizer=path, end_id=0, capacity=2048, remember_bytes=12 << 20, batch_bytes=1 << 20)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Language models and packing can't be expressed in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, pii_key: str = PII_KEY) -> DataFrame:
    """The stages in order. pii_key: a secret of the caller's for real texts; the default is for demonstration."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        made = stage(spark, docs, sf_dir, pii_key) if stage is pii_stage else stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
