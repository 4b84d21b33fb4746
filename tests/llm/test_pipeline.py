"""The corpus pipeline and the registered queries of the corpus operators."""

import hashlib
import os
import zlib
from pathlib import Path

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from tillspark.llm import langid, packing, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append((name, docs.count()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    by = dict(seen)
    assert before >= by["language_id"] > by["exact_dedup"] > by["near_dedup"] == by["pii"]
    assert docs.select("doc_id").distinct().count() == by["pii"]


def test_pipeline_against_brute_force(spark):
    from .test_operators import components

    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 5 < 2").collect()  # a small fixture, not a query
    frame = spark.createDataFrame(rows)
    first = langid.keep_languages(frame, langid.fit(frame)).collect()
    least = {}
    for r in sorted(first, key=lambda r: r["doc_id"]):
        least.setdefault(r["text"], r["doc_id"])
    second = sorted((i, t) for t, i in least.items())
    got = corpus_pipeline.exact_dedup_stage(spark, spark.createDataFrame(first), SF)
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == second
    third = {i for i, _, label in components(second, 5, 80, 100) if i == label}
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, got, SF).collect()} == third


def test_pipeline_of_edge_cases(spark, tmp_path):
    """The whole chain, with brute force for each stage, over nulls, empty, long and repeated texts, ties and odd columns."""
    prose = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(40).collect()]
    words = " ".join(prose).split()
    base, other = " ".join(words[:400]), " ".join(words[500:900])
    near = " ".join([*words[:399], "changed"])
    rows = [
        (1, None, "en", "s"), (2, "", "en", "s"), (3, " \n", None, None), (4, base, "en", "s"), (4, base, "en", "s"), (5, base, None, "s"), (6, near, "en", None),
        (7, other + " a.b@example.com", "en", "s"), (8, " ".join(words[:3000] * 12), "en", "s"), (9, " ".join(words[1000:1003]), "en", "s"), (None, " ".join(words[1100:1300]), "en", "s"),
        (10, "Жъщюя " * 50, None, "s"), (11, other.upper() + " c@example.com", "en", "s"),
    ]
    clashing = ("_rejected", "_row", "_text", "_h", "c0", "node", "row", "kept", "component_id", "_dropped", "length", "piece", "rank", "id", "host")
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} int" for c in clashing)
    table = [(i, t, lang, s, None if t is None else len(t), *range(len(clashing))) for i, t, lang, s in rows]
    more = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 7 = 0").select("doc_id", "text", "lang", "source", "n_chars").collect()  # texts to learn languages from
    table += [(10_000 + r["doc_id"], *tuple(r)[1:], *range(len(clashing))) for r in more]
    spark.createDataFrame(table, schema).coalesce(3).write.parquet(str(tmp_path / "documents.parquet"))

    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        before, docs = docs.columns, spark.read.parquet(str(tmp_path / str(k)))
        assert name == "packing" or docs.columns == before
        seen[name] = docs.where("doc_id is null or doc_id < 10000").collect()
    ids = lambda name: sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in seen[name])
    assert ids("language_id") == [-1, 4, 4, 5, 6, 7, 8, 9, 11]
    assert ids("exact_dedup") == [-1, 4, 6, 7, 8, 9, 11]
    assert ids("near_dedup") == ids("pii") == [-1, 4, 7, 8, 9]
    mail = f"u{hashlib.sha256(f'{queries.PII_KEY}|email|a.b@example.com'.encode()).hexdigest()[:16]}@example.invalid"
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in seen["pii"]}
    assert text[7] == (f"{other} {mail}", len(other) + 1 + len(mail)) and text[4] == (base, len(base))
    bpe = packing.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, (t, _) in text.items():
        raw = bpe._direct(t).tobytes() + bytes(4)
        want |= {(i, k): (at // 4, len(raw[at : at + 8192]) // 4, zlib.crc32(raw[at : at + 8192])) for k, at in enumerate(range(0, len(raw), 8192))}
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in seen["packing"]} == want
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(str, docs.select("doc_id", "piece", "ids_crc32").collect()))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and "sequence_id" in got.columns


def test_queries_against_sql(spark):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    for name, sql in queries.ORACLE_SQL.items():
        got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        order = sorted(want.columns)
        text = lambda f: sorted(map(str, f[order].astype(object).where(f[order].notna(), None).itertuples(index=False, name=None)))  # noqa: E731, B023
        assert text(got) == text(want), name


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_returns_a_row_for_each_input(spark, name):
    got = queries.QUERIES[name](spark, SF)
    table = "pages" if name in ("op5_warc", "op8_url_filter") else "documents"
    assert got.count() >= spark.read.parquet(f"{SF}/{table}.parquet").count()
