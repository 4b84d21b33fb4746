"""The corpus operators as queries over the driver's tables, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, exact_dedup, importance, langid, media, neighbours, ngram_join, packing, pii, token_counts, url_filter, vector_codes, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed by the query's contract: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary=str(public_tokenizers.path("piece_bpe_32k.model")))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer=str(public_tokenizers.path("word_bpe_49k.json")), end_id=0, capacity=2048)


#: For the queries; real runs bring a secret of their own.
PII_KEY = "demonstration key"


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=PII_KEY, count_col="n_replaced")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"), least_bytes=0).drop("url")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents and of pages: doc_id or page_id (the other is null), lang, confidence, kept."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = langid.fit(docs)
    a = langid.identify_documents(docs, model).withColumn("page_id", F.lit(None).cast("long"))
    b = langid.identify_pages(pages, model).withColumn("doc_id", F.lit(None).cast("long"))
    return a.unionByName(b)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary=str(path), pattern=public_tokenizers.PATTERN, coarse=byte_bpe.COARSE)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.read_media(media.store_texts(table(spark, sf_dir, "documents")))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_token_counts, op3_best_fit_packing, op4_pii, op5_warc, op6_ngram_join, op7_language_id, op8_url_filter, op9_byte_bpe, op10_media,
        op11_importance, op12_vector_codes, op13_neighbours,
    )
}


def codes_sql(parts=4, entries=256, rounds=4, scale=1024, width=16):
    """SQL of the codes: a step of three tables for each round."""
    good = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row_no, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})) AS v FROM embeddings WHERE {good})",
        f"parts AS MATERIALIZED (SELECT row_no, vec_id, label, p, v[p * {width} + 1 : p * {width} + {width}] AS x FROM kept, range({parts}) AS r(p))",
        f"book0 AS MATERIALIZED (SELECT p, row_no - 1 AS e, x AS c FROM parts WHERE row_no <= {entries})",
    ]
    for k in range(rounds + 1):
        # Squared distances are whole numbers, so one number holds distance and index.
        far = "list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)"
        steps.append(f"near{k} AS MATERIALIZED (SELECT row_no, vec_id, label, p, x, min(({far})::BIGINT * {entries} + e) AS best FROM parts JOIN book{k} USING (p) GROUP BY ALL)")
        if k < rounds:
            steps.append(f"""mean{k} AS MATERIALIZED (
                SELECT p, e, list(m ORDER BY i) AS c FROM (
                    SELECT p, best % {entries} AS e, i, floor(sum(x[i]) / count(*)) AS m FROM near{k}, range(1, {width + 1}) AS r(i) GROUP BY ALL
                ) GROUP BY p, e)""")
            steps.append(f"book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e))")
    return f"""
        WITH {", ".join(steps)}, digest AS (
            SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
        ), coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error FROM near{rounds} GROUP BY row_no, vec_id, label
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"""


ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
    "op8_url_filter": r"""
        WITH parts AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
        ), split AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), rules(rule_host, rule_path, verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), hits AS (
            SELECT page_id, rule_host || rule_path AS rule, verdict,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
            FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        )
        SELECT s.page_id, s.host, s.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
        FROM split s LEFT JOIN hits h ON s.page_id = h.page_id AND h.place = 1""",
    "op11_importance": r"""
        WITH crc AS (
            SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc_of
            FROM range(256) AS r(b)
        ), texts AS (
            SELECT doc_id, text, false AS target FROM documents UNION ALL SELECT NULL, text, true FROM benchmark
        ), words AS (
            SELECT row_number() OVER () AS row_no, doc_id, target,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
            FROM texts
        ), runs AS (
            SELECT row_no, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words
        ), counted AS (
            SELECT row_no, feature, count(*) AS n FROM runs GROUP BY ALL
        ), hashed AS (
            SELECT feature,
                   xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda h: ('0x' || h)::BIGINT)),
                                   lambda c, b: xor(c >> 8, crc_of[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT feature FROM counted), crc
        ), postings AS (
            SELECT row_no, doc_id, target, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) JOIN words USING (row_no) GROUP BY ALL
        ), buckets AS (
            SELECT bucket, coalesce(sum(n) FILTER (NOT target), 0)::BIGINT AS s, coalesce(sum(n) FILTER (target), 0)::BIGINT AS t FROM postings GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM buckets
        ), summed AS (
            SELECT doc_id, sum(n * gain)::BIGINT AS total FROM postings JOIN gains USING (bucket) WHERE NOT target GROUP BY doc_id
        ), sized AS (
            SELECT doc_id, sum(len(w))::BIGINT AS n_words, sum(len(w) + greatest(len(w) - 1, 0))::BIGINT AS n_features FROM words WHERE NOT target GROUP BY doc_id
        ), weighed AS (
            SELECT s.doc_id, n_words, n_features,
                   CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
                   ('0x' || substr(sha256('7:' || s.doc_id), 1, 8))::BIGINT AS h
            FROM sized s LEFT JOIN summed m ON s.doc_id IS NOT DISTINCT FROM m.doc_id
        ), scored AS (
            SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score, n_words >= 20 AND doc_id IS NOT NULL AS fit FROM weighed
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) FILTER (fit) OVER () AS n FROM scored
        )
        SELECT doc_id, n_words, n_features, weight, score, CASE WHEN fit AND place <= 25 * n // 100 THEN place END AS rank FROM placed""",
    "op12_vector_codes": codes_sql(),
}
