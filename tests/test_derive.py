"""Derived receipts: Spark's form against DuckDB's on lines that tie, and how often rows are shuffled when no large table fits a broadcast."""

import re
from contextlib import contextmanager

import duckdb
import pytest

from tillspark import plans
from tillspark.plans.derive import STAR, derived, duck, ocr_texts

from .test_queries import SF, rows


@contextmanager
def only_nation_broadcasts(spark):
    """A threshold that of the tables only nation stays below."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "2600")
    yield
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def exchanges(df):
    """Shuffles of the plan as it runs, those that are used again counted once."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"\bExchange hashpartitioning", final))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables whose lines repeat their number, part and supplier, with lines without a part and an order that is there twice."""
    path = str(tmp_path_factory.mktemp("odd"))
    con = duckdb.connect()
    for t in STAR:
        con.execute(f"CREATE TABLE {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    con.execute("UPDATE lineitem SET l_orderkey = l_orderkey % 40, l_linenumber = l_linenumber % 2, l_partkey = CASE WHEN l_partkey % 11 = 0 THEN -1 ELSE l_partkey % 3 END, l_suppkey = l_suppkey % 2, l_extendedprice = round(l_extendedprice / 10000) * 10000, l_quantity = l_quantity % 3")
    con.execute("INSERT INTO orders SELECT * REPLACE (o_orderdate + INTERVAL 400 DAY AS o_orderdate) FROM orders WHERE o_orderkey = 7")
    con.execute("DELETE FROM lineitem WHERE l_orderkey = 7 AND rowid NOT IN (SELECT min(rowid) FROM lineitem WHERE l_orderkey = 7 AND l_partkey >= 0)")
    for t in STAR:
        con.execute(f"COPY {t} TO '{path}/{t}.parquet' (FORMAT parquet)")
    return path, con


@pytest.mark.parametrize("name", ["items", "ocr_lines", "truth", "ocr_texts"])
def test_derived_rows_of_tied_lines(spark, odd, name):
    path, con = odd
    drop = {"items": "receipt_id <> 7", "truth": "stem <> '7'"}.get(name, "true")  # which of an order's two dates comes first is open
    frame = ocr_texts(spark, path) if name == "ocr_texts" else derived(spark, path, name)
    got = frame.where(drop).toPandas()
    want = con.execute(f"{duck(name)} SELECT {', '.join(got.columns)} FROM {name} WHERE {drop}").df()
    assert len(got) and (rows(got) == rows(want))


def test_run_statistics_have_the_throughput(spark):
    """calls a minute are in the query and its SQL."""
    got = plans.QUERIES["e08_run_statistics"](spark, SF).toPandas()
    want = duckdb.connect().execute(f"SELECT round(60000.0 * count(*) / sum(CAST(round(value * 10) AS bigint)), 6) FROM '{SF}/events.parquet'").fetchone()[0]
    assert got["per_minute"].tolist() == pytest.approx([want] * 3) and "per_minute" in plans.ORACLE_SQL["e08_run_statistics"]


def test_texts_shuffle_lines_twice(spark):
    """lines to their parts and to their orders; orders to customers and to lines; parts and customers once."""
    with only_nation_broadcasts(spark):
        assert exchanges(plans.QUERIES["t14_address"](spark, SF)) <= 6


def test_output_rows_shuffle_lines_twice(spark):
    """the places of items come with the rows, not by a join with the same rows."""
    with only_nation_broadcasts(spark):
        assert exchanges(plans.QUERIES["f04_w02_output_rows"](spark, SF)) <= 6


@pytest.mark.parametrize(("name", "most"), [("j08_inject_weights", 6), ("j08_inject_weights_fuzzy", 7)])
def test_weights_meet_items_without_a_shuffle(spark, name, most):
    """items and weights are read once each, from the same two shuffles of lines; one more brings back what Python compared."""
    with only_nation_broadcasts(spark):
        assert exchanges(plans.QUERIES[name](spark, SF)) <= most


def test_closest_weights_shuffle_nothing_more(spark):
    """F1 of round 4: after Python has compared the names, rows are neither shuffled nor sorted again."""
    with only_nation_broadcasts(spark):
        df = plans.QUERIES["j08_inject_weights_fuzzy"](spark, SF)
        assert exchanges(df) <= 6
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above, _, below = final.partition("ArrowEvalPython")
    assert "Sort" not in above and "Exchange" not in above and "ArrowEvalPython" not in below
