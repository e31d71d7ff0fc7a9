"""Every registered query against DuckDB, on the given tables and on skewed ones."""

import os
import shutil

import duckdb
import pytest
from compare import TYPES, connect, duckdb_rows, duckdb_types, spark_rows
from conftest import TABLES

import __spark_entry__ as entry
from jsonmart.plans.oracles import ORACLES
from jsonmart.plans.registered import QUERIES
from jsonmart.sources import star_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    sql = ORACLES[name]
    assert spark_rows(df) == duckdb_rows(con, sql)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == duckdb_types(con, sql)


def test_entry(spark):
    assert entry.entry(spark).count() == 25


# A third of the order lines belong to one order, another third of all lines come from one
# supplier and use one part, a third of the events are one user's, and a quarter of the lines are
# there twice.
SKEW = {
    "lineitem": """
        WITH hot AS (
            SELECT * REPLACE (
                CASE WHEN hash(l_partkey, l_suppkey, l_orderkey) % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey,
                CASE WHEN hash(l_orderkey, l_suppkey) % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey,
                CASE WHEN hash(l_orderkey, l_partkey) % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey)
            FROM lineitem)
        SELECT * FROM hot UNION ALL SELECT * FROM hot WHERE l_linenumber % 4 = 0
    """,
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id) FROM events",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 9 ELSE o_custkey END AS o_custkey) FROM orders",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    source = connect(SF_DIR)
    for t in TABLES:
        if t in SKEW:
            source.execute(f"COPY ({SKEW[t]}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        else:
            shutil.copy(f"{SF_DIR}/{t}.parquet", os.path.join(folder, f"{t}.parquet"))
    return folder


@pytest.fixture(scope="module")
def small_documents():
    before = star_tables.DOCUMENT_LINES
    star_tables.DOCUMENT_LINES = 100
    yield
    star_tables.DOCUMENT_LINES = before


def test_long_order_is_split(spark, skewed, small_documents):
    pages = star_tables.credits(spark, skewed).where("tmdb_id = 42")
    assert pages.count() > 10
    assert star_tables.movies(spark, skewed).where("tmdb_id = 42").count() > 20


@pytest.mark.parametrize("name", QUERIES)
def test_matches_duckdb_on_skewed_tables(spark, skewed, small_documents, name):
    con = connect(skewed)
    assert spark_rows(QUERIES[name](spark, skewed)) == duckdb_rows(con, ORACLES[name])


def test_skew_is_real(skewed):
    hot = duckdb.sql(f"SELECT max(n) / sum(n) FROM (SELECT count(*) n FROM '{skewed}/lineitem.parquet' GROUP BY l_orderkey)")
    assert hot.fetchall()[0][0] > 0.3
