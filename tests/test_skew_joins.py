"""Spark can split the hot side of every join on a key that may hold a third of the rows."""

import pytest
from pyspark.sql import functions as F

from jsonmart.plans import gold, questions

# Small thresholds, so that a few thousand rows already count as skewed, and no broadcast.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture(autouse=True)
def small_thresholds(spark):
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k in SETTINGS:
        spark.conf.unset(k)


N = 40_000


def rows(spark, **columns):
    """N rows in several files' worth of partitions; a skewed join is split by map task."""
    return spark.range(0, N, 1, 8).select(*[F.expr(e).alias(n) for n, e in columns.items()])


HOT = "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END"
EVEN = "id % 5000"


def links(spark, movie, other, name):
    return rows(spark, movie_id=f"CAST({movie} AS BIGINT)", **{name: f"CAST({other} AS BIGINT)"})


def dim(spark, key, name):
    return spark.range(5000).select(F.col("id").alias(key), F.concat(F.lit("name of "), F.col("id")).alias(name))


def facts(spark):
    return spark.range(5000).selectExpr(
        "id AS movie_id", "CAST(id AS DECIMAL(28,10)) AS vote_average", "id AS revenue", "id AS budget"
    )


def cast(spark):
    return rows(
        spark,
        movie_id="id % 5000",
        person_id=f"CAST({HOT} AS BIGINT)",
        credit_id="CAST(id AS STRING)",
        cast_order="CAST(id % 3 AS INT)",
    )


CASES = {
    "hot genre": lambda s: questions.genre_popularity(
        links(s, EVEN, HOT, "genre_id"), dim(s, "genre_id", "genre_name"), facts(s)
    ),
    "hot movie by genre": lambda s: questions.genre_popularity(
        links(s, HOT, EVEN, "genre_id"), dim(s, "genre_id", "genre_name"), facts(s)
    ),
    "hot company": lambda s: questions.top_companies(
        links(s, EVEN, HOT, "company_id"), dim(s, "company_id", "company_name"), facts(s)
    ),
    "hot movie by company": lambda s: questions.top_companies(
        links(s, HOT, EVEN, "company_id"), dim(s, "company_id", "company_name"), facts(s)
    ),
    "hot person": lambda s: questions.most_credited(cast(s), dim(s, "person_id", "name")),
    "hot genre in lists": lambda s: gold.genre_lists(links(s, EVEN, HOT, "genre_id"), dim(s, "genre_id", "name")),
    "hot person in lists": lambda s: gold.top_cast(cast(s), dim(s, "person_id", "name")),
    "hot company in lists": lambda s: gold.primary_company(
        links(s, EVEN, HOT, "company_id"), dim(s, "company_id", "name")
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_hot_side_is_split(spark, case):
    df = CASES[case](spark)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
