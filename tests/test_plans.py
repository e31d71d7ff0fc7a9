"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from jsonmart.operators.pick import latest_by
from jsonmart.operators.upsert import KeyedTable
from jsonmart.plans import questions
from jsonmart.plans.registered import layers

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", entry.queries())
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_latest_row_is_limited_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(latest_by(events, ["user_id"], "ts", [F.col("event_id")]))
    nodes = re.findall(r"WindowGroupLimit|Exchange", text)
    assert nodes == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


@pytest.mark.parametrize("name", ["movie", "credit_cast", "person"])
def test_silver_needs_one_shuffle(spark, name):
    assert plan(layers(spark, SF_DIR).plan_silver(name)).count("Exchange") == 1


@pytest.mark.parametrize(
    "name, schema",
    [
        ("movie_genre", "id:string,genres:array<struct<id:string>>"),
        ("movie_country", "id:string,production_countries:array<struct<iso_3166_1:string>>"),
        ("credit_cast", "cast:array<struct<id:string,credit_id:string,character:string,order:string>>"),
        ("credit_crew", "crew:array<struct<id:string,credit_id:string,department:string,job:string>>"),
    ],
)
def test_array_scan_reads_only_its_fields(spark, name, schema):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        assert schema in plan(layers(spark, SF_DIR).plan_silver(name))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_question_filter_reaches_the_scan(spark):
    text = plan(questions.top_rated(layers(spark, SF_DIR).gold("movie_analytics")))
    assert "GreaterThanOrEqual(vote_count,500)" in text and "TakeOrderedAndProject" in text


def test_wide_mart_shuffles_each_list_once_for_the_joins(spark):
    """Left joins reuse the distribution of the folded lists: only the movie side is added."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(layers(spark, SF_DIR).plan_gold("movie_analytics"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_movie = re.findall(r"Exchange hashpartitioning\(movie_id#\d+L, \d+\)", text)
    assert len(by_movie) == 4


@pytest.mark.parametrize("given", [False, True])
def test_upsert_scans_only_touched_directories(spark, tmp_path, monkeypatch, given):
    """The plan that an upsert writes, taken from the upsert itself."""
    directories = None
    if given:
        directories = {"day": F.when(F.col("k") % 9 != 0, F.col("k") % 9), "half": F.col("k") < 25}
    plans, real = [], KeyedTable._write
    t = KeyedTable(spark, str(tmp_path), "k BIGINT, v STRING", ["k"], directories)
    t.upsert(spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    monkeypatch.setattr(KeyedTable, "_write", lambda self, df, *rest: plans.append(df) or real(self, df, *rest))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        t.upsert(spark.createDataFrame([(3, "b")], "k BIGINT, v STRING"))
        text = plan(plans[0])
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for name in t._directories(1):
        assert re.search(rf"PartitionFilters: \[[^\n]*dynamicpruningexpression\({name}#", text), name
    assert "EqualTo(v,b)" in plan(t.read().where("v = 'b'"))
    assert t.read().where("v = 'b'").count() == 1 and t.read().count() == 50
