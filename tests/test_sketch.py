"""Distinct counts from states that can be united."""

from pyspark.sql import functions as F

from jsonmart.operators.sketch import STANDARD_ERROR, sketched, united


def visits(spark):
    return spark.range(60_000).select((F.col("id") % 3).alias("kind"), F.floor(F.col("id") / 6000).alias("day"), (F.col("id") % 20_000).alias("who"))


def test_united_states_count_repeated_values_once(spark):
    df = visits(spark)
    states = sketched(df, ["kind", "day"], "who")
    exact = {r.kind: r.n for r in df.groupBy("kind").agg(F.count_distinct("who").alias("n")).collect()}
    got = {r.kind: r.n for r in united(states, ["kind"], "n").collect()}
    assert states.count() == 30 and got.keys() == exact.keys()
    assert all(abs(got[k] - exact[k]) <= 4 * STANDARD_ERROR * exact[k] for k in exact)


def test_order_and_number_of_states_do_not_matter(spark):
    df = visits(spark)
    whole = united(sketched(df, ["kind", "day"], "who"), ["kind"], "n").collect()
    parts = [sketched(df.where(F.col("day") % 2 == k), ["kind", "day"], "who") for k in (1, 0)]
    assert sorted(united(parts[0].union(parts[1]).repartition(7), ["kind"], "n").collect()) == sorted(whole)


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None), (None, 2), (None, 2)], "g STRING, v BIGINT")
    got = {r.g: r.n for r in united(sketched(df, ["g"], "v"), ["g"], "n").collect()}
    assert got == {"a": 1, "b": 0, None: 1}
    assert united(sketched(df.where("false"), ["g"], "v"), ["g"], "n").collect() == []
