"""Keyed tables."""

import os
import random

import pytest
from payloads import tuples
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jsonmart.operators.upsert import KeyedTable

SCHEMA = "part STRING, k BIGINT, v STRING"


def table(spark, path):
    return KeyedTable(spark, str(path), SCHEMA, ["part", "k"], {"dir": F.col("part")})


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_insert_update_and_repeat(spark, tmp_path):
    t = table(spark, tmp_path)
    assert not t.exists() and t.read().count() == 0
    t.upsert(rows(spark, ("001", 1, "a"), ("001", 2, "b"), ("x=y/z", 1, "c")))
    update = rows(spark, ("001", 2, "B"), ("x=y/z", 3, "d"), ("new", 1, None))
    expected = [("001", 1, "a"), ("001", 2, "B"), ("new", 1, None), ("x=y/z", 1, "c"), ("x=y/z", 3, "d")]
    for _ in range(2):
        t.upsert(update)
        assert tuples(table(spark, tmp_path).read()) == expected


def test_matches_a_dict_over_random_batches(spark, tmp_path):
    rnd = random.Random(5)
    t, expected = table(spark, tmp_path), {}
    for batch in range(4):
        keys = rnd.sample(range(40), 15)
        data = [(f"p{k % 3}", k, f"{batch}-{k}") for k in keys]
        t.upsert(rows(spark, *data).repartition(3))
        expected.update({(p, k): (p, k, v) for p, k, v in data})
    assert tuples(t.read()) == sorted(expected.values())


def test_only_touched_directories_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(spark.range(400).select(F.concat(F.lit("p"), F.col("id") % 8).alias("part"), F.col("id").alias("k"), F.lit("a").alias("v")))
    before = {d: sorted(os.listdir(tmp_path / "data" / d)) for d in os.listdir(tmp_path / "data") if d.startswith("dir=")}
    t.upsert(rows(spark, ("p5", 5, "b")))
    after = {d: sorted(os.listdir(tmp_path / "data" / d)) for d in os.listdir(tmp_path / "data") if d.startswith("dir=")}
    assert len(before) == 8 and [d for d in before if before[d] != after[d]] == ["dir=p5"]
    assert t.read().where("v = 'b'").count() == 1 and t.read().count() == 400


def test_hash_parts_are_the_default(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path), "k BIGINT, v STRING", ["k"])
    t.upsert(spark.range(300).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    t.upsert(spark.range(250, 350).select(F.col("id").alias("k"), F.lit("b").alias("v")))
    assert t.read().groupBy("v").count().orderBy("v").collect() == [("a", 250), ("b", 100)]
    assert len([d for d in os.listdir(tmp_path / "data-8") if d.startswith("key_part=")]) == 8


def test_a_hot_key_is_cut_before_the_shuffle(spark, tmp_path, monkeypatch):
    """A third of the updates are versions of one key; the newest wins, and one row per task is shuffled."""
    plans, real = [], KeyedTable._stage
    monkeypatch.setattr(KeyedTable, "_stage", lambda self, df, *rest: plans.append(df) or real(self, df, *rest))
    updates = spark.range(3000).select(
        F.lit("p").alias("part"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("v"),
        F.col("id").alias("seen"),
    )
    t = table(spark, tmp_path)
    t.upsert(updates, latest_by=["seen"])
    assert t.read().count() == 2001 and t.read().where("k = 0").first().v == "2997"
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_two_updates_for_one_key_stop(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, ("p", 1, "a")))
    with pytest.raises(PySparkException, match="two updates for key"):
        t.upsert(rows(spark, ("p", 1, "b"), ("p", 1, "c")))
    assert tuples(t.read()) == [("p", 1, "a")]
    t.upsert(rows(spark, ("p", 1, "d")))
    assert tuples(t.read()) == [("p", 1, "d")]


def test_latest_of_several_updates_wins(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, ("p", 1, "old"), ("p", 3, "kept")))
    updates = spark.createDataFrame(
        [("p", 1, "z", 1), ("p", 1, "b", 2), ("p", 2, "x", None), ("p", 2, "y", 5)], SCHEMA + ", seen INT"
    )
    t.upsert(updates, latest_by=["seen"])
    assert tuples(t.read()) == [("p", 1, "b"), ("p", 2, "y"), ("p", 3, "kept")]


def test_a_run_that_dies_before_its_commit_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, ("p", 1, "a"), ("p", 2, "b")))

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_write", die)
        with pytest.raises(RuntimeError):
            t.upsert(rows(spark, ("p", 1, "lost")))
    assert tuples(t.read()) == [("p", 1, "a"), ("p", 2, "b")]
    t.upsert(rows(spark, ("p", 2, "c")))
    assert tuples(t.read()) == [("p", 1, "a"), ("p", 2, "c")]


def test_full_refresh_and_empty_updates(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, ("p", 1, "a"), ("q", 1, "b")))
    t.upsert(t.read().limit(0))
    assert t.read().count() == 2
    t.replace(rows(spark, ("q", 7, "z")))
    assert tuples(t.read()) == [("q", 7, "z")]
    t.replace(t.read().limit(0))
    assert t.read().count() == 0
    t.upsert(rows(spark, ("r", 1, "new")))
    assert tuples(t.read()) == [("r", 1, "new")]


def test_refresh_may_read_the_table_itself(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, ("p", 1, "a"), ("p", 2, "b")))
    t.replace(t.read().withColumn("v", F.upper("v")))
    assert tuples(t.read()) == [("p", 1, "A"), ("p", 2, "B")]


def parted(spark, path, **options):
    return KeyedTable(spark, str(path), "k BIGINT, v STRING", ["k"], **options)


def numbered(spark, n, v="a"):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(v).alias("v"))


def rewritten(before, after):
    """Directories whose files are not the same any more."""
    return {(before | after)[f] for f in before.keys() ^ after.keys()}


def test_parts_grow_with_the_table(spark, tmp_path):
    t = parted(spark, tmp_path, part_rows=20)
    seen = []
    for n in (50, 400, 1500):
        t.upsert(numbered(spark, n, str(n)))
        seen.append(t.parts())
        assert t.read().count() == n and t.read().where(F.col("v") != str(n)).count() == 0
    assert seen[0] == 8 and seen[0] < seen[1] < seen[2] <= 256
    assert parted(spark, tmp_path, part_rows=20).parts() == seen[2]  # kept with the table
    assert t._rows(t.parts()).groupBy("key_part").count().agg(F.max("count")).first()[0] <= 2 * 20


def test_one_key_touches_less_than_a_hundredth(spark, tmp_path):
    t = parted(spark, tmp_path, part_rows=10)
    t.upsert(numbered(spark, 2000))
    before = t.files()
    t.upsert(spark.createDataFrame([(7, "b")], "k BIGINT, v STRING"))
    assert len(rewritten(before, t.files())) == 1 and t.parts() == 256
    assert t.read().where("v = 'b'").collect() == [(7, "b")] and t.read().count() == 2000


def test_replace_lays_out_anew(spark, tmp_path):
    t = parted(spark, tmp_path, part_rows=20)
    t.replace(numbered(spark, 1000))
    assert t.parts() == 64 and t.read().count() == 1000
    t.replace(numbered(spark, 5, "b"))
    assert tuples(t.read()) == [(k, "b") for k in range(5)]


def test_a_growth_that_dies_leaves_the_old_layout(spark, tmp_path, monkeypatch):
    t = parted(spark, tmp_path, part_rows=20)
    t.upsert(numbered(spark, 100))
    real = KeyedTable._write

    def die(self, df, parts, mode):
        if mode == "static":
            raise RuntimeError("driver lost")
        return real(self, df, parts, mode)

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_write", die)
        with pytest.raises(RuntimeError):
            t.upsert(numbered(spark, 1000, "b"))
    assert t.parts() == 8 and t.read().where("v = 'b'").count() == 1000
    t.upsert(numbered(spark, 1000, "c"))
    assert t.parts() > 8 and t.read().where("v = 'c'").count() == 1000


def test_parts_are_a_power_of_two(spark, tmp_path):
    for parts in (0, 12):
        with pytest.raises(ValueError):
            parted(spark, tmp_path, parts=parts)
    t = parted(spark, tmp_path, parts=32)
    t.upsert(numbered(spark, 300))
    assert len([d for d in os.listdir(tmp_path / "data-32") if d.startswith("key_part=")]) == 32


def test_a_full_recompute_rewrites_changed_directories_only(spark, tmp_path):
    t = parted(spark, tmp_path, parts=64)
    t.upsert(numbered(spark, 1000))
    before = t.files()
    t.upsert(numbered(spark, 1000), changed_only=True)
    assert t.files() == before
    one = numbered(spark, 1001).withColumn("v", F.when(F.col("k") != 5, F.col("v")))  # a value to null, and a new key
    t.upsert(one, changed_only=True)
    assert len(rewritten(before, t.files())) == 2
    assert t.read().where("v IS NULL").collect() == [(5, None)] and t.read().count() == 1001


def test_the_hash_of_a_row_knows_where_its_nulls_are(spark, tmp_path):
    schema = "k INT, a STRING, b STRING, c ARRAY<INT>"
    t = KeyedTable(spark, str(tmp_path), schema, ["k"])
    t.upsert(spark.createDataFrame([(1, None, "x", [1]), (2, "", None, None), (3, "a", "bc", [])], schema))
    later = [(1, "x", None, [1]), (2, None, "", None), (3, "ab", "c", None)]
    t.upsert(spark.createDataFrame(later, schema), changed_only=True)
    assert sorted(map(tuple, t.read().collect())) == later


def test_keys_without_a_directory_are_kept_and_replaced(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path), SCHEMA, ["part", "k"], {"dir": F.nullif(F.col("part"), F.lit("none"))})
    t.upsert(rows(spark, ("none", 1, "a"), ("p", 1, "b")))
    t.upsert(rows(spark, ("none", 1, "c"), ("none", 2, "d")))
    assert tuples(t.read()) == [("none", 1, "c"), ("none", 2, "d"), ("p", 1, "b")]
