"""Incremental runs."""

import datetime
import time

import pytest
from payloads import day, staged, tuples
from pyspark.sql import functions as F

from jsonmart.operators.upsert import KeyedTable
from jsonmart.plans import silver
from jsonmart.sources import catalog, landing
from jsonmart.streaming.incremental import refresh_latest, run_incremental, since_watermark, watermark

LANDED = "resource STRING, ingest_date STRING, run_id STRING, name STRING, payload STRING"


def land(spark, root, run, *rows):
    data = [("movie", "2024-01-01", run, str(i), f'{{"id":{i},"title":"{t}"}}') for i, t in rows]
    landing.write_landing(spark.createDataFrame(data, LANDED), root)


def test_new_files_are_picked_up_once(spark, tmp_path):
    root, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    cat = catalog.Catalog(spark, str(tmp_path / "catalog"))
    clock = iter(range(1, 10))

    def run(**options):
        stream = landing.read_landing_stream(spark, root, **options)
        ts = F.lit(datetime.datetime(2024, 1, next(clock)))
        return run_incremental(stream, cat, checkpoint, lambda: ts)

    land(spark, root, "r1", (1, "a"), (2, "b"))
    run()
    land(spark, root, "r2", (2, "B"), (3, "c"))
    land(spark, root, "r3", (4, "d"))
    run(maxFilesPerTrigger=1)
    got = tuples(cat.raw_payloads.read(), "tmdb_id", "dag_run_id", "extracted_at")
    assert got == [(1, "r1", day(1)), (2, "r1", day(1)), (2, "r2", day(2)), (3, "r2", day(2)), (4, "r3", day(2))]

    idle = run()
    assert idle.recentProgress == [] or all(p["numInputRows"] == 0 for p in idle.recentProgress)
    assert tuples(cat.raw_payloads.read(), "tmdb_id", "dag_run_id", "extracted_at") == got


def test_object_files_stream(spark, tmp_path):
    from test_landing import objects

    root = objects(tmp_path / "store")
    cat = catalog.Catalog(spark, str(tmp_path / "catalog"))
    stream = landing.read_objects_stream(spark, root)
    run_incremental(stream, cat, str(tmp_path / "checkpoint"))
    assert tuples(cat.raw_payloads.read(), "resource", "tmdb_id") == [
        ("credits", 550), ("genre", 0), ("movie", 7), ("movie", 550),
    ]
    times = cat.raw_payloads.read().select("extracted_at").union(cat.ingest_objects.read().select("loaded_at"))
    assert times.distinct().count() == 1


def test_a_document_landed_twice_counts_once(spark, tmp_path):
    root = str(tmp_path / "landing")
    cat = catalog.Catalog(spark, str(tmp_path / "catalog"))
    land(spark, root, "r1", (1, "first"), (2, "b"))
    land(spark, root, "r1", (1, "second"))
    run_incremental(landing.read_landing_stream(spark, root), cat, str(tmp_path / "checkpoint"))
    assert cat.ingest_objects.read().count() == 2
    assert tuples(cat.raw_payloads.read(), "tmdb_id", "payload") == [
        (1, '{"id":1,"title":"second"}'), (2, '{"id":2,"title":"b"}'),
    ]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "landing")
    cat = catalog.Catalog(spark, str(tmp_path / "catalog"))
    land(spark, root, "r1", (1, "a"), (2, "b"))
    ts = F.lit(day(1))
    for attempt in ("one", "two"):  # a lost checkpoint runs the same files again
        run_incremental(landing.read_landing_stream(spark, root), cat, str(tmp_path / attempt), lambda: ts)
    assert cat.raw_payloads.read().count() == 2 and cat.ingest_objects.read().count() == 2


@pytest.fixture
def snapshots(spark):
    return staged(
        spark,
        "movie",
        ({"id": 1, "title": "a1"}, 1),
        ({"id": 2, "title": "b1"}, 1),
        ({"id": 1, "title": "a2"}, 2),
        ({"id": 3, "title": "c2"}, 2),
        ({"id": 2, "title": "b3"}, 3),
    )


def movie_table(spark, path, df):
    return KeyedTable(spark, str(path), silver.movie(df).schema, ["movie_id"])


def test_incremental_equals_full(spark, tmp_path, snapshots):
    target = movie_table(spark, tmp_path, snapshots)
    for last in (1, 2, 2, 3):
        refresh_latest(snapshots.where(F.col("extracted_at") <= F.lit(day(last))), target, silver.movie)
    assert sorted(target.read().collect()) == sorted(silver.movie(snapshots).collect())
    assert watermark(target.read()) == day(3)


def test_late_snapshot_is_dropped_or_reprocessed(spark, tmp_path, snapshots):
    late = staged(spark, "movie", ({"id": 9, "title": "late"}, 1), ({"id": 1, "title": "older"}, 1, "late"))
    everything = snapshots.unionByName(late)
    target = movie_table(spark, tmp_path, snapshots)
    refresh_latest(snapshots, target, silver.movie)
    refresh_latest(everything, target, silver.movie)
    assert target.read().where("movie_id = 9").count() == 0
    refresh_latest(everything, target, silver.movie, late="reprocess", arrived=late)
    assert tuples(target.read(), "movie_id", "title") == [(1, "a2"), (2, "b3"), (3, "c2"), (9, "late")]
    with pytest.raises(ValueError):
        refresh_latest(everything, target, silver.movie, late="sometimes")


def test_watermark_is_strict_and_absent_target_is_all(spark, tmp_path, snapshots):
    target = movie_table(spark, tmp_path, snapshots)
    assert since_watermark(snapshots, target.read()).count() == 5
    refresh_latest(snapshots.where(F.col("extracted_at") <= F.lit(day(2))), target, silver.movie)
    assert since_watermark(snapshots, target.read()).count() == 1
