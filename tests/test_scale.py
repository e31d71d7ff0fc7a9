"""What keeps the work per task and the rows that are moved in proportion to the tables."""

import os
import re

import pytest
from conftest import TABLES
from pyspark.sql import functions as F

from jsonmart.plans import registered
from jsonmart.sources import landing, star_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def own_tables(tmp_path):
    """The small tables under a path of their own, so nothing that other tests have stored is used."""
    for t in TABLES:
        os.symlink(f"{SF_DIR}/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\((.*?)\), (\w+)", executed(df))


def test_objects_are_written_by_many_tasks(spark, own_tables, monkeypatch):
    monkeypatch.setattr(registered, "OBJECTS_PER_TASK", 3)
    root = registered._supplier_objects(spark, own_tables).removeprefix("file:")
    names = [f for _, _, files in os.walk(root) for f in files if f.startswith("part-")]
    assert len(names) == registered.table(spark, SF_DIR, "supplier").count()
    assert len({n.split("-")[1] for n in names}) > 2


def test_variants_are_stored_for_the_resources_asked_for(spark, own_tables):
    registered.QUERIES["variant_silver_country"](spark, own_tables).collect()
    assert _variant_folders(spark, own_tables) == {"movie"}
    registered.QUERIES["variant_silver_genre"](spark, own_tables).collect()
    assert _variant_folders(spark, own_tables) == {"movie", "genre"}
    root = registered.variant_layers(spark, own_tables).root.removeprefix("file:")
    assert not os.path.exists(root)  # the staged tables are views


def _variant_folders(spark, sf_dir):
    file = registered.variant_layers(spark, sf_dir).raw("movie").inputFiles()[0].removeprefix("file://")
    return set(os.listdir(file.rsplit("/", 2)[0]))


@pytest.mark.parametrize("build", [star_tables.movies, star_tables.credits, star_tables.keywords])
def test_lines_are_shuffled_once_by_document(spark, build):
    by_order = [how for keys, how in exchanges(build(spark, SF_DIR)) if keys.startswith("l_orderkey")]
    assert by_order == ["REPARTITION_BY_COL"]


@pytest.mark.parametrize("build", [star_tables.movies, star_tables.credits, star_tables.keywords])
def test_documents_of_a_large_table_are_gathered_by_more_tasks(spark, monkeypatch, build):
    def sums(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()

    before = sums(build(spark, SF_DIR))
    monkeypatch.setattr(star_tables, "LINES_PER_TASK", 300)
    split = build(spark, SF_DIR)
    lines = star_tables.table(spark, SF_DIR, "lineitem").count()
    assert [keys for keys, how in exchanges(split) if how == "REPARTITION_BY_NUM"][0].endswith(f", {-(-lines // 300)}")
    assert sums(split) == before


def test_landed_texts_are_compressed(spark, tmp_path):
    text = '{"id":1,"title":"ä' + "word " * 1000 + '"}'
    rows = spark.createDataFrame([("movie", "2024-01-01", "r", "1", text)], "resource STRING, ingest_date STRING, run_id STRING, name STRING, payload STRING")
    landing.write_landing(rows, str(tmp_path / "landing"))
    files = list((tmp_path / "landing").glob("resource=movie/*/*/part-*"))
    assert len(files) == 1 and files[0].stat().st_size < len(text) / 10
    assert [r.payload for r in landing.read_landing(spark, str(tmp_path / "landing")).collect()] == [text]


def test_credits_are_made_before_they_are_gathered(spark):
    """An aggregate evaluates its arguments without generated code, so they are plain columns."""
    gathered = re.findall(r"collect_list\((\w+)", executed(star_tables.credits(spark, SF_DIR)))
    assert gathered and set(gathered) == {"actor", "helper"}
