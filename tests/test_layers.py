"""Builds: what is published, what stays, and that documents may be cut anywhere."""

from threading import Barrier

import pyarrow.parquet as pq
import pytest
from compare import connect, duckdb_rows, spark_rows
from payloads import raw
from pyspark.sql import functions as F
from test_quality import GOOD

from jsonmart.operators.quality import CheckFailed
from jsonmart.plans import registered
from jsonmart.plans.layers import Layers
from jsonmart.plans.oracles import ORACLES
from jsonmart.sources import star_tables

SF_DIR = "/root/testdata/sf0.001"


class Source:
    def __init__(self, spark, payloads):
        self.spark, self.payloads, self.reads = spark, payloads, []

    def __call__(self, resource):
        self.reads.append(resource)
        return raw(self.spark, self.payloads).where(F.col("resource") == resource)


def test_a_later_build_sees_new_payloads(spark, tmp_path):
    source = Source(spark, GOOD)
    warehouse = Layers(spark, str(tmp_path), source)
    with pytest.raises(LookupError):
        warehouse.published("gold/dim_genre")
    warehouse.build()
    assert [r.genre_name for r in warehouse.published("gold/dim_genre").collect()] == ["Drama"]
    source.payloads = [*GOOD, ("genre", {"genres": [{"id": 9, "name": "New"}]})]
    warehouse.build()
    names = warehouse.published("gold/dim_genre").orderBy("genre_name").collect()
    assert [r.genre_name for r in names] == ["Drama", "New"]
    assert Layers(spark, str(tmp_path), source).published("gold/dim_genre").count() == 2


def test_a_failing_check_leaves_the_old_build(spark, tmp_path):
    source = Source(spark, GOOD)
    warehouse = Layers(spark, str(tmp_path), source)
    warehouse.build()
    source.payloads = [*GOOD, ("movie", {"id": 11, "title": " "}, 2)]
    with pytest.raises(CheckFailed):
        warehouse.build()
    assert warehouse.published("silver/movie").count() == 1 and warehouse.published("gold/fact_movie").count() == 1


def test_payload_text_is_not_copied(spark, tmp_path):
    warehouse = Layers(spark, str(tmp_path), Source(spark, GOOD))
    warehouse.build()
    assert not list(tmp_path.glob("**/raw/**")) and list(tmp_path.glob("builds/*/staged/movie/*.parquet"))


def test_tables_that_a_mart_reads_are_built_side_by_side(spark, tmp_path):
    together = Barrier(2, timeout=60)

    def source(resource):
        if resource in ("movie", "credits"):
            together.wait()
        return raw(spark, GOOD).where(F.col("resource") == resource)

    assert Layers(spark, str(tmp_path), source).question("q1_top_rated").collect() == []  # no movie has the votes


def test_staged_texts_have_no_dictionary(spark, tmp_path):
    warehouse = Layers(spark, str(tmp_path), Source(spark, GOOD))
    assert warehouse.silver("movie").count() == 1

    def encodings(folder):
        files = [pq.read_metadata(f) for f in tmp_path.glob(f"builds/*/{folder}/*.parquet")]
        groups = [f.row_group(g) for f in files for g in range(f.num_row_groups)]
        return {e for g in groups for i in range(g.num_columns) for e in g.column(i).encodings}

    assert "PLAIN_DICTIONARY" in encodings("silver/movie") and "PLAIN_DICTIONARY" not in encodings("staged/movie")


@pytest.fixture(scope="module")
def two_line_documents():
    before, star_tables.DOCUMENT_LINES = star_tables.DOCUMENT_LINES, 2
    kept, registered._layers = registered._layers, {}
    yield
    star_tables.DOCUMENT_LINES, registered._layers = before, kept


@pytest.mark.parametrize(
    "name", [*[n for n in ORACLES if n.startswith("silver_")], "movie_analytics", "q5_departments", "frontier_people"]
)
def test_size_of_documents_changes_nothing(spark, two_line_documents, name):
    assert spark_rows(registered.QUERIES[name](spark, SF_DIR)) == duckdb_rows(connect(SF_DIR), ORACLES[name])


def test_both_builds_read_payloads_that_are_made_once(spark, monkeypatch):
    made = []

    def builder(resource):
        return lambda spark, sf: made.append(resource) or raw(spark, GOOD).where(F.col("resource") == resource)

    monkeypatch.setattr(star_tables, "RAW", {r: builder(r) for r in star_tables.RAW})
    rows = registered.QUERIES["rebuilt_movie_analytics"](spark, "no tables").collect()
    assert [(r.movie_id, r.genre_list, r.top_3_cast, r.primary_company) for r in rows] == [(10, "Drama", "P", "C")]
    assert sorted(made) == ["credits", "genre", "keywords", "movie", "person"]
