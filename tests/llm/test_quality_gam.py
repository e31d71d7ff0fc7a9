"""Quality classifier: held-out accuracy, planted additive and pairwise effects, one model for every partitioning."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from jsonmart.llm import queries, quality_gam
from jsonmart.llm.common import saved, table
from jsonmart.llm.quality_gam import FEATURES, GamSpec, features, fit, learned, measure, quality_scores
from llm_fixtures import *  # noqa: F403


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op11_quality_classifier"](spark, sf)
    rows = got.join(table(spark, sf, "labels"), "doc_id").collect()
    for side in (True, False):
        part = [r for r in rows if r.held_out == side]
        right = np.mean([r.predicted == r.quality for r in part])
        kept = np.mean([r.predicted for r in part if r.quality == 1])
        assert len(part) > 100 and right > 0.95 and kept > 0.97
        worst = np.mean([a.score < b.score for a in part if a.quality == 0 for b in part if b.quality == 1])
        assert worst > 0.97
    assert got.count() == table(spark, sf, "documents").count()


def test_columns_and_split(spark, sf_dir):
    rows = queries.QUERIES["op11_quality_classifier"](spark, sf_dir).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_labels_change_nothing(spark, documents):
    labels = table(spark, SF_DIR, "labels")  # noqa: F405
    turned = labels.withColumn("quality", F.when(quality_gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    want = sorted(map(tuple, quality_scores(documents, labels).collect()))
    assert sorted(map(tuple, quality_scores(documents, turned).collect())) == want
    other = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")).repartition(7)
    assert sorted(map(tuple, quality_scores(other, labels.repartition(3)).collect())) == want


@pytest.mark.parametrize("rows", ["odd", "clashing"])
def test_odd_rows(spark, rows, odd_rows, request):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (4, 0, 0), (6, 7, 0), (8, 1, 0), (9, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = quality_scores(request.getfixturevalue(rows), labels).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(r[0]) for r in odd_rows)
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert len({r.score for r in got if r.doc_id == 2}) == 1


def test_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_scores(nothing, none).collect() == []
    assert {r.score for r in quality_scores(odd, none).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (3, 1), (4, 1)], "doc_id long, quality int")
    assert {r.predicted for r in quality_scores(odd, ones).collect()} == {1}


def test_bounded_sample_is_taken_by_hash(spark, documents):
    measured = saved(features(documents), "test")
    labels = table(spark, SF_DIR, "labels")  # noqa: F405
    spec = GamSpec(max_rows=30, rounds=5, pair_rounds=2)
    one, two = learned(measured, labels, spec), learned(measured.repartition(9), labels, spec)
    assert one.base == two.base and all((a == b).all() for a, b in zip(one.tables, two.tables, strict=True))


def test_measures():
    named = lambda t: dict(zip(FEATURES, measure(t.encode()), strict=True))
    x = named("Go go go |\nGo go go |\nüb 12")
    assert x["log_words"] == pytest.approx(np.log1p(10)) and x["same_as_previous"] == 0.2
    assert x["repeated_lines"] == pytest.approx(1 / 3) and x["symbols"] == pytest.approx(2 / 28)
    assert x["upper"] == pytest.approx(2 / 15) and x["digits"] == pytest.approx(2 / 28) and x["open_lines"] == 1
    assert named("") == named(" \n\t") == dict.fromkeys(FEATURES, 0.0)


def synthetic(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(FEATURES))).astype(np.float32)
    return rng, x


def accuracy(model, x, y):
    return np.mean((model.score(x) >= 0.5) == y)


def test_additive_effects_are_learned():
    rng, x = synthetic(6000, 1)
    y = (np.sin(6 * x[:, 0]) + (x[:, 3] > 0.5) + 0.1 * rng.standard_normal(6000) > 0.6).astype(int)
    model = fit(x[:4000], y[:4000])
    assert accuracy(model, x[4000:], y[4000:]) > 0.9
    widest = sorted(range(len(FEATURES)), key=lambda k: -np.ptp(model.tables[k]))
    assert set(widest[:2]) == {0, 3}


def test_an_interaction_needs_the_pair():
    _, x = synthetic(6000, 2)
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(int)
    alone = fit(x[:4000], y[:4000], GamSpec(pairs=0))
    both = fit(x[:4000], y[:4000])
    assert both.pairs[0][:2] == (2, 5)
    assert accuracy(alone, x[4000:], y[4000:]) < 0.65 < 0.95 < accuracy(both, x[4000:], y[4000:])


def test_constant_and_repeated_columns():
    x = np.zeros((50, len(FEATURES)), dtype=np.float32)
    x[:, 1] = np.arange(50)
    model = fit(x, (np.arange(50) > 24).astype(int))
    assert accuracy(model, x, np.arange(50) > 24) >= 0.98  # a bin may hold both sides of the border
