"""Data checks: the declarations, the gate, and that every single check can fire."""

import re

import pytest
from payloads import raw
from pyspark.sql import functions as F

from jsonmart.operators.quality import CheckFailed, ModelChecks, dq_report, gate, orphan_keys
from jsonmart.plans.checks import GOLD_CHECKS, SILVER_CHECKS
from jsonmart.plans.gold import GOLD
from jsonmart.plans.layers import Layers
from jsonmart.plans.silver import SILVER

CREDIT = {"id": 5, "name": "P", "credit_id": "c1", "order": 0}
GOOD = [
    ("genre", {"genres": [{"id": 1, "name": "Drama"}]}),
    (
        "movie",
        {
            "id": 10,
            "title": "T",
            "release_date": "2024-01-01",
            "genres": [{"id": 1, "name": "Drama"}],
            "production_companies": [{"id": 2, "name": "C"}],
            "production_countries": [{"iso_3166_1": "US", "name": "U"}],
            "spoken_languages": [{"iso_639_1": "en", "name": "E"}],
        },
    ),
    ("credits", {"id": 10, "cast": [CREDIT], "crew": [CREDIT | {"credit_id": "c2"}]}),
    ("keywords", {"id": 10, "keywords": [{"id": 3, "name": "k"}]}),
    ("person", {"id": 5, "name": "P"}),
]


def build(spark, path, payloads):
    return Layers(spark, str(path), lambda resource: raw(spark, payloads).where(F.col("resource") == resource))


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    return build(spark, tmp_path_factory.mktemp("layers"), GOOD)


def test_declared_counts():
    assert sum(c.count for c in SILVER_CHECKS) == 51
    assert sum(c.count for c in GOLD_CHECKS) == 42
    assert {c.model for c in SILVER_CHECKS} == set(SILVER)
    assert {c.model for c in GOLD_CHECKS} == set(GOLD)


def test_good_build_passes(layers):
    layers.build()
    for report, n in ((layers.silver_report(), 51), (layers.gold_report(), 42)):
        rows = report.collect()
        assert len(rows) == n and all(r.failures == 0 for r in rows)


@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_every_check_fires(layers, layer):
    """Each table gets every row twice, once more with all checked columns null, and an orphan."""
    checks = SILVER_CHECKS if layer == "silver" else GOLD_CHECKS
    read = layers.silver if layer == "silver" else layers.gold
    tables = {c.model: read(c.model) for c in checks}
    broken = {}
    for c in checks:
        df = tables[c.model]
        nulls = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in c.not_null else F.col(f.name) for f in df.schema])
        orphan = df
        for column, _, _ in c.parents:
            kind = df.schema[column].dataType.simpleString()
            value = {"string": F.lit("XX"), "date": F.lit("1900-01-01").cast("date")}.get(kind, F.lit(-1).cast(kind))
            orphan = orphan.withColumn(column, value)
        broken[c.model] = df.union(df).union(nulls).union(orphan)
    for c in checks:
        parents = {p: tables[p] for _, p, _ in c.parents}
        report = dq_report({**parents, c.model: broken[c.model]}, [c]).collect()
        assert len(report) == c.count
        silent = [(r.test, r.target) for r in report if r.failures == 0]
        assert not silent, f"{c.model}: {silent}"


def failures(tables, *checks):
    return {(r.test, r.target): r.failures for r in dq_report(tables, checks).collect()}


def test_failure_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c"), (2, None), (3, "x"), (3, "x")], "k INT, v STRING")
    got = failures({"m": df}, ModelChecks("m", ("k", "v"), ("k",)))
    assert got == {("not_null", "k"): 2, ("not_null", "v"): 2, ("unique", "k"): 2}
    pair = failures({"m": df}, ModelChecks("m", ("v",), ("k", "v")))
    assert pair == {("not_null", "v"): 2, ("unique", "k-v"): 1}
    assert failures({"m": df}, ModelChecks("m", ("v",))) == {("not_null", "v"): 2}


def related(child, parent, not_null=()):
    checks = ModelChecks("m", not_null, (), (("fk", "p", "pk"),))
    got = failures({"m": child, "p": parent}, checks)
    if not not_null:
        assert orphan_keys(child, "fk", parent, "pk").agg(F.sum("n")).first()[0] in (got[("relationships", "fk")], None)
    return got


def test_relationship_counts_rows_and_passes_nulls(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk INT")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "pk INT")
    assert related(child, parent) == {("relationships", "fk"): 2}
    assert related(child, parent, ("fk",)) == {("not_null", "fk"): 1, ("relationships", "fk"): 2}


def test_checks_on_empty_tables(spark):
    df = spark.createDataFrame([], "k INT, v STRING")
    checks = ModelChecks("m", ("k", "v"), ("k",), (("k", "m", "k"),))
    assert set(failures({"m": df}, checks).values()) == {0}


@pytest.mark.parametrize(
    "child, parent, orphans",
    [
        (("INT", ["1", "2", "3"]), ("DECIMAL(10,2)", ["1.00", "2.00"]), 1),
        (("DECIMAL(12,4)", ["1.0000", "2.5"]), ("BIGINT", ["1", "2"]), 1),
        (("BIGINT", ["9007199254740993"]), ("BIGINT", ["9007199254740992", "9007199254740993"]), 0),
        (("BIGINT", ["9007199254740993"]), ("BIGINT", ["9007199254740992"]), 1),
        (("STRING", ["1", "x"]), ("INT", ["1"]), 1),
        (("DATE", ["2024-01-01", "2024-01-02"]), ("TIMESTAMP", ["2024-01-01 00:00:00"]), 1),
        (("DOUBLE", ["-0.0", "NaN"]), ("DOUBLE", ["0.0", "NaN"]), 0),
    ],
)
def test_keys_of_other_types(spark, child, parent, orphans):
    def column(name, kind, values):
        return spark.createDataFrame([(v,) for v in values], "v STRING").select(F.col("v").cast(kind).alias(name))

    assert related(column("fk", *child), column("pk", *parent)) == {("relationships", "fk"): orphans}


def test_parts_of_a_key_do_not_run_together(spark):
    rows = [("a\x1fb", "c"), ("a", "b\x1fc"), ("", "x"), (None, "x"), (None, "x"), ("ab", "c"), ("a", "bc")]
    df = spark.createDataFrame(rows, "a STRING, b STRING")
    assert failures({"m": df}, ModelChecks("m", (), ("a", "b"))) == {("unique", "a-b"): 0}
    assert failures({"m": df.union(df.limit(1))}, ModelChecks("m", (), ("a", "b"))) == {("unique", "a-b"): 1}


def test_a_table_that_is_its_own_parent_and_shared_parents(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 9), (3, 1)], "id INT, boss INT")
    other = spark.createDataFrame([(2,), (7,)], "who BIGINT")
    got = dq_report(
        {"m": df, "o": other},
        [ModelChecks("m", ("id", "boss"), ("id",), (("boss", "m", "id"),)), ModelChecks("o", (), (), (("who", "m", "id"),))],
    )
    assert {(r.model, r.test, r.target): r.failures for r in got.collect()} == {
        ("m", "not_null", "id"): 0,
        ("m", "not_null", "boss"): 1,
        ("m", "unique", "id"): 1,
        ("m", "relationships", "boss"): 1,
        ("o", "relationships", "who"): 1,
    }


def test_each_key_is_shuffled_once_and_folded_before(spark):
    parent = spark.range(100).select(F.col("id").alias("pk"))
    child = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("fk"))
    report = dq_report({"m": child, "p": parent}, [ModelChecks("m", ("fk",), (), (("fk", "p", "pk"),)), ModelChecks("p", ("pk",), ("pk",))])
    plan = report._jdf.queryExecution().executedPlan().toString()
    exchange = "Exchange hashpartitioning(space"
    assert plan.count(exchange) == 1 and "SortMergeJoin" not in plan
    assert plan.index("HashAggregate(keys=[space") < plan.index(exchange) < plan.rindex("HashAggregate(keys=[space")


def test_gate_stops_before_gold(spark, tmp_path):
    payloads = [*GOOD, ("movie", {"id": 11, "title": " ", "production_companies": [{"id": 4, "name": " "}]})]
    layers = build(spark, tmp_path, payloads)
    with pytest.raises(CheckFailed) as failed:
        layers.build()
    assert {(r.model, r.target) for r in failed.value.rows} == {("movie", "title"), ("company", "name")}
    assert not (tmp_path / "gold").exists()


def test_gate_passes_clean_report(spark):
    gate(spark.createDataFrame([("m", "unique", "k", 0)], "model STRING, test STRING, target STRING, failures BIGINT"))


def test_failures_are_listed_only_for_rows_that_fail(spark):
    child = spark.createDataFrame([(1, "a"), (1, None), (3, "c")], "id INT, name STRING")
    parent = spark.createDataFrame([(1,), (2,)], "id INT")
    checks = (ModelChecks("parent", ("id",), ("id",)), ModelChecks("child", ("id", "name"), ("id",), (("id", "parent", "id"),)))
    report = dq_report({"child": child, "parent": parent}, checks)
    failed = {(r.model, r.test, r.target): r.failures for r in report.where("failures > 0").collect()}
    assert failed == {("child", "not_null", "name"): 1, ("child", "unique", "id"): 1, ("child", "relationships", "id"): 1}
    nodes = re.findall(r"Generate explode|Filter|Aggregate|LogicalRDD", report._jdf.queryExecution().optimizedPlan().toString())
    assert {after for node, after in zip(nodes, nodes[1:]) if node == "Generate explode"} == {"Filter"}
