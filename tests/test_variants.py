"""Documents kept as VARIANT give the same staged rows and tables as their texts."""

import pytest
from payloads import raw, tuples

from jsonmart.functions.variants import with_variant
from jsonmart.plans import silver
from jsonmart.plans.silver import SILVER
from jsonmart.plans.staging import stage

MOVIES = [
    {"id": 1, "title": "A", "genres": None},
    {"id": 2},
    {"id": "3", "genres": [], "budget": "", "popularity": "7.25", "runtime": "90"},
    {"id": 4, "genres": [{"id": 9, "name": "N"}, {"id": 8}], "popularity": 1.5, "adult": True, "budget": 10**12},
    {"id": 5, "genres": {"id": 5, "name": "A"}},
    {"id": 6, "genres": "x", "spoken_languages": [{"iso_639_1": " "}, {"iso_639_1": "en", "name": "é\n\"q\""}]},
    {"id": 7, "genres": [{"id": 5, "name": "A"}, 3, "x", [1]], "production_companies": [{"id": 7, "name": "c"}]},
    {"title": "no id", "genres": [{"id": 11}]},
    {"id": 8, "overview": {"a": [2]}, "production_countries": [{"iso_3166_1": "FR", "name": None, "more": 1}]},
]
CREDITS = [
    {"id": 1, "cast": [{"id": 3, "credit_id": "a", "order": 0, "popularity": 0.5}], "crew": []},
    {"id": 2, "cast": None, "crew": [{"id": 4, "credit_id": "b", "job": "Director"}, None]},
    {"id": 3},
]


def both(spark, resource, documents):
    texts = raw(spark, [(resource, d) for d in documents])
    return stage(texts, resource), stage(with_variant(texts), resource)


@pytest.mark.parametrize("resource, documents", [("movie", MOVIES), ("credits", CREDITS)])
def test_same_silver_rows(spark, resource, documents):
    from_text, from_variant = both(spark, resource, documents)
    assert from_variant.columns == from_text.columns
    assert from_variant.dtypes == from_text.dtypes
    for name, (inputs, build) in SILVER.items():
        if list(inputs) == [resource]:
            assert sorted(map(str, build(from_variant).collect())) == sorted(map(str, build(from_text).collect())), name


def test_shapes(spark):
    from_text, from_variant = both(spark, "movie", MOVIES)
    marked = tuples(from_variant, "source_key", "malformed")
    assert marked == tuples(from_text, "source_key", "malformed")
    assert [key for key, m in marked if m] == ["k4", "k5", "k6"]
    assert tuples(silver.movie_genre(from_variant)) == [(4, 8), (4, 9), (7, 5)]


def test_unreadable_and_other_documents_have_no_fields(spark):
    _, staged = both(spark, "movie", ["{", "[1]", "7", '{"id": 1, "id": 2}', '{"id": 3}'])
    assert tuples(staged, "source_key", "id", "malformed") == [
        ("k0", None, True), ("k1", None, True), ("k2", None, True), ("k3", None, True), ("k4", "3", False),
    ]


def test_nothing_is_parsed_when_a_stored_variant_is_read(spark, tmp_path):
    texts = raw(spark, [("movie", d) for d in MOVIES] + [("credits", d) for d in CREDITS])
    with_variant(texts).write.partitionBy("resource").parquet(str(tmp_path / "payloads"))
    stored = spark.read.parquet(str(tmp_path / "payloads"))
    for resource, documents in (("movie", MOVIES), ("credits", CREDITS)):
        staged = stage(stored, resource)
        plan = staged._jdf.queryExecution().toString()
        assert "from_json" not in plan and "parse_json" not in plan
        assert "resource#" in plan.split("PartitionFilters: [")[1].split("]")[0]
        from_text, _ = both(spark, resource, documents)
        shape = ["id", "malformed"]
        assert sorted(map(str, staged.select(shape).collect())) == sorted(map(str, from_text.select(shape).collect()))
