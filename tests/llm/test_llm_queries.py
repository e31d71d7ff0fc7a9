"""The registered queries: DuckDB where SQL can say it, brute force elsewhere, and the pipeline."""

import os
import re

import brute
import pytest
from compare import TYPES, connect, duckdb_rows, duckdb_types, spark_rows

import corpus_pipeline
from jsonmart.llm import html_extract, ngram_join, queries, secrets_scan
from jsonmart.llm.common import saved, table
from llm_fixtures import *  # noqa: F403


@pytest.mark.parametrize("name", queries.ORACLES)
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_duckdb(spark, name, sf):
    con = connect(f"/root/testdata/{sf}")
    df = queries.QUERIES[name](spark, f"/root/testdata/{sf}")
    assert spark_rows(df) == duckdb_rows(con, queries.ORACLES[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == duckdb_types(con, queries.ORACLES[name])


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


CONTRACT = {
    "op1_secret_scan": ["doc_id bigint", "n_assign bigint", "n_access bigint", "n_hex bigint", "base_sha256 string", "spans string"],
    "op2_token_counts": ["doc_id bigint", "n_bytes bigint", "n_tokens bigint", "over_limit boolean"],
    "op6_html_extraction": ["page_id bigint", "url string", "text string", "n_chars bigint"],
    "op7_quality_rules": ["doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint",
                          "n_repeat_words bigint", "base_failed boolean", "kept boolean"],
    "op9_ngram_join": ["doc_id bigint", "n_shingles bigint", "component_id bigint"],
    "op10_warc": ["page_id bigint", "payload_bytes bigint", "payload_digest string", "record_type string", "refers_to bigint"],
    "op11_quality_classifier": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
    "op12_fill_in_middle": ["doc_id bigint", "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint",
                            "output_sha256 string", "restored_sha256 string"],
    "op13_periodic_runs": ["doc_id bigint", "n_runs bigint", "start bigint", "length bigint", "period bigint",
                           "exponent_milli bigint", "runs_sha256 string", "collapsed_sha256 string"],
}


@pytest.mark.parametrize("name", CONTRACT)
def test_contract(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    assert [f"{n} {t}" for n, t in df.dtypes][: len(CONTRACT[name])] == CONTRACT[name]
    assert df.count() == table(spark, sf_dir, "pages" if name in ("op6_html_extraction", "op10_warc") else "documents").count()


def test_query_rows(spark, sf_dir):
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    for r in queries.QUERIES["op1_secret_scan"](spark, sf_dir).collect():
        assert r.spans == secrets_scan.written(secrets_scan.scan(docs[r.doc_id])[1])
    want = {i: c for (i, _), c in brute.components(list(docs.items()), 3, 90).items()}
    assert {r.doc_id: r.component_id for r in queries.QUERIES["op9_ngram_join"](spark, sf_dir).collect()} == want
    pages = {r.page_id: r.html for r in table(spark, sf_dir, "pages").collect()}
    weights = html_extract.Weights(html_extract.PAGES)
    for r in queries.QUERIES["op6_html_extraction"](spark, sf_dir).collect():
        assert r.text == html_extract.extract(pages[r.page_id], weights)


def test_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sizes, seen = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        before, seen = seen, saved(stage(spark, seen, sf_dir), "test")
        assert seen.columns[:5] == docs.columns
        assert seen.select(docs.columns).exceptAll(before.select(docs.columns)).isEmpty(), name
        sizes.append(seen.count())
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "ngram_jaccard_join" and len(corpus_pipeline.STAGES) == 5
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > sizes[4] == sizes[5] > 0
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, seen.collect()))


def test_pipeline_on_odd_rows(spark, clashing, nothing, sf_dir):
    for start in (clashing, nothing):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = saved(stage(spark, docs, sf_dir), "test")
            assert docs.columns == start.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_near_duplicates_of_the_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    want = set(brute.components([(r.doc_id, r.text) for r in docs.collect()], 5, 80).values())
    assert {r.doc_id for r in ngram_join.keep_one(docs).collect()} == want


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(f"{root}/jsonmart"):
        if not folder.endswith(("llm", "__pycache__")):
            for name in names:
                if name.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, name)).read(), name
