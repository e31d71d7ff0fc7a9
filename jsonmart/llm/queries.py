"""Registered queries of the operators and, where SQL can express them, their DuckDB versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import fresh_dir
from . import decontaminate, fill_middle, html_extract, lm_scoring, mixing, ngram_join, oracles, periodic_runs, quality_gam
from . import quality_rules, secrets_scan, sharding, warc
from . import token_counts as tokens
from .common import table
from .recipes import MIX

Query = Callable[[SparkSession, str], DataFrame]


def _secrets(spark, sf):
    return secrets_scan.secrets(table(spark, sf, "documents"))


def _token_counts(spark, sf):
    return tokens.token_counts(table(spark, sf, "documents"))


def _lm_scoring(spark, sf):
    return lm_scoring.scores(table(spark, sf, "documents"))


def _html_extraction(spark, sf):
    return html_extract.main_text(table(spark, sf, "pages"))


def _warc(spark, sf):
    archive = fresh_dir(spark, "llm-warc")
    warc.write_archive(table(spark, sf, "pages"), archive)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return warc.read_records(spark, archive).select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )


def _decontaminate(spark, sf):
    found = decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "item_size")


def _sharding(spark, sf):
    return sharding.with_shard(table(spark, sf, "documents").select("doc_id"))


def _quality_rules(spark, sf):
    judged = quality_rules.with_rules(table(spark, sf, "documents").select("doc_id", "text", "lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _mixing(spark, sf):
    taken = mixing.selection(table(spark, sf, "documents"), MIX)
    return taken.select(F.col("id").cast("long").alias("doc_id"), *mixing.LEVELS, "n_tokens", "copies")


def _ngram_join(spark, sf):
    spec = ngram_join.JaccardJoin(n=3, percent=90)
    linked = ngram_join.linked_documents(table(spark, sf, "documents"), spec)
    return linked.select("doc_id", "n_shingles", "component_id")


def _quality_classifier(spark, sf):
    return quality_gam.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _fill_in_middle(spark, sf):
    made = fill_middle.fill_in_middle(table(spark, sf, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def _periodic_runs(spark, sf):
    found = periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf, "documents")))
    line = lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", line), "")
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_secret_scan": _secrets,
    "op2_token_counts": _token_counts,
    "op3_decontamination": _decontaminate,
    "op4_sharding": _sharding,
    "op5_lm_scoring": _lm_scoring,
    "op6_html_extraction": _html_extraction,
    "op7_quality_rules": _quality_rules,
    "op8_mixing": _mixing,
    "op9_ngram_join": _ngram_join,
    "op10_warc": _warc,
    "op11_quality_classifier": _quality_classifier,
    "op12_fill_in_middle": _fill_in_middle,
    "op13_periodic_runs": _periodic_runs,
}

ORACLES: dict[str, str] = {
    "op4_sharding": oracles.sharding(),
    "op7_quality_rules": oracles.quality_rules(),
    "op8_mixing": oracles.mixing(MIX),
}
