"""Fill-in-the-middle: against a loop over units, and the exact round trip."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from jsonmart.llm import fill_middle, queries
from jsonmart.llm.fill_middle import FillMiddle, fill_in_middle, matcher, restored, transform
from llm_fixtures import *  # noqa: F403


def plainly(text, doc_id, percent=100, spm_percent=50):
    """One document, by a loop."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    i, j = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h[3] % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_documents(spark, documents, sf_dir):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = queries.QUERIES["op12_fill_in_middle"](spark, sf_dir).collect()
    assert len(rows) == documents.count()
    forms = set()
    for r in rows:
        n, form, prefix, middle, output = plainly(texts[r.doc_id], r.doc_id)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, prefix, middle, sha(output))
        assert r.restored_sha256 == sha(texts[r.doc_id])
        forms.add(form)
    assert {"psm", "spm"} <= forms


@pytest.mark.parametrize("rows", ["odd", "clashing"])
def test_odd_rows(rows, odd_rows, request):
    made = fill_in_middle(request.getfixturevalue(rows))
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", restored(F.col("output"), F.col("form")).alias("back"))
    want = [(i, *plainly(t, i), t or "") for i, t, *_ in odd_rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_empty_table(nothing):
    assert fill_in_middle(nothing).collect() == []


def test_random_texts_and_shares(spark):
    rng = random.Random(4)
    alphabet = ["a", "é", "日", "😀", "\n", "\n", "\r", " ", "<", "P>", "<S", ">", "\x0b", "\x85", " "]
    texts = [(k, "".join(rng.choices(alphabet, k=rng.randrange(30)))) for k in range(400)] + [(900, "x<M>y"), (901, "<P>"), (902, "\n")]
    spec = FillMiddle(percent=60, spm_percent=20)
    made = fill_in_middle(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), spec)
    back = restored(F.col("output"), F.col("form"), spec).alias("back")
    rows = {r.doc_id: r for r in made.select("*", back).collect()}
    for k, text in texts:
        assert tuple(rows[k])[1:] == (*plainly(text, k, 60, 20), text)
    shares = [sum(r.form == f for r in rows.values()) / len(rows) for f in ("spm", "psm", "plain")]
    assert 0 < shares[0] < shares[1] and shares[2] > 0.2


def test_other_units_and_markers():
    spec = FillMiddle(unit=r"[^ ]* |[^ ]+", prefix="[pre]", suffix="[suf]", middle="[mid]", spm_percent=0)
    n, form, prefix, middle, output = transform("one two three four", 5, spec, matcher(spec))
    assert (n, form) == (4, "psm") and output.startswith("[pre]") and len(output) == 18 + 15
    assert transform("a [mid] b", 5, spec, matcher(spec))[1] == "plain"
    gaps = FillMiddle(unit="a")
    assert transform("aab", 5, gaps, matcher(gaps)) == (0, "plain", None, None, "aab")


def test_long_texts():
    spec, pattern = FillMiddle(), matcher(FillMiddle())
    for text in ("word " * 2_000_000, "a\n" * 500_000, "\n" * 500_000 + "end"):
        assert transform(text, 11, spec, pattern) == plainly(text, 11)
    assert fill_middle.draws(11, 7) != fill_middle.draws(11, 8)
