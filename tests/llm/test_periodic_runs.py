"""Periodic runs: against a search over all periods and starts."""

import hashlib
import random
import zlib
from fractions import Fraction

import brute
import numpy as np
import pytest

from jsonmart.llm import queries
from jsonmart.llm.periodic_runs import PeriodicRuns, collapsed, periodic_runs, planted, runs_of_texts
from llm_fixtures import *  # noqa: F403


def brute_runs(words, least=24, exponent=3):
    """All runs, by trying every period; a run is kept only under its smallest one."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            start, length = i, end + q - i
            if length >= max(least, exponent * q) and (start, length) not in found:
                found[start, length] = q
            i = end
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_planted(text, doc_id):
    words = brute.words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_row(doc_id, text):
    words = brute_planted(text, doc_id)
    runs = brute_runs(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in dropped)),
    )


def test_all_documents(spark, documents, sf_dir):
    got = {tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    want = {brute_row(r.doc_id, r.text) for r in documents.collect()}
    assert got == want
    assert sum(1 for r in want if r[1]) > 10


@pytest.mark.parametrize("rows", ["odd", "clashing"])
def test_odd_rows(rows, odd_rows, request):
    short = [r for r in odd_rows if len(r[1] or "") < 100_000]
    got = periodic_runs(planted(request.getfixturevalue(rows)).where("coalesce(length(text), 0) < 100000"))
    seen = sorted((repr(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in got.collect())
    want = []
    for i, t, *_ in short:
        words = brute_planted(t, i)
        runs = brute_runs(words)
        want.append((repr(i), runs, collapsed([w.encode() for w in words], np.array(runs)).decode()))
    assert seen == sorted(want)


def test_empty_table(nothing):
    assert periodic_runs(planted(nothing)).collect() == []


def runs(texts, spec):
    return [[tuple(r) for r in part.tolist()] for part in runs_of_texts([t.encode() for t in texts], spec)[1]]


def test_random_texts_of_few_words():
    rng = random.Random(7)
    texts = []
    for k in range(600):
        part = lambda m: " ".join(rng.choices("abc"[: rng.randrange(1, 4)], k=m))
        root = part(rng.randrange(1, 14))
        texts.append(" ".join([part(rng.randrange(9)), *[root] * rng.randrange(6), part(rng.randrange(9)), part(k % 40)]))
    for least, exponent in ((24, 3), (3, 3), (8, 3), (10, 4)):
        spec = PeriodicRuns(least, exponent)
        want = [brute_runs(t.split(), least, exponent) for t in texts]
        assert runs(texts, spec) == want
        assert [runs([t], spec)[0] for t in texts[:80]] == want[:80]  # alone as among others


def test_every_period_at_its_smallest_length():
    for q in range(1, 70):
        root = [f"w{k}" for k in range(q)]
        text = " ".join(["x", *(root * 3), "y"])
        assert runs([text], PeriodicRuns(3))[0] == [(1, 3 * q, q)]
        assert runs([" ".join((root * 3)[:-1])], PeriodicRuns(3))[0] == []


def test_documents_do_not_meet():
    text = " ".join(["a b"] * 11)
    assert runs([text] * 5, PeriodicRuns()) == [[]] * 5
    assert runs([text, "", text + " a b", " \n"], PeriodicRuns()) == [[], [], [(0, 24, 2)], []]


def test_nested_runs_and_collapse():
    inner = ["a"] * 30 + ["b"]
    words = inner * 3 + ["c"]
    found = brute_runs(words)
    assert runs([" ".join(words)], PeriodicRuns())[0] == found and len(found) == 4
    assert collapsed([w.encode() for w in words], np.array(found)) == b"a b c"


def test_long_text_of_one_word():
    assert runs(["w " * 1_000_000], PeriodicRuns())[0] == [(0, 1_000_000, 1)]
    assert runs([" ".join(f"w{i % 70001}" for i in range(400_000))], PeriodicRuns())[0] == [(0, 400_000, 70001)]


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        PeriodicRuns(min_exponent=2)
