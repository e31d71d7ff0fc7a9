import hashlib
import random
from collections import defaultdict

import pytest
from brute import words

from jsonmart.llm import mixing as m
from jsonmart.llm.recipes import MIX
from llm_fixtures import *  # noqa: F403


def poured(given, children):
    """Shares of ``given`` among children {name: (capacity, weight)}, filling one child after the other."""
    full, left = {}, dict(children)
    while left:
        level = (given - sum(full.values())) / sum(w for _, w in left.values())
        small = min(left, key=lambda c: (left[c][0] / left[c][1], c))
        if left[small][0] > level * left[small][1]:
            return full | {c: min(cap, int(level * w)) for c, (cap, w) in left.items()}
        full[small] = left.pop(small)[0]
    return full


def quotas(leaves, mix):
    def weight(path):
        return mix.weights.get(path, mix.default_weight)

    cap = {p: n * mix.max_epochs if all(weight(p[:k]) > 0 for k in (1, 2, 3)) else 0 for p, n in leaves.items()}
    budget = mix.budget_tokens if mix.budget_tokens is not None else sum(leaves.values()) * mix.budget_percent // 100
    given = {(): min(budget, sum(cap.values()))}
    for depth in (1, 2, 3):
        groups = defaultdict(lambda: defaultdict(int))
        for p, c in cap.items():
            groups[p[: depth - 1]][p[:depth]] += c
        given = {k: v for parent, kids in groups.items()
                 for k, v in poured(given[parent], {k: (c, max(1, weight(k))) for k, c in kids.items()}).items()}
    return given


def chosen(rows, mix):
    """{(id, leaf, tokens): copies} by sorting each leaf."""
    def domain(source):
        return "crawl" if source == "src0" else "books" if source in {f"src{k}" for k in range(1, 10)} else "forums"

    leaves, members = defaultdict(int), defaultdict(list)
    for doc_id, text, lang, source in rows:
        path = (domain(source), lang or "", source or "")
        leaves[path] += len(words(text))
        members[path].append(("" if doc_id is None else str(doc_id), hashlib.md5((text or "").encode()).hexdigest(), len(words(text))))
    out = []
    for path, quota in quotas(leaves, mix).items():
        whole, rest = divmod(quota, leaves[path]) if leaves[path] else (0, 0)
        sums = defaultdict(int)
        for i, t, n in members[path]:
            sums[hashlib.md5(f"{mix.seed}|{whole + 1}|{i}|{t}".encode()).hexdigest()] += n
        total, inside = 0, set()
        for key in sorted(sums):
            total += sums[key]
            if rest and total <= rest:
                inside.add(key)
        for i, t, n in members[path]:
            copies = whole + (hashlib.md5(f"{mix.seed}|{whole + 1}|{i}|{t}".encode()).hexdigest() in inside)
            if copies:
                out.append((i, *path, n, copies))
    return sorted(out)


MIXES = [
    MIX,
    m.Mix(),
    m.Mix(budget_percent=100),
    m.Mix(weights={("crawl",): 0, ("books", "en"): 50}, budget_percent=90, max_epochs=4, seed=9),
    m.Mix(budget_tokens=0),
    m.Mix(budget_tokens=10**12, max_epochs=2),
]


@pytest.mark.parametrize("mix", MIXES)
@pytest.mark.parametrize("table", ["documents", "odd"])
def test_selection(request, table, mix):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    got = sorted(tuple(r) for r in m.selection(docs, mix).collect())
    assert got == chosen(rows, mix)


def test_small_buckets_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(m, "_BUCKET_DOCS", 2)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]
    assert sorted(tuple(r) for r in m.selection(documents, MIX).collect()) == chosen(rows, MIX)


def test_targets_are_met_where_there_is_enough(spark):
    rnd = random.Random(2)
    rows = [(k, "a " * 20, rnd.choice(["en", "de"]), f"src{rnd.choice([0, 0, 0, 1, 12])}", 1) for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mix = m.Mix(weights={("crawl",): 2, ("books",): 1, ("forums",): 1}, budget_percent=60)
    got = {r.domain: r.n for r in m.selection(docs, mix).groupBy("domain").agg({"n_tokens": "sum"}).toDF("domain", "n").collect()}
    assert got["crawl"] == pytest.approx(0.5 * 48000, rel=0.02) and got["books"] == pytest.approx(got["forums"], rel=0.02)


def test_rows_with_one_id_are_taken_one_by_one(spark):
    rows = [(None, f"a b c {k}", "en", "src0", 1) for k in range(50)] + [(1, "d e f g", "en", "src0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mix = m.Mix(budget_percent=50)
    got = sorted(tuple(r) for r in m.selection(docs, mix).collect())
    assert got == chosen([r[:4] for r in rows], mix) and sum(r[-2] for r in got) == 100  # of 204 tokens, 4 a row
    assert m.mixed(docs, mix).count() == len(got) == 25


def test_rows_keep_their_columns(clashing, odd_rows):
    mix = m.Mix(budget_percent=150, max_epochs=2)
    out = m.mixed(clashing, mix)
    assert out.columns == clashing.columns
    want = sum(r[-1] for r in chosen([(i, t, lang, s) for i, t, lang, s, _ in odd_rows], mix))
    assert out.count() == want


def test_empty_table(nothing):
    assert m.selection(nothing, MIX).count() == 0 == m.mixed(nothing, MIX).count()


def test_no_python_in_the_plan(documents):
    plan = m.selection(documents, MIX)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
