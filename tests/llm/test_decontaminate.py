import re
import time

import pytest

from jsonmart.llm import decontaminate as d
from llm_fixtures import *  # noqa: F403

ITEMS = "item_id long, text string"


def brute(docs, items, n=5, percent=80):
    def words(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def grams(w, size):
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()

    lengths = {(i, t): min(n, len(words(t))) for i, t in items}
    sets = {(i, t): grams(words(t), size) for (i, t), size in lengths.items()}
    out = set()
    for doc_id, text in docs:
        own = {size: grams(words(text), size) for size in range(n + 1)}
        for (item, t), want in sets.items():
            own_grams = own[lengths[item, t]]
            if want and 100 * len(want & own_grams) >= percent * len(want):
                out.add((doc_id, item, len(want & own_grams), len(want)))
    return out


def found(docs, items, **spec):
    rows = d.leaks(docs, items, d.Containment(**spec)).collect()
    return sorted((r.doc_id, r.item_id, r.shared, r.item_size) for r in rows)


@pytest.mark.parametrize("spec", [{}, {"percent": 30}, {"percent": 100}, {"n": 3, "percent": 50}, {"block_bytes": 2000},
                                  {"block_bytes": 500, "scan_blocks": 1}])
def test_documents(spark, documents, sf_dir, spec):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()],
                 spec.get("n", 5), spec.get("percent", 80))
    assert want and found(documents, items, **spec) == sorted(want)


def test_partial_and_long(spark):
    item = " ".join(f"q{i}" for i in range(44))  # 40 shingles
    filler = " ".join(f"f{i}" for i in range(30000))
    cut = item.split()
    docs = [(1, f"{filler} {item} {filler}"), (2, item.upper().replace(" ", ", ")), (3, " ".join(cut[:36])), (4, " ".join(cut[:35])),
            (5, filler), (6, None), (7, ""), (8, item[:3])]
    items = spark.createDataFrame([(1, item), (2, item), (3, "too short"), (4, None), (5, ""), (None, item)], ITEMS)
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), items.where("item_id IS NOT NULL"))
    assert got == sorted(brute(docs, [(1, item), (2, item)]))
    assert {i for i, *_ in got} == {1, 2, 3}
    assert len(d.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()) == 9


def test_short_items_are_looked_up_whole(spark):
    docs = [(1, "The answer, he said, is forty-two today."), (2, "forty two days"), (3, "forty"), (4, "two forty today"), (5, None), (6, "")]
    items = [(1, "Forty two today"), (2, "is forty two today"), (3, "forty"), (4, "..."), (5, None), (6, "he said is forty two today")]
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert got == sorted(brute(docs, items))
    assert {(d, i) for d, i, *_ in got} == {(1, 1), (1, 2), (1, 3), (1, 6), (2, 3), (3, 3), (4, 3)}


def test_copies_of_an_item_are_held_once(spark, documents, sf_dir, monkeypatch):
    item = "one two three four five six seven"
    rows = spark.range(20000).select(d.F.lit(1).cast("long").alias("item_id"), d.F.lit(item).alias("text"))
    held = []
    real = d._scanner
    monkeypatch.setattr(d, "_scanner", lambda blocks, spec: held.extend(len(b.value) for b in blocks) or real(blocks, spec))
    docs = spark.createDataFrame([(7, f"x {item} y")], "doc_id long, text string")
    assert [tuple(r)[2:] for r in d.leaks(docs, rows).collect()] == [(1, 3, 3)]
    assert held == [1]


def test_sketches_are_built_once_per_worker():
    class Block:
        value = [(1, "a b c d e f")]

    spec = d.Containment()
    first = d._indexes("one", [Block], spec)
    assert d._indexes("one", [Block], spec) is first
    assert d._indexes("two", [Block, Block], spec) is not first and len(d._indexes("two", [], spec)) == 2


def test_clean_rows_stay(spark, clashing, odd_rows):
    items = spark.createDataFrame([(1, odd_rows[0][1][:60])], ITEMS)
    kept = d.keep_uncontaminated(clashing, items)
    assert kept.columns == clashing.columns
    assert kept.count() == len(odd_rows) - 3


def test_empty_tables(spark, nothing, odd):
    items = spark.createDataFrame([], ITEMS)
    assert d.leaks(nothing, items).count() == 0
    assert d.keep_uncontaminated(odd, items).count() == odd.count()


def test_many_items_do_not_slow_the_lookup():
    items = [(k, " ".join(f"w{(k * 7919 + i * 31) % 5000}" for i in range(30))) for k in range(5000)]
    index = d._Index(items, d.Containment())
    began = time.time()
    assert list(index.matches(d._words(items[17][1])))
    assert time.time() - began < 1
