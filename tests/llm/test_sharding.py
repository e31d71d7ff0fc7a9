from collections import Counter

import pytest

from jsonmart.llm import sharding as s
from llm_fixtures import *  # noqa: F403


def claimed(names, slots):
    """Turn by turn over the written-out preference lists."""
    lists = {x: [(s._hash(f"start {x}") + j * (s._hash(f"step {x}") % (slots - 1) + 1)) % slots for j in range(slots)] for x in names}
    owner = {}
    while len(owner) < slots:
        for k, x in enumerate(names):
            if len(owner) < slots:
                owner[next(slot for slot in lists[x] if slot not in owner)] = k
    return [owner[k] for k in range(slots)]


@pytest.mark.parametrize(("shards", "slots"), [(1, 2), (3, 7), (5, 101), (7, 7)])
def test_turns(shards, slots):
    names = [f"shard-{k}" for k in range(shards)]
    assert s.lookup_table(names, slots) == claimed(names, slots)


def test_shares_differ_by_one_slot_and_few_move():
    names = [f"shard-{k}" for k in range(64)]
    before = s.lookup_table(names)
    shares = Counter(before).values()
    assert max(shares) - min(shares) <= 1
    after = s.lookup_table(names[:-1])
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 63)
    assert moved < 0.1 * s.SLOTS


@pytest.mark.parametrize(("names", "slots"), [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_bad_tables(names, slots):
    with pytest.raises(ValueError):
        s.lookup_table(names, slots)


def test_rows(clashing, odd_rows, nothing):
    placed = s.with_shard(clashing)
    assert placed.columns == [*clashing.columns, "slot_", "shard_"]
    rows = placed.collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r.slot_ < s.SLOTS and 0 <= r.shard_ < s.SHARDS for r in rows)
    assert len({(r.doc_id, r.shard_) for r in rows}) == len({r.doc_id for r in rows})
    assert s.with_shard(nothing).count() == 0


def test_plan_has_no_shuffle_and_no_python(documents):
    plan = s.with_shard(documents)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_folders(spark, documents, tmp_path):
    s.write_shards(documents.select("doc_id", "text"), str(tmp_path / "out"), shards=8, parts=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count() and back.select("shard").distinct().count() == 8
