import random

import pytest

from jsonmart.llm import token_counts as t
from llm_fixtures import *  # noqa: F403

PATH = t.vocabulary_path()


@pytest.fixture(scope="module")
def table():
    return t.frequent_lengths(PATH)


@pytest.fixture(scope="module")
def library():
    return t._library(PATH)


def test_documents(documents, library):
    got = {r.doc_id: r for r in t.token_counts(documents).collect()}
    for row in documents.collect():
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        assert (got[row.doc_id].n_tokens, got[row.doc_id].n_bytes) == (n, len((row.text or "").encode()))
        assert got[row.doc_id].over_limit == (n > 2048)


def test_any_characters(table, library):
    counter = t.Counter(PATH, table, entries=50)
    letters = [chr(k) for k in range(1, 0x260)] + ["'s", "'LL", "<|endoftext|>", "<|", "日", "😀", "́", " ", "ſ", "K"]
    for seed in range(1500):
        rnd = random.Random(seed)
        text = "".join(rnd.choice(letters + [" "] * 40 + list("abcdefgh'") * 10) for _ in range(40))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    assert len(counter.cache) <= len(table) + 50 + 40


def test_no_text_goes_whole_through_the_library(table, library, monkeypatch):
    counter = t.Counter(PATH, table)
    texts = ["“Quoted” — it’s … done", "Привет, мир! 漢字かな 한국어 हिन्दी", "e\u0301 \u00bd \u0130stanbul \u1e9e \u2028x\x1cy\x85z\u00a0 \u200b",
             "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|> <|ENDOFTEXT|>", "âģª \u206a \u2061", "\0 a\0b"]
    want = [len(library.encode(x, add_special_tokens=False).ids) for x in texts]
    monkeypatch.setattr(t, "_lengths", None)
    assert [counter.count(x) for x in texts] == want == [counter.count(x) for x in texts]


def test_all_kinds_of_characters(table, library):
    counter = t.Counter(PATH, table)
    rnd = random.Random(5)
    ranges = [(0x20, 0x7F), (0xA0, 0x600), (0x900, 0xE00), (0x1E00, 0x2400), (0x3000, 0x3200), (0x4E00, 0x5000), (0xAC00, 0xAD00), (0x1F300, 0x1F700)]
    for _ in range(1500):
        text = "".join(" " if rnd.random() < 0.2 else chr(rnd.randrange(*rnd.choice(ranges))) for _ in range(40))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_odd_rows(clashing, odd_rows, nothing, library):
    rows = t.token_counts(clashing).collect()
    want = sorted((len((x or "").encode()), len(library.encode(x or "", add_special_tokens=False).ids)) for _, x, *_ in odd_rows)
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == want
    assert t.token_counts(nothing).count() == 0


def test_nothing_is_shuffled(documents):
    assert "Exchange" not in t.token_counts(documents)._jdf.queryExecution().executedPlan().toString()
