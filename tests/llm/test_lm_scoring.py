import random

import numpy as np
import pytest

from jsonmart.llm import lm_scoring as lm
from llm_fixtures import *  # noqa: F403

SPEC = lm.WindowModel(words=20, hash_classes=4, width=8, rounds=3, stride=1)
CYCLE = "the red fox ran over the old hill and saw a small bird in a tall tree by the river".split()


def padded(texts, classes):
    hashes, sizes = lm._hashed(texts)
    return lm._padded(classes.of(hashes), sizes)


def text(rnd, n=120):
    at = rnd.randrange(len(CYCLE))
    return " ".join(CYCLE[(at + i) % len(CYCLE)] for i in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(1)
    return spark.createDataFrame([(k, text(rnd)) for k in range(60)], "doc_id long, text string").repartition(4)


@pytest.fixture(scope="module")
def fitted(corpus):
    return lm.fit(corpus, SPEC)


def test_held_out_order_is_told_from_shuffled(spark, fitted):
    rnd = random.Random(2)
    rows = []
    for k in range(30):
        words = text(rnd).split()
        rows.append((2 * k, " ".join(words)))
        rnd.shuffle(words)
        rows.append((2 * k + 1, " ".join(words)))
    got = {r.doc_id: r.mean_log_prob for r in lm.scores(spark.createDataFrame(rows, "doc_id long, text string"), fitted, SPEC).collect()}
    assert all(got[2 * k] > got[2 * k + 1] for k in range(30))
    assert np.mean([got[2 * k] for k in range(30)]) > -0.7


def test_scores_are_sums_of_conditionals(spark, fitted):
    common, model = fitted
    doc = "the red fox saw unknownword by"
    classes = lm._Classes(common, SPEC)
    ids = [0, 0, *classes.of(lm.word_hashes([w.encode() for w in doc.split()])), 0, 0]
    tables, bias, out, out_bias = (p.astype(float) for p in model)
    total = 0.0
    for i in range(2, len(ids) - 2):
        h = np.tanh(sum(tables[k][ids[i + side]] for k, side in enumerate((-2, -1, 1, 2))) + bias)
        z = h @ out + out_bias
        total += z[ids[i]] - np.log(np.exp(z).sum())
    row = lm.scores(spark.createDataFrame([(1, doc)], "doc_id long, text string"), fitted, SPEC).first()
    assert row.n_tokens == 6 and row.log_prob == pytest.approx(total, abs=1e-3)


def test_words_on_both_sides_matter(spark, fitted):
    docs = [(1, "over the old hill and"), (2, "over the old hill bird"), (3, "bird the old hill and")]
    got = {r.doc_id: r.log_prob for r in lm.scores(spark.createDataFrame(docs, "doc_id long, text string"), fitted, SPEC).collect()}
    assert got[1] > got[2] and got[1] > got[3]


def test_common_words_count_all_documents(corpus):
    from collections import Counter

    count = Counter(w for r in corpus.collect() for w in r.text.split())
    want = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))][:20]
    assert [w.decode() for w in lm.common_words(corpus, SPEC)] == want


def test_same_input_same_model(corpus, fitted):
    again = lm.fit(corpus, SPEC)
    assert all(np.array_equal(a, b) for a, b in zip(fitted[1], again[1], strict=True))


def test_slopes():
    """The step against a numeric derivative."""
    spec = lm.WindowModel(words=3, hash_classes=2, width=4)
    model = [p.astype(np.float64) for p in lm._start(spec)]
    ids, places = np.array([0, 0, 1, 2, 3, 1, 0, 0]), np.arange(2, 6)
    loss = lambda ps: -lm._forward(ps, ids, places)[1][np.arange(4), ids[places]].mean()
    before = [p.copy() for p in model]
    lm.train_on(model, [np.zeros_like(p) for p in model], ids, places, spec)
    for p, old in zip(model, before, strict=True):
        moved = (old - p).ravel()
        for i in range(0, moved.size, 3):
            probe = [q.copy() for q in before]
            k = next(j for j, q in enumerate(before) if q is old)
            probe[k].ravel()[i] += 1e-4
            slope = (loss(probe) - loss(before)) / 1e-4
            if abs(slope) > 1e-3:
                assert np.sign(moved[i]) == np.sign(slope)


def test_odd_rows(clashing, odd_rows, nothing):
    rows = lm.scores(clashing, spec=SPEC).collect()
    assert len(rows) == len(odd_rows)
    assert all((r.n_tokens == 0) == (r.mean_log_prob is None) and (r.n_tokens > 0 or r.log_prob == 0) for r in rows)
    same = [r.log_prob for r in rows if r.doc_id == 2]
    assert same[0] == same[1]
    assert lm.scores(nothing, spec=SPEC).count() == 0


def test_every_window_is_trained_on_with_the_values_of_the_query(spark, monkeypatch):
    spec = lm.WindowModel()
    texts = [b"one", b"one two", b"", None, b" ".join(b"w%d" % i for i in range(301)), b"a b c"]
    ids, places, owners = padded(texts, lm._Classes([], spec))
    taken = np.concatenate([lm._windows(places, owners, k, spec.stride) for k in range(spec.rounds)])
    assert set(taken) == set(places)
    assert len(lm._windows(places, owners, 0, spec.stride)) > 0
    offsets = []
    monkeypatch.setattr(lm, "_round", lambda encoded, model, spec, offset: offsets.append(offset) or model)
    lm.fit(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spec)
    assert {k % spec.stride for k in offsets} == set(range(spec.stride))
    with pytest.raises(ValueError):
        lm.WindowModel(rounds=1, stride=2)


@pytest.mark.parametrize("held", [16_384, 3, 0])
def test_words_of_a_class_have_their_own_probabilities(spark, monkeypatch, held):
    """Against sums by hand, with all, some and none of the counts in the tasks."""
    from collections import Counter

    monkeypatch.setattr(lm, "_FREQUENT_WORDS", held)
    spec = lm.WindowModel(words=2, hash_classes=2, width=4, rounds=1, stride=1)
    texts = ["a b a b a b rare rare rare seldom", "a b once Rare a b seldom", "b invented a", "b uncounted a", ""]
    docs = spark.createDataFrame(list(enumerate(texts[:2])), "doc_id long, text string")
    fitted = lm.fit(docs, spec)
    count = Counter(w for t in texts[:2] for w in t.lower().split())
    classes = lm._Classes(fitted[0], spec)
    assert sorted(fitted[0]) == [b"a", b"b"]
    got = {r.doc_id: r for r in lm.scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), fitted, spec).collect()}
    assert len(got) == 5 and got[4].log_prob == 0 and got[4].n_tokens == 0 and got[4].mean_log_prob is None
    for k, t in enumerate(texts):
        words = [w.encode() for w in t.lower().split()]
        ids, places, _ = padded([t.encode()], classes)
        want = lm._forward(fitted[1], ids, places)[1][np.arange(len(places)), ids[places]].astype(float).sum() if words else 0.0
        for w in words:
            if w not in fitted[0]:
                of = lambda v: classes.of(lm.word_hashes([v]))[0]
                others = [n for v, n in count.items() if v.encode() not in fitted[0] and of(v.encode()) == of(w)]
                want += np.log((count[w.decode()] + 1) / (sum(others) + len(others) + 1))
        assert got[k].log_prob == pytest.approx(want, abs=2e-3) and got[k].n_tokens == len(words)


def test_a_rare_word_for_another_changes_the_score(spark):
    spec = lm.WindowModel(words=2, hash_classes=1, width=4, rounds=1, stride=1)
    docs = spark.createDataFrame([(0, "a b a b a b rare rare rare seldom")], "doc_id long, text string")
    rows = [(1, "a rare b"), (2, "a seldom b"), (3, "a invented b")]
    got = {r.doc_id: r.log_prob for r in lm.scores(spark.createDataFrame(rows, docs.schema), lm.fit(docs, spec), spec).collect()}
    assert got[1] > got[2] > got[3]


def test_one_model_gives_the_same_scores_however_the_input_is_split(spark, documents):
    spec = lm.WindowModel(words=30, hash_classes=8, width=8)
    few = documents.where("doc_id < 120").select("doc_id", "text")
    fitted = lm.fit(few.repartition(2), spec)
    results = [{r.doc_id: r for r in lm.scores(few.repartition(k), fitted, spec).collect()} for k in (1, 4, 32)]
    for other in results[1:]:
        for k, r in results[0].items():
            assert other[k].n_tokens == r.n_tokens and other[k].log_prob == pytest.approx(r.log_prob, abs=1e-5 * r.n_tokens + 1e-4)


def test_models_of_other_splits_rank_alike(documents):
    """Copies trained on other partitions differ; their scores stay close and in nearly the same order."""
    spec = lm.WindowModel()
    few = documents.where("doc_id < 120").select("doc_id", "text")
    one, two = ({r.doc_id: r.mean_log_prob for r in lm.scores(few.repartition(k), spec=spec).collect()} for k in (1, 4))
    ids = [k for k in one if one[k] is not None]
    a, b = (np.array([x[k] for k in ids]) for x in (one, two))
    rank = lambda x: np.argsort(np.argsort(x))
    assert np.corrcoef(rank(a), rank(b))[0, 1] > 0.9 and np.median(np.abs(a - b) / np.abs(a)) < 0.15
