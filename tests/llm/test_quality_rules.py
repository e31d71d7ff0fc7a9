import random
import unicodedata

import pytest
from brute import js_distance, quality_counts, words

from jsonmart.llm import quality_rules as q
from llm_fixtures import *  # noqa: F403


def expected(row, rules=q.QualityRules()):
    counts = quality_counts(row["text"])
    text = row["text"] or ""
    chars = [0] * 7
    for c in text:
        kind = (
            0 if unicodedata.category(c) == "Lu" else 1 if unicodedata.category(c)[0] in "LM" else 2 if c in "0123456789" else 3 if c in " \t\n\v\f\r"
            else 4 if c in ".,;:!?'\"()-" else 5 if c in "#*$%&|<>" else 6
        )
        chars[kind] += 1
    shares = rules.common_words.get(row["lang"])
    usual = list(rules.char_shares)
    if not shares and not chars[0]:
        usual[:2] = [0.0, usual[0] + usual[1]]
    first = js_distance(chars, usual)
    second = first
    if shares and counts["n_words"]:
        plain = [w.lower().rstrip(".,;:!?") for w in words(text)]
        hits = [plain.count(k) for k in shares]
        second = js_distance([*hits, len(plain) - sum(hits)], [*shares.values(), 1 - sum(shares.values())])
    good = first is not None and (first + second) / 2 <= rules.distance + rules.noise / max(1, counts["n_words"]) ** 0.5
    return counts | {"kept": not counts["base_failed"] and good}


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_counts_and_verdicts(request, table):
    rows = q.with_rules(request.getfixturevalue(table)).collect()
    assert rows
    for row in rows:
        want = expected(row)
        assert {k: row[k] for k in want} == want, row["doc_id"]


def test_labelled_good_documents_stay(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = q.with_rules(documents).join(labels, "doc_id").where("NOT base_failed")
    assert judged.where("quality = 1 AND NOT kept").count() <= 0.01 * judged.where("quality = 1").count()


def test_repeated_windows_across_long_runs(spark):
    text = "a b c d a b c x a b c " + "z " * 40
    row = q.with_rules(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).first()
    assert row.n_repeat_words == quality_counts(text)["n_repeat_words"]


def test_other_columns_stay(clashing, odd_rows):
    kept = q.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(expected({"text": t, "lang": lang})["kept"] for _, t, lang, _, _ in odd_rows)


def test_empty_table(nothing):
    assert q.with_rules(nothing).count() == 0 == q.keep_good(nothing).count()


def test_no_python_in_the_plan(documents):
    plan = q.with_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


LISTS = {
    "it": "il di che la e un per non sono con una nella questa Quando anche casa giorno acqua Stato tempo".split(),
    "hi": "और के में है की यह से को पर नहीं था हम भारत दिन पानी समय लोग बहुत किया गया".split(),
    "ru": "и в не на я быть он с что а по это она этот к но они мы весь Который".split(),
}


def mixed(rnd, words_, junk, n=150):
    return " ".join("12345" if rnd.random() < junk else rnd.choice(words_) for _ in range(n)) + "."


def test_languages_without_a_reference(spark):
    """Shares of digits around the limit; the character classes alone decide."""
    rnd = random.Random(2)
    rows = [
        (k, mixed(rnd, LISTS[lang], junk / 100), lang if k % 3 else None)
        for k, (lang, junk) in enumerate((lang, junk) for lang in LISTS for junk in range(0, 40, 2))
    ]
    got = {r.doc_id: r for r in q.with_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for doc_id, text, lang in rows:
        r = got[doc_id]
        assert r.word_distance is None
        assert r.kept == expected({"text": text, "lang": lang})["kept"], (doc_id, lang, r.char_distance)
    clean, spoiled = ([got[k].kept for k, *_ in rows if (k % 20) in part] for part in ((0,), (16, 17, 18, 19)))
    assert all(clean) and not any(spoiled)


def test_sql_agrees_on_other_languages(spark):
    import duckdb

    from jsonmart.llm import oracles

    rnd = random.Random(3)
    rows = [(k, mixed(rnd, LISTS[lang], k % 20 / 50), [lang, None, "en"][k % 3]) for k, lang in enumerate([*LISTS] * 25)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    want = con.execute(f"SELECT {', '.join(names)} FROM ({oracles.quality_rules()})").fetchall()
    got = q.with_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert {r[-1] for r in want} == {True, False}
