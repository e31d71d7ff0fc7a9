"""Rule-based quality filter: counts of the text and its divergence from language references.

A document is compared with what text of its language looks like, twice: shares of character
classes, and shares of the language's most common words. Both distances are Jensen-Shannon
distances (square root of the divergence, base 2), so they lie in [0, 1] and need no smoothing.
Only JVM expressions are used; each document is judged alone, in one narrow pass without a shuffle.

Defined cases. Null or empty text: all counts 0, ``base_failed``. A language without a reference, or null: only the
character classes are compared; without any capital, as in scripts that have none, the reference's capitals count as
letters. Marks (vowel signs, accents of their own) are letters. Repeated rows and equal ids: each row is judged on its own. Very long
texts are taken whole. Other columns are passed through; on a clash the new column gets a longer name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, split_words

#: The character classes, in order; letters without upper ones, and last any other character.
CHAR_CLASSES = ("upper", "letter", "digit", "space", "punctuation", "symbol", "other")
#: Their usual shares in running text of the four languages.
CHAR_SHARES = (0.03, 0.765, 0.005, 0.165, 0.03, 0.0025, 0.0025)

#: Usual shares of the twelve most common words of each language.
COMMON_WORDS = {
    "en": {"the": 0.062, "of": 0.032, "and": 0.028, "to": 0.026, "a": 0.022, "in": 0.021, "is": 0.011, "that": 0.011,
           "it": 0.010, "for": 0.010, "was": 0.009, "on": 0.008},
    "de": {"der": 0.035, "die": 0.033, "und": 0.029, "in": 0.018, "den": 0.014, "von": 0.011, "zu": 0.011, "das": 0.011,
           "mit": 0.010, "des": 0.009, "auf": 0.009, "sich": 0.008},
    "fr": {"de": 0.052, "la": 0.032, "le": 0.026, "et": 0.022, "les": 0.020, "des": 0.018, "en": 0.014, "du": 0.013,
           "un": 0.012, "une": 0.011, "que": 0.010, "pour": 0.008},
    "es": {"de": 0.058, "la": 0.040, "que": 0.030, "el": 0.030, "en": 0.027, "y": 0.026, "los": 0.017, "del": 0.013,
           "se": 0.012, "las": 0.011, "un": 0.010, "por": 0.010},
}

#: What to delete so that only digits, punctuation or symbols stay.
NO_DIGITS, NO_PUNCTUATION, NO_SYMBOLS = "[^0-9]+", """[^.,;:!?'"()-]+""", "[^#*$%&|<>]+"


@dataclass(frozen=True)
class QualityRules:
    """``limit(n) = distance + noise / sqrt(n)``: short texts scatter more, so they get more room."""

    min_words: int = 50
    max_repeat_percent: int = 50
    distance: float = 0.14
    noise: float = 0.9
    char_shares: tuple[float, ...] = CHAR_SHARES
    common_words: dict[str, dict[str, float]] = field(default_factory=lambda: COMMON_WORDS)


def with_rules(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:  # noqa: B008
    """``docs`` (text, lang) with counts, both distances, ``base_failed`` and ``kept``."""
    out = {name: free_name(docs, name) for name in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance",
        "base_failed", "kept")}
    tmp = {name: free_name(docs, f"__{name}") for name in (
        "text", "length", "words", "keys", "groups", "places", "rest", "chars", "found", "hits", "lines")}
    col = F.col
    # every intermediate array is a column of its own: inside a lambda it would be computed for each element
    text, words, rest, chars, found, lines = (col(tmp[x]) for x in ("text", "words", "rest", "chars", "found", "lines"))
    n = col(out["n_words"])

    df = docs.withColumn(tmp["text"], F.coalesce(col("text"), F.lit("")))
    df = df.withColumn(tmp["words"], split_words(text))
    df = df.withColumn(out["n_words"], F.size(words).cast("long"))
    df = _with_repeat_words(df, out["n_repeat_words"], words, n, tmp)

    length = col(tmp["length"])
    df = df.withColumn(tmp["length"], F.length(text).cast("long"))
    df = df.withColumn(out["word_chars"], F.length(F.array_join(words, "")).cast("long"))
    df = df.withColumn(tmp["rest"], F.regexp_replace(text, r"[\p{L}\p{M}]+", ""))
    df = df.withColumn(out["n_symbols"], F.length(F.regexp_replace(rest, NO_SYMBOLS, "")).cast("long"))
    upper = F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long")
    df = df.withColumn(
        tmp["chars"],
        F.array(
            upper,
            length - F.length(rest) - upper,
            F.length(F.regexp_replace(rest, NO_DIGITS, "")).cast("long"),
            length - col(out["word_chars"]),
            F.length(F.regexp_replace(rest, NO_PUNCTUATION, "")).cast("long"),
            col(out["n_symbols"]),
        ),
    )
    df = df.withColumn(tmp["chars"], F.concat(chars, F.array(length - _sum(chars))))
    df = df.withColumn(tmp["lines"], F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn(out["n_dup_lines"], (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
    df = df.withColumn(
        out["base_failed"], (n < rules.min_words) | (100 * col(out["n_repeat_words"]) > rules.max_repeat_percent * n)
    )

    known = F.coalesce(col("lang").isin(*rules.common_words), F.lit(False))
    char_shares = F.when(known | (F.get(chars, F.lit(0)) > 0), _doubles(rules.char_shares))
    char_shares = char_shares.otherwise(_doubles(without_capitals(rules.char_shares)))
    df = df.withColumn(out["char_distance"], _js_distance(chars, length, char_shares))
    df = df.withColumn(tmp["found"], _by_language(col("lang"), rules, lambda shares: _occurrences(text, shares)))
    count = lambda w: (F.size(found) - F.size(F.array_remove(found, w))).cast("long")
    df = df.withColumn(
        tmp["hits"],
        _by_language(col("lang"), rules, lambda shares: F.transform(F.array(*[F.lit(w) for w in shares]), count)),
    )
    df = df.withColumn(tmp["hits"], F.concat(col(tmp["hits"]), F.array(n - F.size(found))))
    shares = _by_language(col("lang"), rules, lambda w: _doubles([*w.values(), 1 - sum(w.values())]))
    df = df.withColumn(out["word_distance"], _js_distance(col(tmp["hits"]), n, shares))

    score = (col(out["char_distance"]) + F.coalesce(col(out["word_distance"]), col(out["char_distance"]))) / 2
    limit = rules.distance + rules.noise / F.sqrt(F.greatest(n, F.lit(1)).cast("double"))
    df = df.withColumn(out["kept"], ~col(out["base_failed"]) & F.coalesce(score <= limit, F.lit(False)))
    # Always true, but not known to be: a filter on these columns stays above them, where it reads values. Pushed
    # below, it would hold the whole computation once for every mention of a column.
    here = F.monotonically_increasing_id() >= 0
    return df.select(*[f"`{c}`" for c in docs.columns], *[F.when(here, col(c)).alias(c) for c in out.values()])


def _with_repeat_words(df: DataFrame, name: str, words: Column, n: Column, tmp: dict[str, str]) -> DataFrame:
    """Column ``name``: words covered by 3-word windows that occur twice or more in the document.

    Each window becomes one long: its hash, coarsened to a multiple of the word count, plus its place.
    A sort of these longs makes equal windows neighbours; neighbours count only if their words agree.
    """
    keys, groups, places = F.col(tmp["keys"]), F.col(tmp["groups"]), F.col(tmp["places"])
    base = F.greatest(n, F.lit(1).cast("long"))

    def window_key(word: Column, place: Column) -> Column:
        hashed = F.xxhash64(word, F.get(words, place + 1), F.get(words, place + 2))
        return F.coalesce(F.call_function("div", hashed, base * 2) * base + place, F.lit(0).cast("long"))

    def same(i: Column, j: Column) -> Column:
        a, b = F.pmod(F.get(keys, i), base).cast("int"), F.pmod(F.get(keys, j), base).cast("int")
        return (
            (F.get(groups, i) == F.get(groups, j))
            & (F.get(words, a) == F.get(words, b))
            & (F.get(words, a + 1) == F.get(words, b + 1))
            & (F.get(words, a + 2) == F.get(words, b + 2))
        )

    none = F.array().cast("array<bigint>")
    windows = F.slice(F.transform(words, window_key), F.lit(1), F.greatest(n - 2, F.lit(0)).cast("int"))
    df = df.withColumn(tmp["keys"], F.when(n >= 3, F.sort_array(windows)).otherwise(none))
    df = df.withColumn(tmp["groups"], F.transform(keys, lambda k: k - F.pmod(k, base)))
    repeated = F.filter(keys, lambda _, i: F.coalesce(same(i, i + 1), F.lit(False)) | F.coalesce(same(i, i - 1), F.lit(False)))
    df = df.withColumn(tmp["places"], F.sort_array(F.transform(repeated, lambda k: F.pmod(k, base))))
    steps = F.transform(places, lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
    return df.withColumn(name, _sum(steps))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _by_language(lang: Column, rules: QualityRules, make) -> Column:
    """``make(words)`` of the row's language, null for any other."""
    cases = [F.when(lang == name, make(words)) for name, words in rules.common_words.items()]
    return F.coalesce(*cases) if cases else F.lit(None)


def _occurrences(text: Column, shares: dict[str, float]) -> Column:
    """array<string>: each occurrence of the listed words, in any case; trailing .,;:!? do not belong to a word."""
    names = "|".join(sorted(shares, key=len, reverse=True))
    pattern = rf"[\x20\x09-\x0D]({names})(?=[.,;:!?]*(?:[\x20\x09-\x0D]|\z))"
    return F.regexp_extract_all(F.concat(F.lit(" "), F.lower(text)), F.lit(pattern), F.lit(1))


def without_capitals(shares) -> tuple[float, ...]:
    """Shares of the character classes with the capitals among the letters."""
    return (0.0, shares[0] + shares[1], *shares[2:])


def _js_distance(counts: Column, total: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of ``counts`` from ``shares``; null without any count or reference."""

    def part(count: Column, q: Column) -> Column:
        p = count / total
        m = (p + q) / 2
        left = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
        return left + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    divergence = F.aggregate(F.zip_with(counts, shares, part), F.lit(0.0), lambda a, x: a + x) / 2
    # greatest() passes over nulls, so the bound against rounding below 0 must be null itself without a reference
    return F.when(total > 0, F.sqrt(F.greatest(divergence, F.when(shares.isNotNull(), 0.0))))


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    judged = with_rules(docs, rules)
    kept = free_name(docs, "kept")
    return judged.where(F.col(kept)).select(*docs.columns)
