"""The operators that SQL can express, for DuckDB."""

from __future__ import annotations

from . import quality_rules as rules
from . import sharding as shards
from .mixing import LEVELS, Mix


def sharding(n: int = shards.SHARDS, slots: int = shards.SLOTS) -> str:
    """Hash and placement; the filled table itself is text from the same rule, which has a test of its own."""
    owners = " ".join(map(str, shards.lookup_table([f"shard-{k}" for k in range(n)], slots)))
    return f"""
        WITH keyed AS (
            SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {slots} AS slot
            FROM documents),
        owners AS (SELECT unnest(string_split('{owners}', ' '))::INTEGER AS shard,
                          unnest(range({slots})) AS slot)
        SELECT doc_id, slot, shard FROM keyed JOIN owners USING (slot)
    """


def _distance(counts: str, total: str, shares: str) -> str:
    part = (
        "(CASE WHEN x[1] > 0 THEN x[1] / {t} * log2(x[1] / {t} / ((x[1] / {t} + x[2]) / 2)) ELSE 0 END"
        " + CASE WHEN x[2] > 0 THEN x[2] * log2(x[2] / ((x[1] / {t} + x[2]) / 2)) ELSE 0 END)"
    ).format(t=f"{total}::DOUBLE")
    pairs = f"list_transform(range(1, len({shares}) + 1), lambda i: [({counts})[i]::DOUBLE, ({shares})[i]::DOUBLE])"
    return (
        f"CASE WHEN {total} > 0 AND {shares} IS NOT NULL THEN sqrt(greatest(0, list_sum(list_transform({pairs}, lambda x: {part})) / 2)) END"
    )


def quality_rules(spec: rules.QualityRules = rules.QualityRules()) -> str:  # noqa: B008
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    listed = lambda values: "[" + ", ".join(map(repr, values)) + "]"
    common = " ".join(f"WHEN '{lang}' THEN {quoted(w)}" for lang, w in spec.common_words.items())
    shares = " ".join(
        f"WHEN '{lang}' THEN {listed([*w.values(), 1 - sum(w.values())])}" for lang, w in spec.common_words.items()
    )
    space = r"[\x20\x09-\x0D]"
    return rf"""
        WITH worded AS (
            SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        windows AS (
            SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS w
            FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM worded)),
        doubled AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
        covered AS (
            SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM doubled) GROUP BY r),
        counted AS (
            SELECT worded.*, len(words)::BIGINT AS n_words,
                   length(array_to_string(words, '')) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
                   coalesce(covered.n, 0) AS n_repeat_words,
                   length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS upper,
                   length(regexp_replace(text, '[^\p{{L}}\p{{M}}]+', '', 'g')) AS letters,
                   length(regexp_replace(text, '[^0-9]+', '', 'g')) AS digits,
                   length(regexp_replace(text, '{space}+', '', 'g')) AS solid,
                   length(regexp_replace(text, '[^.,;:!?''"()-]+', '', 'g')) AS points,
                   list_transform(words, lambda x: regexp_replace(lower(x), '[.,;:!?]+$', '')) AS plain,
                   CASE lang {common} END AS common,
                   CASE lang {shares} END AS shares
            FROM worded LEFT JOIN covered USING (r)),
        classed AS (
            SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   n_words < {spec.min_words} OR 100 * n_repeat_words > {spec.max_repeat_percent} * n_words AS base_failed,
                   [upper, letters - upper, digits, length(text) - solid, points, n_symbols,
                    length(text) - letters - digits - (length(text) - solid) - points - n_symbols] AS chars,
                   CASE WHEN upper > 0 OR common IS NOT NULL THEN {listed(spec.char_shares)}
                        ELSE {listed(rules.without_capitals(spec.char_shares))} END AS char_shares,
                   list_transform(common, lambda k: len(list_filter(plain, lambda x: x = k))) AS hits
            FROM counted),
        measured AS (
            SELECT *, {_distance("chars", "length(text)", "char_shares")} AS char_distance,
                   {_distance("list_append(hits, n_words - list_sum(hits)::BIGINT)", "n_words", "shares")} AS word_distance
            FROM classed)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND coalesce(
                   (char_distance + coalesce(word_distance, char_distance)) / 2
                   <= {spec.distance} + {spec.noise} / sqrt(greatest(n_words, 1)), false) AS kept
        FROM measured
    """


def mixing(mix: Mix) -> str:
    def weight(depth: int) -> str:
        path = " || '/' || ".join(LEVELS[:depth])
        cases = [f"WHEN '{'/'.join(p)}' THEN {w}" for p, w in mix.weights.items() if len(p) == depth]
        return f"(CASE {path} {' '.join(cases)} ELSE {mix.default_weight} END)" if cases else str(mix.default_weight)

    open_ = " AND ".join(f"{weight(d)} > 0" for d in range(1, len(LEVELS) + 1))
    budget = mix.budget_tokens if mix.budget_tokens is not None else f"floor(sum(n_tokens) * {mix.budget_percent} / 100)"
    sql = f"""
        WITH narrow AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, md5(coalesce(text, '')) AS text_key,
                   CASE WHEN source = 'src0' THEN 'crawl'
                        WHEN regexp_full_match(source, 'src[1-9]') THEN 'books' ELSE 'forums' END AS domain,
                   coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
            FROM documents),
        leaves AS (
            SELECT domain, lang, source, sum(n_tokens)::BIGINT AS n_tokens,
                   CASE WHEN {open_} THEN sum(n_tokens)::BIGINT * {mix.max_epochs} ELSE 0 END AS capacity
            FROM narrow GROUP BY {", ".join(LEVELS)}),
        given0 AS (SELECT least({budget}::BIGINT, sum(capacity))::BIGINT AS given FROM leaves)"""
    for depth in range(1, len(LEVELS) + 1):
        levels, parent = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[: depth - 1])
        join = f"JOIN given{depth - 1} USING ({parent})" if parent else "CROSS JOIN given0"
        window = f"{'PARTITION BY ' + parent if parent else ''} ORDER BY capacity / weight, {levels}"
        sql += f""",
        nodes{depth} AS (
            SELECT * FROM (SELECT {levels}, sum(capacity)::BIGINT AS capacity, greatest({weight(depth)}, 1) AS weight
                           FROM leaves GROUP BY {levels}) {join}),
        levels{depth} AS (
            SELECT *, (given - coalesce(sum(capacity) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                   / sum(weight) OVER ({window} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
            FROM nodes{depth}),
        fixed{depth} AS (
            SELECT *, first(CASE WHEN capacity > level * weight THEN level END IGNORE NULLS) OVER (
                       {window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fixed FROM levels{depth}),
        given{depth} AS (
            SELECT {levels}, CASE WHEN fixed IS NULL THEN capacity ELSE least(capacity, floor(fixed * weight)) END::BIGINT AS given
            FROM fixed{depth})"""
    return sql + f""",
        quotas AS (
            SELECT leaves.*, given AS quota, CASE WHEN n_tokens > 0 THEN given // n_tokens ELSE 0 END AS whole
            FROM leaves JOIN given{len(LEVELS)} USING ({", ".join(LEVELS)})),
        ordered AS (
            SELECT narrow.*, whole, quota - whole * quotas.n_tokens AS rest,
                   sum(narrow.n_tokens) OVER (PARTITION BY {", ".join(LEVELS)}
                       ORDER BY md5('{mix.seed}|' || (whole + 1)::VARCHAR || '|' || id || '|' || text_key)) AS through
            FROM narrow JOIN quotas USING ({", ".join(LEVELS)}))
        SELECT id::BIGINT AS doc_id, domain, lang, source, n_tokens,
               (whole + CASE WHEN rest > 0 AND through <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
        FROM ordered WHERE whole + CASE WHEN rest > 0 AND through <= rest THEN 1 ELSE 0 END > 0
    """
