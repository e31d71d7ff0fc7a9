"""DuckDB SQL with the expected result of each registered query, straight on the tables."""

from __future__ import annotations

# ---- conformed tables --------------------------------------------------------------------------

_LINES = """
    SELECT l_orderkey, l_linenumber, l_linestatus, l_returnflag, l_suppkey,
           l_orderkey || '-' || l_linenumber AS credit_id,
           p_name, p_type, p_size, p_brand, CAST(split_part(p_brand, '#', 2) AS INT) AS brand,
           s_name, s_nationkey, s_acctbal, n_name
    FROM lineitem
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey
"""

# The later snapshot of a credit, where there is one.
_CHANGED = "CASE WHEN l_orderkey % 4 = 0 AND l_linenumber % 3 <> 0 THEN ' II' ELSE '' END"

SILVER = {
    "movie": """
    SELECT o_orderkey AS movie_id,
           'Order ' || o_orderkey AS title,
           CASE WHEN o_orderkey % 7 <> 0 THEN 'Order ' || o_orderkey END AS original_title,
           CAST(NULL AS VARCHAR) AS overview,
           CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS release_date,
           CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 200 AS INT) END AS runtime,
           o_orderstatus AS status,
           lower(c_mktsegment) AS original_language,
           (o_orderkey % 1000) / 10 AS popularity,
           (o_orderkey * 7 % 100) / 10 AS vote_average,
           CAST(o_orderkey * 13 % 2000 AS INT) AS vote_count,
           CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_orderkey * 37 % 500000 END AS budget,
           CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS revenue,
           o_orderkey % 5 = 0 AS adult,
           CAST(NULL AS VARCHAR) AS poster_path,
           CAST(NULL AS VARCHAR) AS backdrop_path,
           CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS loaded_at
    FROM orders JOIN customer ON c_custkey = o_custkey
    """,
    "person": """
    SELECT s_suppkey AS person_id,
           CASE WHEN s_suppkey % 4 = 0 THEN s_name || ' New' WHEN s_suppkey % 2 = 0 THEN s_name ELSE credit.name END AS name,
           CAST(s_suppkey % 3 AS INT) AS gender,
           CAST(NULL AS VARCHAR) AS known_for_department,
           CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal ELSE credit.popularity END AS popularity,
           CASE WHEN s_suppkey % 4 = 2 THEN DATE '1950-01-01' + CAST(s_suppkey % 20000 AS INT) END AS birthday,
           CAST(NULL AS DATE) AS deathday,
           CASE WHEN s_suppkey % 2 = 0 THEN n_name END AS place_of_birth,
           CAST(NULL AS VARCHAR) AS biography
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN (
        SELECT l_suppkey, CASE WHEN l_linenumber % 3 = 1 THEN s_name || ' ' || l_linenumber ELSE s_name END AS name,
               CASE l_linenumber % 3 WHEN 1 THEN s_acctbal + l_linenumber WHEN 2 THEN s_acctbal END AS popularity
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY popularity DESC NULLS LAST, name) = 1
    ) credit ON l_suppkey = s_suppkey
    WHERE s_suppkey % 2 = 0 OR l_suppkey IS NOT NULL
    """,
    "genre": f"""
    SELECT brand AS genre_id, max(p_brand) AS name FROM (
        SELECT brand, p_brand FROM ({_LINES})
        UNION ALL
        SELECT CAST(split_part(p_brand, '#', 2) AS INT) AS number, p_brand || CASE WHEN number % 5 = 1 THEN ' Z' ELSE '' END
        FROM part WHERE number % 5 <> 0
        UNION ALL
        SELECT DISTINCT 1000 + number // 10, 'Unused'
        FROM (SELECT CAST(split_part(p_brand, '#', 2) AS INT) AS number FROM part) WHERE number % 5 <> 0
    ) GROUP BY brand
    """,
    "company": f"""
    SELECT l_suppkey AS company_id, max(s_name || CASE WHEN l_orderkey % 3 = 0 THEN ' B' ELSE '' END) AS name,
           max(n_name) || ' B' AS origin_country
    FROM ({_LINES}) GROUP BY l_suppkey
    """,
    "country": f"""
    SELECT 'C' || s_nationkey AS iso_3166_1, max(n_name) AS name FROM ({_LINES}) GROUP BY s_nationkey
    """,
    "language": """
    SELECT 'R' || r_regionkey AS iso_639_1, max(r_name) AS english_name, max(r_name) AS name
    FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    GROUP BY r_regionkey
    """,
    "keyword": f"""
    SELECT CAST(p_size AS BIGINT) AS keyword_id, max(p_type) AS name FROM ({_LINES}) GROUP BY p_size
    """,
    "movie_genre": f"SELECT DISTINCT l_orderkey AS movie_id, brand AS genre_id FROM ({_LINES})",
    "movie_company": f"SELECT DISTINCT l_orderkey AS movie_id, l_suppkey AS company_id FROM ({_LINES})",
    "movie_country": f"SELECT DISTINCT l_orderkey AS movie_id, 'C' || s_nationkey AS iso_3166_1 FROM ({_LINES})",
    "movie_keyword": f"""
    SELECT DISTINCT l_orderkey AS movie_id, CAST(p_size AS BIGINT) AS keyword_id FROM ({_LINES})
    """,
    "credit_cast": f"""
    SELECT l_orderkey AS movie_id, l_suppkey AS person_id, credit_id, p_name || {_CHANGED} AS character,
           l_linenumber - 1 AS cast_order
    FROM ({_LINES}) WHERE l_linestatus = 'F'
    QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY l_suppkey, character) = 1
    """,
    "credit_crew": f"""
    SELECT l_orderkey AS movie_id, l_suppkey AS person_id, credit_id, p_type AS department,
           l_returnflag || {_CHANGED} AS job
    FROM ({_LINES}) WHERE l_linestatus = 'O'
    QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY l_suppkey, p_type, job) = 1
    """,
}


def _with(tables: dict[str, str], names: str, query: str) -> str:
    parts = ", ".join(f"{n} AS ({tables[n]})" for n in names.split())
    return f"WITH {parts} {query}"


def _on_silver(names: str, query: str) -> str:
    return _with(SILVER, names, query)


# ---- marts -------------------------------------------------------------------------------------

_ROI = "CASE WHEN budget > 0 THEN round((revenue - budget) / budget, 6) END AS roi"


def _calendar(bounds: str) -> str:
    return f"""
    SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
           CAST(day(d) AS INT) AS day, CAST(quarter(d) AS INT) AS quarter,
           strftime(d, '%Y-%m') AS year_month, rpad(dayname(d), 9, ' ') AS day_name
    FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM ({bounds}))
    """


GOLD = {
    "dim_movie": _on_silver(
        "movie",
        """SELECT movie_id, title, original_title, overview, release_date, runtime, status,
        original_language, adult, poster_path, backdrop_path FROM movie""",
    ),
    "dim_person": _on_silver(
        "person",
        """SELECT person_id, name, gender, known_for_department, popularity, birthday, deathday, place_of_birth
        FROM person""",
    ),
    "dim_genre": _on_silver("genre", "SELECT genre_id, name AS genre_name FROM genre"),
    "dim_company": _on_silver("company", "SELECT company_id, name AS company_name, origin_country FROM company"),
    "dim_keyword": _on_silver("keyword", "SELECT keyword_id, name AS keyword_name FROM keyword"),
    "dim_date": _on_silver(
        "movie",
        _calendar(
            "SELECT CAST(min(release_date) AS TIMESTAMP) AS lo, CAST(max(release_date) AS TIMESTAMP) AS hi FROM movie"
        ),
    ),
    "fact_movie": _on_silver(
        "movie",
        f"""SELECT movie_id, release_date AS date_day, budget, revenue, runtime, vote_count, popularity,
        vote_average, revenue - budget AS profit, {_ROI} FROM movie""",
    ),
    "fact_movie_cast": _on_silver(
        "credit_cast", "SELECT credit_id, movie_id, person_id, character, cast_order FROM credit_cast"
    ),
    "fact_movie_crew": _on_silver(
        "credit_crew", "SELECT credit_id, movie_id, person_id, department, job FROM credit_crew"
    ),
    "bridge_movie_genre": _on_silver("movie_genre", "SELECT movie_id, genre_id FROM movie_genre"),
    "bridge_movie_company": _on_silver("movie_company", "SELECT movie_id, company_id FROM movie_company"),
    "movie_analytics": _on_silver(
        "movie movie_genre genre credit_cast person movie_company company",
        f"""
        SELECT m.movie_id, title, original_title, release_date, original_language, status, runtime, budget,
               revenue, revenue - budget AS profit, {_ROI}, vote_average, vote_count, popularity,
               genre_list, top_3_cast, primary_company
        FROM movie m
        LEFT JOIN (SELECT movie_id, string_agg(name, ', ' ORDER BY name) AS genre_list
                   FROM movie_genre JOIN genre USING (genre_id) GROUP BY movie_id) g ON g.movie_id = m.movie_id
        LEFT JOIN (SELECT movie_id, string_agg(name, ', ' ORDER BY cast_order) AS top_3_cast
                   FROM credit_cast JOIN person USING (person_id) WHERE cast_order < 3
                   GROUP BY movie_id) c ON c.movie_id = m.movie_id
        LEFT JOIN (SELECT movie_id, arg_min(name, company_id) AS primary_company
                   FROM movie_company JOIN company USING (company_id) GROUP BY movie_id) p
               ON p.movie_id = m.movie_id
        """,
    ),
}

# ---- questions ---------------------------------------------------------------------------------

# vote_average has one decimal, so ten times it is an integer and the rounded mean stays exact.
_AVG_VOTE = """
    CAST((20 * sum(CAST(round(vote_average * 10) AS BIGINT)) + count(*)) // (2 * count(*)) AS BIGINT) / 100 AS avg_vote
"""


def _sum(name: str) -> str:
    return f"CAST(sum({name}) AS DOUBLE) AS total_{name}"


QUESTIONS = {
    "q1_top_rated": (
        "movie_analytics",
        """SELECT title, release_date, vote_average, vote_count, genre_list FROM movie_analytics
        WHERE vote_count >= 500 ORDER BY vote_average DESC NULLS FIRST, vote_count DESC NULLS FIRST, movie_id LIMIT 20
        """,
    ),
    "q2_money_by_year": (
        "movie_analytics",
        f"""SELECT CAST(year(release_date) AS INT) AS release_year, count(*) AS movies,
        {_sum("budget")}, {_sum("revenue")}, {_sum("profit")}
        FROM movie_analytics WHERE release_date IS NOT NULL GROUP BY 1""",
    ),
    "q3_genre_popularity": (
        "bridge_movie_genre dim_genre fact_movie",
        f"""SELECT genre_name, count(DISTINCT movie_id) AS movie_count, {_AVG_VOTE}, {_sum("revenue")}
        FROM bridge_movie_genre JOIN dim_genre USING (genre_id) JOIN fact_movie USING (movie_id)
        GROUP BY genre_name""",
    ),
    "q4_most_credited": (
        "fact_movie_cast dim_person",
        """SELECT name, count(*) AS cast_credits, count(DISTINCT movie_id) AS movies
        FROM fact_movie_cast JOIN dim_person USING (person_id)
        GROUP BY name ORDER BY cast_credits DESC, movies DESC, name LIMIT 25""",
    ),
    "q5_departments": (
        "fact_movie_crew",
        """SELECT department, count(*) AS credits, count(DISTINCT movie_id) AS movies,
        count(DISTINCT person_id) AS people FROM fact_movie_crew GROUP BY department""",
    ),
    "q6_top_companies": (
        "bridge_movie_company dim_company fact_movie",
        f"""SELECT company_name, count(DISTINCT movie_id) AS movies, {_sum("revenue")}, {_sum("budget")}
        FROM bridge_movie_company JOIN dim_company USING (company_id) JOIN fact_movie USING (movie_id)
        GROUP BY company_name ORDER BY sum(revenue) DESC NULLS LAST, company_name LIMIT 20""",
    ),
    "q7_worst_losses": (
        "movie_analytics",
        """SELECT title, release_date, budget, revenue, profit, roi, primary_company FROM movie_analytics
        WHERE profit < 0 AND budget > 0 ORDER BY profit, movie_id LIMIT 20""",
    ),
    "q8_language_mix": (
        "movie_analytics",
        f"""SELECT original_language, count(*) AS movies, {_AVG_VOTE}, {_sum("revenue")}
        FROM movie_analytics GROUP BY original_language""",
    ),
    "q9_top_roi": (
        "movie_analytics",
        """SELECT movie_id, title, budget, revenue, profit, roi FROM movie_analytics
        WHERE budget > 0 ORDER BY (revenue - budget) / budget DESC, movie_id LIMIT 20""",
    ),
    "q5_departments_approx": (
        "fact_movie_crew",
        "SELECT department, count(*) AS credits, true AS movies_close, true AS people_close FROM fact_movie_crew GROUP BY department",
    ),
}

# ---- checks ------------------------------------------------------------------------------------


def _check_rows(model: str, not_null: str, unique: str, parents: dict[str, str]) -> list[str]:
    """One SELECT per check: nulls, repeated keys, children without a parent."""
    row = f"SELECT '{model}' AS model, '{{}}' AS test, '{{}}' AS target, CAST(({{}}) AS BIGINT) AS failures"
    rows = [
        row.format("not_null", c, f"SELECT count(*) FROM {model} WHERE {c} IS NULL") for c in not_null.split()
    ]
    if unique:
        key, known = unique.split(), " AND ".join(f"{c} IS NOT NULL" for c in unique.split())
        repeated = f"SELECT 1 FROM {model} WHERE {known} GROUP BY {', '.join(key)} HAVING count(*) > 1"
        rows.append(row.format("unique", "-".join(key), f"SELECT count(*) FROM ({repeated})"))
    for child, parent in parents.items():
        table, column = parent.split(".")
        orphans = f"SELECT count(*) FROM {model} c WHERE c.{child} IS NOT NULL AND NOT EXISTS "
        rows.append(row.format("relationships", child, f"{orphans}(SELECT 1 FROM {table} p WHERE p.{column} = c.{child})"))
    return rows


def _checks(declared: list[tuple]) -> str:
    return " UNION ALL ".join(r for d in declared for r in _check_rows(*d))


_STAR_CHECKS = [
    ("orders", "o_orderkey o_custkey", "o_orderkey", {"o_custkey": "customer.c_custkey"}),
    (
        "lineitem",
        "l_orderkey l_linenumber",
        "l_orderkey l_linenumber",
        {"l_orderkey": "orders.o_orderkey", "l_partkey": "part.p_partkey", "l_suppkey": "supplier.s_suppkey"},
    ),
    ("customer", "c_custkey", "c_custkey", {"c_nationkey": "nation.n_nationkey"}),
    ("nation", "n_nationkey n_name", "n_nationkey", {"n_regionkey": "region.r_regionkey"}),
    ("labels", "doc_id", "doc_id", {"doc_id": "documents.doc_id"}),
]

_MOVIE = {"movie_id": "movie.movie_id"}
_SILVER_CHECKS = [
    ("genre", "genre_id name", "genre_id", {}),
    ("movie", "movie_id title", "movie_id", {}),
    ("movie_genre", "movie_id genre_id", "movie_id genre_id", {**_MOVIE, "genre_id": "genre.genre_id"}),
    ("company", "company_id name", "company_id", {}),
    ("movie_company", "movie_id company_id", "movie_id company_id", {**_MOVIE, "company_id": "company.company_id"}),
    ("country", "iso_3166_1", "iso_3166_1", {}),
    ("movie_country", "movie_id iso_3166_1", "movie_id iso_3166_1", {**_MOVIE, "iso_3166_1": "country.iso_3166_1"}),
    ("language", "iso_639_1", "iso_639_1", {}),
    ("person", "person_id name", "person_id", {}),
    ("credit_cast", "credit_id movie_id person_id", "credit_id", {**_MOVIE, "person_id": "person.person_id"}),
    ("credit_crew", "credit_id movie_id person_id", "credit_id", {**_MOVIE, "person_id": "person.person_id"}),
    ("keyword", "keyword_id name", "keyword_id", {}),
    ("movie_keyword", "movie_id keyword_id", "movie_id keyword_id", {**_MOVIE, "keyword_id": "keyword.keyword_id"}),
]

_DIM_MOVIE = {"movie_id": "dim_movie.movie_id"}
_DIM_PERSON = {"person_id": "dim_person.person_id"}
_GOLD_CHECKS = [
    ("dim_movie", "movie_id", "movie_id", {}),
    ("dim_person", "person_id", "person_id", {}),
    ("dim_genre", "genre_id", "genre_id", {}),
    ("dim_company", "company_id", "company_id", {}),
    ("dim_keyword", "keyword_id", "keyword_id", {}),
    ("dim_date", "date_day", "date_day", {}),
    ("fact_movie", "movie_id", "movie_id", {**_DIM_MOVIE, "date_day": "dim_date.date_day"}),
    ("fact_movie_cast", "credit_id movie_id person_id", "credit_id", {**_DIM_MOVIE, **_DIM_PERSON}),
    ("fact_movie_crew", "credit_id movie_id person_id", "credit_id", {**_DIM_MOVIE, **_DIM_PERSON}),
    (
        "bridge_movie_genre",
        "movie_id genre_id",
        "movie_id genre_id",
        {**_DIM_MOVIE, "genre_id": "dim_genre.genre_id"},
    ),
    (
        "bridge_movie_company",
        "movie_id company_id",
        "movie_id company_id",
        {**_DIM_MOVIE, "company_id": "dim_company.company_id"},
    ),
    ("movie_analytics", "movie_id title", "movie_id", _DIM_MOVIE),
]

# ---- landing and catalog -----------------------------------------------------------------------

_LANDED = """
WITH docs AS (
    SELECT doc_id, text,
           ['genre', 'movie_popular', 'movie_top_rated', 'movie', 'credits', 'keywords', 'person',
            'configuration'][CAST(doc_id % 8 + 1 AS INT)] AS resource,
           DATE '2024-01-01' + CAST(doc_id % 10 AS INT) AS ingest_date,
           array_to_string(list_transform(range(0, doc_id % 4 + 1), lambda i: '{"id":' || i || '}'), ',') AS items
    FROM documents
), kinds AS (
    SELECT *, 'document' AS kind, doc_id || '.json' AS filename,
           '{"id":' || CASE WHEN doc_id % 7 = 0 THEN 'null' ELSE CAST(doc_id AS VARCHAR) END
               || ',"page":' || doc_id % 50 || ',"title":' || CAST(to_json(text) AS VARCHAR)
               || ',"genres":[' || items || '],"results":[' || items || '],"cast":[' || items
               || '],"keywords":[' || items || '],"crew":[]}' AS payload
    FROM docs
    UNION ALL SELECT *, 'manifest', doc_id || '.manifest.json', '{}' FROM docs WHERE doc_id % 9 = 0
    UNION ALL SELECT *, 'list', doc_id || '-list.json', '[1,2]' FROM docs WHERE doc_id % 6 = 0
    UNION ALL SELECT *, 'no id', 'x' || doc_id || '.json', '{"id":null,"page":' || doc_id % 50 || '}'
              FROM docs WHERE doc_id % 5 = 0
), landed AS (
    SELECT *, 'manual__' || ingest_date || 'T00-00-00-00-00' AS run_id, '/' || resource || '/' || doc_id AS request_path,
           CAST([200, 404, NULL, 503][CAST(doc_id % 4 + 1 AS INT)] AS INT) AS http_status,
           kind = 'manifest' AS manifest, kind <> 'list' AS is_object, resource <> 'configuration' AS known,
           'tmdb/' || resource || '/ingest_date=' || ingest_date || '/run_id=manual__' || ingest_date
               || 'T00-00-00-00-00/' || filename AS key,
           CASE WHEN resource IN ('movie', 'credits', 'keywords', 'person')
                THEN CASE WHEN kind = 'document' THEN doc_id END
                WHEN resource IN ('movie_popular', 'movie_top_rated') THEN doc_id % 50 ELSE 0 END AS tmdb_id
    FROM kinds
)
"""

_COUNTS = """
    SELECT ingest_date, run_id, count(*) FILTER (NOT manifest) AS ingest_objects,
           count(*) FILTER (NOT manifest AND known AND is_object AND tmdb_id IS NOT NULL) AS raw_payloads,
           count(*) FILTER (manifest) AS skipped_manifests, count(*) AS listed
    FROM landed GROUP BY ingest_date, run_id
"""

_REGISTRY = """
    SELECT 'landing' AS bucket, key, resource, ingest_date, run_id AS dag_run_id,
           CAST(strlen(payload) AS BIGINT) AS bytes, sha256(payload) AS etag, TIMESTAMP '2024-02-01' AS loaded_at
    FROM landed WHERE NOT manifest
"""

_PAYLOADS = """
    SELECT resource, tmdb_id, payload, key AS source_key, TIMESTAMP '2024-02-01' AS extracted_at,
           run_id AS dag_run_id
    FROM landed WHERE NOT manifest AND known AND is_object AND tmdb_id IS NOT NULL
"""

_AUDIT = """
    SELECT request_path, http_status, TIMESTAMP '2024-02-01' AS extracted_at,
           CAST(CASE WHEN kind = 'document' AND resource IN ('genre', 'movie_popular', 'movie_top_rated', 'credits', 'keywords')
                     THEN doc_id % 4 + 1
                     WHEN kind = 'no id' AND resource IN ('genre', 'movie_popular', 'movie_top_rated', 'credits', 'keywords')
                     THEN 0 ELSE 1 END AS BIGINT) AS record_count,
           resource, key AS data_key, CAST(strlen(payload) AS BIGINT) AS bytes
    FROM landed WHERE NOT manifest
"""

_CATALOG_CHECKS = [
    ("ingest_objects", "bucket key resource ingest_date dag_run_id loaded_at", "bucket key", {}),
    (
        "raw_payloads",
        "resource tmdb_id payload source_key extracted_at dag_run_id",
        "resource tmdb_id source_key",
        {},
    ),
]

_EVENTS_LATEST = """
    SELECT user_id, ts, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


def _listing(status: str) -> str:
    return f"SELECT DISTINCT o_orderkey AS movie_id FROM orders WHERE o_orderstatus <> '{status}'"


_REJECT_FIELDS = {
    "movie": "id release_date runtime popularity vote_average vote_count budget revenue adult malformed",
    "person": "id gender popularity birthday deathday malformed",
}

_PLANTED = """
    WITH orders_p AS (
        SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey FROM orders
        UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 5 = 0
    ), customer_p AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 3 <> 0
    ), nation_p AS (SELECT n_nationkey, nullif(n_name, 'JAPAN') AS n_name FROM nation WHERE n_nationkey > 4)
    SELECT replace(model, '_p', '') AS model, * EXCLUDE (model) FROM (
"""

_PLANTED_CHECKS = [
    ("orders_p", "o_orderkey o_custkey", "o_orderkey", {"o_custkey": "customer_p.c_custkey"}),
    ("customer_p", "c_custkey", "c_custkey", {"c_nationkey": "nation_p.n_nationkey"}),
    ("nation_p", "n_nationkey n_name", "n_nationkey", {}),
]

_BAD_TEXTS = {
    "id": 29, "release_date": 3, "runtime": 5, "popularity": 7, "vote_average": 11, "vote_count": 13, "budget": 17,
    "revenue": 19, "adult": 23, "malformed": 31,
}

ORACLES: dict[str, str] = {
    "planted_dq_report": _PLANTED + _checks(_PLANTED_CHECKS) + ")",
    "gate_failures": _PLANTED + _checks(_PLANTED_CHECKS) + ") WHERE failures > 0",
    "planted_cast_rejects": " UNION ALL ".join(
        f"SELECT 'movie' AS resource, '{f}' AS field, count(*) AS rejected FROM orders WHERE o_orderkey % {n} = 0"
        for f, n in _BAD_TEXTS.items()
    ),
    "rebuilt_movie_analytics": GOLD["movie_analytics"],
    **{f"silver_{n}": sql for n, sql in SILVER.items()},
    **{f"variant_silver_{n}": sql for n, sql in SILVER.items()},
    "silver_movie_genre_current": f"""
        SELECT DISTINCT l_orderkey AS movie_id, brand AS genre_id FROM ({_LINES})
        WHERE l_orderkey % 3 <> 0 OR (brand + l_orderkey) % 4 <> 0
    """,
    "cast_rejects": " UNION ALL ".join(
        f"SELECT '{r}' AS resource, '{f}' AS field, CAST(0 AS BIGINT) AS rejected"
        for r, fields in _REJECT_FIELDS.items()
        for f in fields.split()
    ),
    **GOLD,
    **{n: _with(GOLD, tables, sql) for n, (tables, sql) in QUESTIONS.items()},
    "latest_event_per_user": _EVENTS_LATEST,
    "json_prop_stats": """
        SELECT event_type, count(*) AS events, CAST(sum(k) AS BIGINT) AS sum_k, min(k) AS min_k, max(k) AS max_k,
               count(DISTINCT k) AS distinct_k
        FROM (SELECT event_type, CAST(props->>'k' AS INT) AS k FROM events) GROUP BY event_type
    """,
    "conversation_transcript": """
        SELECT conv_id, string_agg(role || ': ' || text, ' | ' ORDER BY turn) AS transcript
        FROM conversations GROUP BY conv_id
    """,
    "event_types_per_user": """
        SELECT user_id, string_agg(event_type, ', ' ORDER BY event_type) AS event_types
        FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id
    """,
    "order_dates": _calendar(
        "SELECT date_trunc('day', min(o_orderdate)) AS lo, date_trunc('day', max(o_orderdate)) AS hi FROM orders"
    ),
    "payload_keywords": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS movie_key, count(DISTINCT (p_size, p_type)) AS entries,
               max(p_type) AS last_name
        FROM ({_LINES}) GROUP BY l_orderkey
    """,
    "upsert_events": """
        SELECT event_id, ts, user_id, event_type, CASE WHEN day(ts) >= 10 THEN value * 2 ELSE value END AS value
        FROM events
    """,
    "replace_events": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "incremental_equals_full": f"SELECT user_id, ts AS loaded_at, event_id FROM ({_EVENTS_LATEST})",
    "incremental_movie": SILVER["movie"],
    "reprocessed_movie": SILVER["movie"],
    "incremental_person": SILVER["person"],
    "catalog_registry": _LANDED + _REGISTRY,
    "stream_registry": _LANDED + _REGISTRY,
    "catalog_dq_report": _LANDED
    + f", ingest_objects AS ({_REGISTRY}), raw_payloads AS ({_PAYLOADS}) "
    + _checks(_CATALOG_CHECKS),
    "key_rejects": """
        SELECT CASE doc_id % 5
                   WHEN 1 THEN 'other/tmdb/movie/ingest_date=2024-01-01/run_id=r/' || doc_id || '.json'
                   WHEN 2 THEN 'tmdb/movie/ingest_date=2024-01-01/run=r/' || doc_id || '.json'
                   WHEN 3 THEN 'tmdb/movie/ingest_date=2024-01-01/run_id=r'
                   ELSE 'tmdb/movie/ingest_date=2024-01-01/run_id=r/' || doc_id || '.json' END AS key,
               doc_id % 5 IN (1, 2, 3) AS rejected
        FROM documents
    """,
    "json_sink": """
        SELECT key, payload, CAST(strlen(payload) AS BIGINT) AS bytes FROM (
            SELECT 'tmdb/person/ingest_date=2024-01-01/run_id=run-1/' || c_custkey || '.json' AS key,
                   '{"id":' || c_custkey || ',"name":"' || c_name || '","nation":'
                       || CASE WHEN c_nationkey > 4 THEN CAST(c_nationkey AS VARCHAR) ELSE 'null' END || '}' AS payload
            FROM customer)
    """,
    "raw_payload_ids": _LANDED
    + f"SELECT * EXCLUDE (payload), sha256(payload) AS payload_hash FROM ({_PAYLOADS})",
    "stream_catalog": _LANDED + f"SELECT * EXCLUDE (payload) FROM ({_PAYLOADS})",
    "quarantine": _LANDED
    + """
        SELECT key, resource, payload, CASE WHEN is_object THEN 'no natural id' ELSE 'not a JSON object' END AS reason
        FROM landed WHERE NOT manifest AND known AND (NOT is_object OR tmdb_id IS NULL)
    """,
    "record_counts": _LANDED + f"SELECT data_key, resource, record_count, bytes FROM ({_AUDIT})",
    "audit": _LANDED + _AUDIT,
    "landed_texts": _LANDED
    + """
        SELECT key, sha256(text) AS text_hash, CAST(length(text) AS INT) AS chars, CAST(strlen(text) AS INT) AS utf8_bytes
        FROM landed WHERE kind = 'document'
    """,
    "object_files": """
        SELECT 'person' AS resource, DATE '2024-01-01' + CAST(s_suppkey % 3 AS INT) AS ingest_date,
               'run-' || s_suppkey % 2 AS run_id, payload, CAST(strlen(payload) AS BIGINT) AS bytes, sha256(payload) AS etag
        FROM (SELECT s_suppkey, '{"id":' || s_suppkey || ',"name":"' || s_name || ' é"}' || chr(10) AS payload FROM supplier)
    """,
    "run_counts": _LANDED + _COUNTS,
    "run_manifests": _LANDED
    + f"""
        SELECT ingest_date, run_id, TIMESTAMP '2024-02-01' AS extracted_at, name, n FROM ({_COUNTS})
        UNPIVOT (n FOR name IN (ingest_objects, raw_payloads, skipped_manifests, listed))
    """,
    "observed_run_counts": _LANDED
    + "".join(
        f"""{union}SELECT '{run}' AS run, sum(ingest_objects)::BIGINT AS ingest_objects, sum(raw_payloads)::BIGINT AS raw_payloads,
                   sum(skipped_manifests)::BIGINT AS skipped_manifests, sum(listed)::BIGINT AS listed
            FROM ({_COUNTS}) WHERE {days}"""
        for union, run, days in (("", "even days", "day(ingest_date) % 2 = 0"), (" UNION ALL ", "all days", "true"))
    ),
    "object_registry": """
        SELECT 'person' AS resource, DATE '2024-01-01' + CAST(s_suppkey % 3 AS INT) AS ingest_date,
               'run-' || s_suppkey % 2 AS dag_run_id, CAST(strlen(payload) AS BIGINT) AS bytes, sha256(payload) AS etag,
               TIMESTAMP '2024-02-01' AS loaded_at, count(*) OVER () AS listed_1, CAST(0 AS BIGINT) AS listed_2
        FROM (SELECT s_suppkey, '{"id":' || s_suppkey || ',"name":"' || s_name || ' é"}' || chr(10) AS payload FROM supplier)
    """,
    "one_key_upsert": """
        SELECT count(*) AS events, CAST(1 AS BIGINT) AS changed, true AS grown, 128 AS parts, 1 AS rewritten FROM events
    """,
    "distinct_users_sketched": """
        SELECT event_type, count(DISTINCT user_id) AS users, true AS close, true AS same FROM events GROUP BY event_type
    """,
    "run_scan": _LANDED
    + """
        SELECT key, filename, CAST(strlen(payload) AS BIGINT) AS bytes
        FROM landed WHERE ingest_date = DATE '2024-01-04'
    """,
    "key_roundtrip": _LANDED
    + """
        SELECT key, resource, CAST(ingest_date AS VARCHAR) AS ingest_date, run_id, filename, manifest FROM landed
    """,
    "dq_report": _checks(_STAR_CHECKS),
    "silver_dq_report": _on_silver(" ".join(SILVER), _checks(_SILVER_CHECKS)),
    "gold_dq_report": _with(GOLD, " ".join(GOLD), _checks(_GOLD_CHECKS)),
    "orphan_keys": """
        SELECT doc_id AS key, count(*) AS n FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id
    """,
    "frontier_popular": _listing("O"),
    "frontier_top_rated": _listing("F"),
    "frontier_ids": "SELECT DISTINCT o_orderkey AS movie_id FROM orders",
    "frontier_first_pages": "SELECT DISTINCT o_orderkey AS movie_id FROM orders WHERE o_orderkey < 100",
    "frontier_people": "SELECT DISTINCT l_suppkey AS person_id FROM lineitem",
    "frontier_people_cap": "SELECT DISTINCT l_suppkey AS person_id FROM lineitem ORDER BY person_id LIMIT 200",
    "frontier_people_first": "SELECT DISTINCT l_suppkey AS person_id FROM lineitem ORDER BY person_id LIMIT 7",
    "page_names": f"""
        SELECT format('page_{{:03d}}', movie_id // 20 + 1) AS name, CAST(count(*) AS INT) AS results
        FROM ({_listing("O")}) GROUP BY 1
    """,
}
