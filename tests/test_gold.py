"""Marts and questions on hand-made conformed tables."""

import datetime
from decimal import Decimal

from payloads import tuples

from jsonmart.operators.conform import ordered_list
from jsonmart.plans import gold, questions

MOVIE = (
    "movie_id BIGINT, title STRING, original_title STRING, overview STRING, release_date DATE, runtime INT, "
    "status STRING, original_language STRING, popularity DECIMAL(28,10), vote_average DECIMAL(28,10), "
    "vote_count INT, budget BIGINT, revenue BIGINT, adult BOOLEAN, poster_path STRING, backdrop_path STRING, "
    "loaded_at TIMESTAMP"
)


def movies(spark, *rows):
    """Rows of (id, release date, budget, revenue, vote average, vote count, language)."""
    data = [
        (i, f"t{i}", None, None, date, 1, None, lang, None, None if avg is None else Decimal(str(avg)), votes,
         budget, revenue, False, None, None, None)
        for i, date, budget, revenue, avg, votes, lang in rows
    ]
    return spark.createDataFrame(data, MOVIE)


def d(text):
    return datetime.date.fromisoformat(text)


def test_calendar_is_gapless(spark):
    df = movies(spark, (1, d("2023-12-30"), 0, 0, 0, 0, ""), (2, None, 0, 0, 0, 0, ""), (3, d("2024-03-01"), 0, 0, 0, 0, ""))
    days = gold.dim_date(df).orderBy("date_day").collect()
    assert len(days) == 63
    assert all((b.date_day - a.date_day).days == 1 for a, b in zip(days, days[1:], strict=False))
    assert days[2].asDict() == {
        "date_day": d("2024-01-01"), "year": 2024, "month": 1, "day": 1, "quarter": 1,
        "year_month": "2024-01", "day_name": "Monday   ",
    }


def test_calendar_without_dates(spark):
    df = movies(spark, (1, None, 0, 0, 0, 0, ""))
    assert tuples(gold.dim_date(df), "date_day") == [(d("1970-01-01"),)]
    assert tuples(gold.dim_date(df.limit(0)), "date_day") == [(d("1970-01-01"),)]


def test_profit_and_roi(spark):
    df = movies(spark, (1, None, 0, 10, 0, 0, ""), (2, None, 3, 1, 0, 0, ""), (3, None, 7, 0, 0, 0, ""))
    facts = gold.fact_movie(df)
    assert facts.schema["roi"].dataType.simpleString() == "decimal(38,18)"
    assert tuples(facts, "movie_id", "profit", "roi") == [
        (1, 10, None),
        (2, -2, Decimal("-0.666666666666666667")),
        (3, -7, Decimal("-1.000000000000000000")),
    ]


def analytics(spark):
    """Movie 1 has all lists, movie 2 only people without names, movie 3 nothing."""
    movie = movies(spark, *[(i, None, 1, 1, 0, 0, "") for i in (1, 2, 3)])
    genre = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "genre_id INT, name STRING")
    movie_genre = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 3), (1, 99)], "movie_id BIGINT, genre_id INT")
    cast = [
        (1, 10, "c1", 1), (1, 11, "c2", 0), (1, 12, "c3", 2), (1, 13, "c4", 7), (1, 99, "c5", 0),
        (1, 14, "c6", None), (1, 15, "c7", 1), (2, 16, "c8", 0),
    ]
    credit_cast = spark.createDataFrame(cast, "movie_id BIGINT, person_id BIGINT, credit_id STRING, cast_order INT")
    person = spark.createDataFrame(
        [(10, "P10"), (11, "P11"), (12, "P12"), (13, "P13"), (14, "P14"), (15, "P15"), (16, None)],
        "person_id BIGINT, name STRING",
    )
    company = spark.createDataFrame(
        [(5, "five", None), (6, "six", None), (7, None, None)], "company_id BIGINT, name STRING, origin_country STRING"
    )
    movie_company = spark.createDataFrame([(1, 6), (1, 5), (1, 1), (2, 7)], "movie_id BIGINT, company_id BIGINT")
    return gold.movie_analytics(movie, movie_genre, genre, credit_cast, person, movie_company, company)


def test_movie_analytics_lists(spark):
    rows = {r.movie_id: r for r in analytics(spark).collect()}
    assert rows[1].genre_list == "a, b"
    # Position 0 has one known person, position 1 two, position 2 one: four names.
    assert rows[1].top_3_cast.split(", ")[0] == "P11"
    assert sorted(rows[1].top_3_cast.split(", ")[1:3]) == ["P10", "P15"]
    assert rows[1].top_3_cast.split(", ")[3] == "P12"
    assert rows[1].primary_company == "five"
    assert (rows[2].genre_list, rows[2].top_3_cast, rows[2].primary_company) == (None, None, None)
    assert (rows[3].genre_list, rows[3].top_3_cast, rows[3].primary_company) == (None, None, None)


def test_ordered_list_in_parts_is_the_same(spark):
    rows = [(k, i, f"v{i}" if i % 5 else None) for k in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "k INT, i INT, v STRING").selectExpr("*", "i div 16 AS part")
    plain = ordered_list(df, "k", "v", ["i"], "all", sep="'")
    parts = ordered_list(df.repartition(5), "k", "v", ["i"], "all", sep="'", chunk=["part"])
    assert tuples(plain) == tuples(parts)
    assert plain.first()["all"] == "'".join(f"v{i}" for i in range(200) if i % 5)


def test_nulls_sort_first_in_descending_top(spark):
    df = movies(spark, (1, None, 1, 1, 9, 600, ""), (2, None, 1, 1, None, 600, ""), (3, None, 1, 1, 9, 499, ""))
    wide = df.selectExpr("*", "'x' AS genre_list")
    assert [r.title for r in questions.top_rated(wide).collect()] == ["t2", "t1"]


def test_money_by_year_and_big_sums(spark):
    big = 9_000_000_000_000_000_000
    df = movies(spark, (1, d("2020-05-01"), 1, big, 0, 0, ""), (2, d("2020-01-01"), 2, big, 0, 0, ""), (3, None, 1, 1, 0, 0, ""))
    wide = df.selectExpr("*", "CAST(0 AS BIGINT) AS profit")
    assert tuples(questions.money_by_year(wide)) == [(2020, 2, Decimal(3), Decimal(2 * big), Decimal(0))]


def test_namesakes(spark):
    cast = spark.createDataFrame(
        [("a", 1, 10), ("b", 1, 11), ("c", 2, 10), ("d", 2, 10)], "credit_id STRING, movie_id BIGINT, person_id BIGINT"
    )
    person = spark.createDataFrame([(10, "same"), (11, "same")], "person_id BIGINT, name STRING")
    assert tuples(questions.most_credited(cast, person)) == [("same", 4, 2)]

    bridge = spark.createDataFrame([(1, 1), (1, 2)], "movie_id BIGINT, company_id BIGINT")
    company = spark.createDataFrame([(1, "same"), (2, "same")], "company_id BIGINT, company_name STRING")
    facts = spark.createDataFrame([(1, 10, 3)], "movie_id BIGINT, revenue BIGINT, budget BIGINT")
    assert tuples(questions.top_companies(bridge, company, facts)) == [("same", 1, Decimal(20), Decimal(6))]


def test_null_groups(spark):
    crew = spark.createDataFrame(
        [(None, 1, 1), (None, 1, 2), ("Art", 1, 1)], "department STRING, movie_id BIGINT, person_id BIGINT"
    )
    assert [tuple(r) for r in questions.departments(crew).collect()] == [(None, 2, 1, 2), ("Art", 1, 1, 1)]
    assert [tuple(r) for r in questions.departments(crew, approximate=True).collect()] == [(None, 2, 1, 2), ("Art", 1, 1, 1)]
    df = movies(spark, (1, None, 1, 1, 1.25, 0, None), (2, None, 1, 1, 1.26, 0, None), (3, None, 1, 1, None, 0, "en"))
    mix = [tuple(r) for r in questions.language_mix(df).collect()]
    assert mix == [(None, 2, Decimal("1.26"), Decimal(2)), ("en", 1, None, Decimal(1))]


def test_losses_and_roi(spark):
    df = movies(spark, (1, None, 10, 1, 0, 0, ""), (2, None, 0, 0, 0, 0, ""), (3, None, 5, 9, 0, 0, ""), (4, None, 20, 1, 0, 0, ""))
    wide = gold.fact_movie(df).join(df.select("movie_id", "title", "release_date"), "movie_id").selectExpr("*", "'' AS primary_company")
    assert [r.title for r in questions.worst_losses(wide).collect()] == ["t4", "t1"]
    assert [r.movie_id for r in questions.top_roi(wide).collect()] == [3, 1, 4]
