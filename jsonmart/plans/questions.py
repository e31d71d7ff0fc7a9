"""The analytics questions, on the marts.

Descending sorts put nulls first unless a question says otherwise. Limits end in a unique column,
so that the rows at the cut are always the same. Sums of money are decimals, as a BIGINT sum can
overflow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import MIN_VOTES, TOP_PEOPLE, TOP_TITLES

col = F.col


def _total(name: str) -> Column:
    return F.sum(col(name).cast("decimal(28,0)"))


def _mean(name: str) -> Column:
    return F.round(F.avg(name), 2)


def _spread(joined: DataFrame, *columns: str) -> DataFrame:
    """Shuffle joined rows by the columns of a distinct count.

    Without it the count would reuse the distribution of the join by movie, and Spark splits a hot
    join key only if a shuffle follows the join.
    """
    return joined.repartition(*columns)


def top_rated(movie_analytics: DataFrame, min_votes: int = MIN_VOTES, n: int = TOP_TITLES) -> DataFrame:
    return (
        movie_analytics.where(col("vote_count") >= min_votes)
        .orderBy(col("vote_average").desc_nulls_first(), col("vote_count").desc_nulls_first(), "movie_id")
        .limit(n)
        .select("title", "release_date", "vote_average", "vote_count", "genre_list")
    )


def money_by_year(movie_analytics: DataFrame) -> DataFrame:
    return (
        movie_analytics.where(col("release_date").isNotNull())
        .groupBy(F.year("release_date").alias("release_year"))
        .agg(
            F.count(F.lit(1)).alias("movies"),
            _total("budget").alias("total_budget"),
            _total("revenue").alias("total_revenue"),
            _total("profit").alias("total_profit"),
        )
        .orderBy(col("release_year").asc_nulls_last())
    )


def genre_popularity(bridge_movie_genre: DataFrame, dim_genre: DataFrame, fact_movie: DataFrame) -> DataFrame:
    """Movies, mean vote and revenue per genre name."""
    facts = fact_movie.select("movie_id", "vote_average", "revenue")
    joined = bridge_movie_genre.join(dim_genre, "genre_id").join(facts, "movie_id").drop("genre_id")
    return (
        _spread(joined, "genre_name", "movie_id")
        .groupBy("genre_name")
        .agg(
            F.count_distinct("movie_id").alias("movie_count"),
            _mean("vote_average").alias("avg_vote"),
            _total("revenue").alias("total_revenue"),
        )
        .orderBy(col("movie_count").desc_nulls_first(), "genre_name")
    )


def most_credited(fact_movie_cast: DataFrame, dim_person: DataFrame, n: int = TOP_PEOPLE) -> DataFrame:
    """Grouped by name, so namesakes count as one."""
    return (
        fact_movie_cast.select("person_id", "movie_id")
        .join(dim_person.select("person_id", "name"), "person_id")
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("cast_credits"), F.count_distinct("movie_id").alias("movies"))
        .orderBy(col("cast_credits").desc_nulls_first(), col("movies").desc_nulls_first(), col("name").asc_nulls_last())
        .limit(n)
    )


def departments(fact_movie_crew: DataFrame, approximate: bool = False) -> DataFrame:
    """Crew departments; no department is a group of its own. ``approximate`` uses sketches."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        fact_movie_crew.groupBy("department")
        .agg(
            F.count(F.lit(1)).alias("credits"),
            distinct("movie_id").alias("movies"),
            distinct("person_id").alias("people"),
        )
        .orderBy(col("credits").desc_nulls_first(), col("department").asc_nulls_last())
    )


def top_companies(
    bridge_movie_company: DataFrame, dim_company: DataFrame, fact_movie: DataFrame, n: int = TOP_TITLES
) -> DataFrame:
    """Grouped by name: a movie of two same-named companies counts once, its money twice."""
    facts = fact_movie.select("movie_id", "revenue", "budget")
    names = dim_company.select("company_id", "company_name")
    joined = bridge_movie_company.join(names, "company_id").join(facts, "movie_id").drop("company_id")
    return (
        _spread(joined, "company_name", "movie_id")
        .groupBy("company_name")
        .agg(
            F.count_distinct("movie_id").alias("movies"),
            _total("revenue").alias("total_revenue"),
            _total("budget").alias("total_budget"),
        )
        .orderBy(col("total_revenue").desc_nulls_last(), col("company_name").asc_nulls_last())
        .limit(n)
    )


def worst_losses(movie_analytics: DataFrame, n: int = TOP_TITLES) -> DataFrame:
    return (
        movie_analytics.where((col("profit") < 0) & (col("budget") > 0))
        .orderBy(col("profit").asc_nulls_last(), "movie_id")
        .limit(n)
        .select("title", "release_date", "budget", "revenue", "profit", "roi", "primary_company")
    )


def language_mix(movie_analytics: DataFrame) -> DataFrame:
    return (
        movie_analytics.groupBy("original_language")
        .agg(
            F.count(F.lit(1)).alias("movies"),
            _mean("vote_average").alias("avg_vote"),
            _total("revenue").alias("total_revenue"),
        )
        .orderBy(col("movies").desc_nulls_first(), col("original_language").asc_nulls_last())
    )


def top_roi(movie_analytics: DataFrame, n: int = TOP_TITLES) -> DataFrame:
    return (
        movie_analytics.where(col("budget") > 0)
        .orderBy(col("roi").desc_nulls_last(), "movie_id")
        .limit(n)
        .select("movie_id", "title", "budget", "revenue", "profit", "roi")
    )


# Question -> (marts it reads, builder).
QUESTIONS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "q1_top_rated": (("movie_analytics",), top_rated),
    "q2_money_by_year": (("movie_analytics",), money_by_year),
    "q3_genre_popularity": (("bridge_movie_genre", "dim_genre", "fact_movie"), genre_popularity),
    "q4_most_credited": (("fact_movie_cast", "dim_person"), most_credited),
    "q5_departments": (("fact_movie_crew",), departments),
    "q6_top_companies": (("bridge_movie_company", "dim_company", "fact_movie"), top_companies),
    "q7_worst_losses": (("movie_analytics",), worst_losses),
    "q8_language_mix": (("movie_analytics",), language_mix),
    "q9_top_roi": (("movie_analytics",), top_roi),
}
