"""Star schema and the wide mart, from conformed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import profit, roi
from ..functions.values import TOP_CAST_POSITIONS
from ..operators.conform import ordered_list
from ..operators.dates import date_dim

col = F.col

# People at one cast position are gathered in parts by so many first characters of their credit ids.
_PART_CHARACTERS = 4


def dim_movie(movie: DataFrame) -> DataFrame:
    return movie.select(
        "movie_id", "title", "original_title", "overview", "release_date", "runtime", "status",
        "original_language", "adult", "poster_path", "backdrop_path",
    )


def dim_person(person: DataFrame) -> DataFrame:
    return person.drop("biography")


def dim_genre(genre: DataFrame) -> DataFrame:
    return genre.select("genre_id", col("name").alias("genre_name"))


def dim_company(company: DataFrame) -> DataFrame:
    return company.select("company_id", col("name").alias("company_name"), "origin_country")


def dim_keyword(keyword: DataFrame) -> DataFrame:
    return keyword.select("keyword_id", col("name").alias("keyword_name"))


def dim_date(movie: DataFrame) -> DataFrame:
    return date_dim(movie, "release_date")


def fact_movie(movie: DataFrame) -> DataFrame:
    return movie.select(
        "movie_id",
        col("release_date").alias("date_day"),
        "budget",
        "revenue",
        "runtime",
        "vote_count",
        "popularity",
        "vote_average",
        profit(col("revenue"), col("budget")).alias("profit"),
        roi(col("revenue"), col("budget")).alias("roi"),
    )


def fact_movie_cast(credit_cast: DataFrame) -> DataFrame:
    return credit_cast.select("credit_id", "movie_id", "person_id", "character", "cast_order")


def fact_movie_crew(credit_crew: DataFrame) -> DataFrame:
    return credit_crew.select("credit_id", "movie_id", "person_id", "department", "job")


def bridge_movie_genre(movie_genre: DataFrame) -> DataFrame:
    return movie_genre.select("movie_id", "genre_id")


def bridge_movie_company(movie_company: DataFrame) -> DataFrame:
    return movie_company.select("movie_id", "company_id")


def genre_lists(movie_genre: DataFrame, genre: DataFrame) -> DataFrame:
    """Genre names per movie, alphabetical. Pairs are distinct, so a list is at most the dimension."""
    named = movie_genre.join(genre, "genre_id")
    return ordered_list(named, "movie_id", "name", ["name"], "genre_list")


def top_cast(credit_cast: DataFrame, person: DataFrame) -> DataFrame:
    """Names at the first cast positions, by position. Positions may repeat or be missing.

    The order is position, then credit id. The list is gathered in parts along that order, so that a
    position shared by very many people does not meet in one task.
    """
    first = credit_cast.where(col("cast_order") < TOP_CAST_POSITIONS).select(
        "movie_id",
        "person_id",
        "cast_order",
        F.substring("credit_id", 1, _PART_CHARACTERS).alias("part"),
        "credit_id",
    )
    named = first.join(person.select("person_id", "name"), "person_id")
    return ordered_list(
        named,
        "movie_id",
        "name",
        ["cast_order", "part", "credit_id"],
        "top_3_cast",
        chunk=["cast_order", "part"],
    )


def primary_company(movie_company: DataFrame, company: DataFrame) -> DataFrame:
    """Name of the lowest company id per movie."""
    named = movie_company.join(company.select("company_id", "name"), "company_id")
    return named.groupBy("movie_id").agg(F.min_by("name", "company_id").alias("primary_company"))


def movie_analytics(
    movie: DataFrame,
    movie_genre: DataFrame,
    genre: DataFrame,
    credit_cast: DataFrame,
    person: DataFrame,
    movie_company: DataFrame,
    company: DataFrame,
) -> DataFrame:
    """One wide row per movie.

    The three lists are folded to one row per movie first; the joins on movie_id then reuse that
    distribution and only the movie table is shuffled for them.
    """
    return (
        movie.join(genre_lists(movie_genre, genre), "movie_id", "left")
        .join(top_cast(credit_cast, person), "movie_id", "left")
        .join(primary_company(movie_company, company), "movie_id", "left")
        .select(
            "movie_id",
            "title",
            "original_title",
            "release_date",
            "original_language",
            "status",
            "runtime",
            "budget",
            "revenue",
            profit(col("revenue"), col("budget")).alias("profit"),
            roi(col("revenue"), col("budget")).alias("roi"),
            "vote_average",
            "vote_count",
            "popularity",
            "genre_list",
            "top_3_cast",
            "primary_company",
        )
    )


# Mart name -> (conformed tables it reads, builder).
GOLD: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "dim_movie": (("movie",), dim_movie),
    "dim_person": (("person",), dim_person),
    "dim_genre": (("genre",), dim_genre),
    "dim_company": (("company",), dim_company),
    "dim_keyword": (("keyword",), dim_keyword),
    "dim_date": (("movie",), dim_date),
    "fact_movie": (("movie",), fact_movie),
    "fact_movie_cast": (("credit_cast",), fact_movie_cast),
    "fact_movie_crew": (("credit_crew",), fact_movie_crew),
    "bridge_movie_genre": (("movie_genre",), bridge_movie_genre),
    "bridge_movie_company": (("movie_company",), bridge_movie_company),
    "movie_analytics": (
        ("movie", "movie_genre", "genre", "credit_cast", "person", "movie_company", "company"),
        movie_analytics,
    ),
}
