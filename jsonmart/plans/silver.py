"""Conformed tables from staged resources.

Movies and people keep one row per id. Everything taken from arrays is gathered over all
snapshots, so a link that was removed upstream stays. Ties that the rules leave open are broken
by the remaining columns, which makes every table independent of row order and partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import (
    as_bigint,
    as_boolean,
    as_date,
    as_int,
    as_numeric,
    blank_to_null,
    clean,
)
from ..operators.conform import bridge, conform_dim, explode_array
from ..operators.pick import latest_by, pick_first

Staged = Mapping[str, DataFrame]
col = F.col


def movie(staged: DataFrame, lenient: bool = False) -> DataFrame:
    """Latest snapshot per movie."""
    raw = staged.where(col("id").isNotNull())
    typed = raw.select(
        as_bigint(col("id"), lenient).alias("movie_id"),
        clean(col("title")).alias("title"),
        clean(col("original_title")).alias("original_title"),
        "overview",
        as_date(clean(col("release_date")), lenient).alias("release_date"),
        as_int(blank_to_null(col("runtime")), lenient).alias("runtime"),
        clean(col("status")).alias("status"),
        clean(col("original_language")).alias("original_language"),
        as_numeric(blank_to_null(col("popularity")), lenient).alias("popularity"),
        as_numeric(blank_to_null(col("vote_average")), lenient).alias("vote_average"),
        as_int(blank_to_null(col("vote_count")), lenient).alias("vote_count"),
        F.coalesce(as_bigint(blank_to_null(col("budget")), lenient), F.lit(0)).alias("budget"),
        F.coalesce(as_bigint(blank_to_null(col("revenue")), lenient), F.lit(0)).alias("revenue"),
        F.coalesce(as_boolean(col("adult"), lenient), F.lit(False)).alias("adult"),
        "poster_path",
        "backdrop_path",
        col("extracted_at").alias("loaded_at"),
        "source_key",
    )
    return latest_by(typed, ["movie_id"], "loaded_at", [col("source_key").desc()]).drop("source_key")


def person(details: DataFrame, credits: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per person: the latest detail document, else the most popular credit.

    Both rules are one ordering, so the two sources share a single shuffle.
    """

    def common(name: str):
        return {
            "person_id": as_bigint(col("id"), lenient),
            "name": clean(col("name")),
            "gender": as_int(blank_to_null(col("gender")), lenient),
            "known_for_department": clean(col("known_for_department")),
            "popularity": as_numeric(blank_to_null(col("popularity")), lenient),
            "source_rank": F.lit(1 if name == "detail" else 2),
        }

    def select(df: DataFrame, source: str, **extra) -> DataFrame:
        columns = {**common(source), **extra}
        return df.where(col("id").isNotNull()).select(*[c.alias(n) for n, c in columns.items()])

    no_date, no_text = F.lit(None).cast("date"), F.lit(None).cast("string")
    from_details = select(
        details,
        "detail",
        birthday=as_date(clean(col("birthday")), lenient),
        deathday=as_date(clean(col("deathday")), lenient),
        place_of_birth=clean(col("place_of_birth")),
        biography=col("biography"),
        recency=col("extracted_at"),
        tie=col("source_key"),
    )
    from_credits = select(
        explode_array(credits, ["cast", "crew"], ["id", "name", "gender", "known_for_department", "popularity"]),
        "credit",
        birthday=no_date,
        deathday=no_date,
        place_of_birth=no_text,
        biography=no_text,
        recency=F.lit(None).cast("timestamp"),
        tie=no_text,
    )
    is_credit = col("source_rank") == 2
    best = pick_first(
        from_details.unionByName(from_credits),
        ["person_id"],
        [
            col("source_rank").asc(),
            col("recency").desc_nulls_last(),
            F.when(is_credit, col("popularity")).desc_nulls_last(),
            col("tie").desc_nulls_last(),
            col("name").asc_nulls_last(),
            col("known_for_department").asc_nulls_last(),
            col("gender").asc_nulls_last(),
        ],
    )
    return best.drop("source_rank", "recency", "tie")


def genre(genre_list: DataFrame, movies: DataFrame, lenient: bool = False) -> DataFrame:
    """Reference list and movie genres together; the largest name per id."""

    def items(staged: DataFrame) -> DataFrame:
        return explode_array(staged, "genres", ["id", "name"]).select(
            as_int(col("id"), lenient).alias("genre_id"), clean(col("name")).alias("name")
        )

    both = items(genre_list).union(items(movies)).distinct()
    return conform_dim(both.where(col("genre_id").isNotNull()), "genre_id", ["name"])


def company(movies: DataFrame, lenient: bool = False) -> DataFrame:
    items = explode_array(movies, "production_companies", ["id", "name", "origin_country"]).where(col("id").isNotNull())
    typed = items.select(
        as_bigint(col("id"), lenient).alias("company_id"),
        clean(col("name")).alias("name"),
        clean(col("origin_country")).alias("origin_country"),
    )
    return conform_dim(typed, "company_id", ["name", "origin_country"])


def country(movies: DataFrame) -> DataFrame:
    items = explode_array(movies, "production_countries", ["iso_3166_1", "name"]).select(
        clean(col("iso_3166_1")).alias("iso_3166_1"), clean(col("name")).alias("name")
    )
    return conform_dim(items.where(col("iso_3166_1").isNotNull()), "iso_3166_1", ["name"])


def language(movies: DataFrame) -> DataFrame:
    fields = ["iso_639_1", "english_name", "name"]
    items = explode_array(movies, "spoken_languages", fields).select(*[clean(col(c)).alias(c) for c in fields])
    return conform_dim(items.where(col("iso_639_1").isNotNull()), "iso_639_1", ["english_name", "name"])


def keyword(keywords: DataFrame, lenient: bool = False) -> DataFrame:
    items = explode_array(keywords, "keywords", ["id", "name"]).where(col("id").isNotNull())
    typed = items.select(as_bigint(col("id"), lenient).alias("keyword_id"), clean(col("name")).alias("name"))
    return conform_dim(typed, "keyword_id", ["name"])


def _links(
    staged: DataFrame, array: str, field: str, child: str, convert: Callable[[Column], Column], current_only: bool
) -> DataFrame:
    docs = staged.where(col("id").isNotNull()).withColumnRenamed("id", "movie_key")
    items = explode_array(docs, array, [field], ["movie_key", "extracted_at"])
    movie_id = as_bigint(col("movie_key")).alias("movie_id")
    links = items.select(movie_id, convert(col(field)).alias(child), "extracted_at")
    if not current_only:
        return bridge(links, "movie_id", child)
    # Both sides are folded to their latest time before the join, so a hot id is one row there.
    latest = docs.groupBy(movie_id).agg(F.max("extracted_at").alias("latest"))
    seen = links.groupBy("movie_id", child).agg(F.max("extracted_at").alias("seen"))
    return bridge(seen.join(latest, "movie_id").where(col("seen") == col("latest")), "movie_id", child)


def movie_genre(movies: DataFrame, current_only: bool = False) -> DataFrame:
    return _links(movies, "genres", "id", "genre_id", as_int, current_only)


def movie_company(movies: DataFrame, current_only: bool = False) -> DataFrame:
    return _links(movies, "production_companies", "id", "company_id", as_bigint, current_only)


def movie_country(movies: DataFrame, current_only: bool = False) -> DataFrame:
    return _links(movies, "production_countries", "iso_3166_1", "iso_3166_1", clean, current_only)


def movie_keyword(keywords: DataFrame, current_only: bool = False) -> DataFrame:
    return _links(keywords, "keywords", "id", "keyword_id", as_bigint, current_only)


def _credits(credits: DataFrame, array: str, fields: list[str], columns: dict[str, Column]) -> DataFrame:
    """Latest row per credit id; rows without a movie, person or credit id are dropped."""
    docs = credits.where(col("id").isNotNull()).withColumnRenamed("id", "movie_key")
    items = explode_array(docs, array, ["id", "credit_id", *fields], ["movie_key", "extracted_at"])
    typed = items.where(col("id").isNotNull() & blank_to_null(col("credit_id")).isNotNull()).select(
        *[c.alias(n) for n, c in columns.items()], "extracted_at"
    )
    rest = [col(n).asc_nulls_last() for n in columns if n != "credit_id"]
    return latest_by(typed, ["credit_id"], "extracted_at", rest).drop("extracted_at")


def credit_cast(credits: DataFrame, lenient: bool = False) -> DataFrame:
    return _credits(
        credits,
        "cast",
        ["character", "order"],
        {
            "movie_id": as_bigint(col("movie_key"), lenient),
            "person_id": as_bigint(col("id"), lenient),
            "credit_id": col("credit_id"),
            "character": col("character"),
            "cast_order": as_int(blank_to_null(col("order")), lenient),
        },
    )


def credit_crew(credits: DataFrame, lenient: bool = False) -> DataFrame:
    return _credits(
        credits,
        "crew",
        ["department", "job"],
        {
            "movie_id": as_bigint(col("movie_key"), lenient),
            "person_id": as_bigint(col("id"), lenient),
            "credit_id": col("credit_id"),
            "department": clean(col("department")),
            "job": clean(col("job")),
        },
    )


# Table name -> (staged resources it reads, builder).
SILVER: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "movie": (("movie",), movie),
    "person": (("person", "credits"), person),
    "genre": (("genre", "movie"), genre),
    "company": (("movie",), company),
    "country": (("movie",), country),
    "language": (("movie",), language),
    "keyword": (("keywords",), keyword),
    "movie_genre": (("movie",), movie_genre),
    "movie_company": (("movie",), movie_company),
    "movie_country": (("movie",), movie_country),
    "movie_keyword": (("keywords",), movie_keyword),
    "credit_cast": (("credits",), credit_cast),
    "credit_crew": (("credits",), credit_crew),
}

# Texts that lenient casts turn into null, by resource: scalar fields and their types.
_CAST_FIELDS = {
    "movie": {
        "id": as_bigint,
        "release_date": lambda c, lenient: as_date(clean(c), lenient),
        "runtime": lambda c, lenient: as_int(blank_to_null(c), lenient),
        "popularity": lambda c, lenient: as_numeric(blank_to_null(c), lenient),
        "vote_average": lambda c, lenient: as_numeric(blank_to_null(c), lenient),
        "vote_count": lambda c, lenient: as_int(blank_to_null(c), lenient),
        "budget": lambda c, lenient: as_bigint(blank_to_null(c), lenient),
        "revenue": lambda c, lenient: as_bigint(blank_to_null(c), lenient),
        "adult": as_boolean,
    },
    "person": {
        "id": as_bigint,
        "gender": lambda c, lenient: as_int(blank_to_null(c), lenient),
        "popularity": lambda c, lenient: as_numeric(blank_to_null(c), lenient),
        "birthday": lambda c, lenient: as_date(clean(c), lenient),
        "deathday": lambda c, lenient: as_date(clean(c), lenient),
    },
}


def cast_rejects(staged: DataFrame, resource: str) -> DataFrame:
    """How many non-blank values of each scalar field a lenient build would turn into null.

    The row ``malformed`` counts documents that had another shape than expected.
    """
    fields = _CAST_FIELDS[resource]
    rejected = {f: clean(col(f)).isNotNull() & cast(col(f), True).isNull() for f, cast in fields.items()}
    rejected["malformed"] = col("malformed")
    counts = staged.agg(*[F.count_if(c).alias(f) for f, c in rejected.items()])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), col(f).alias("rejected")) for f in rejected])
    return counts.select(F.lit(resource).alias("resource"), F.inline(rows))
