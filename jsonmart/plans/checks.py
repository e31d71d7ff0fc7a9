"""The declared data checks of the conformed tables and the marts."""

from __future__ import annotations

from ..operators.quality import ModelChecks


def _dim(model: str, key: str, *required: str) -> ModelChecks:
    return ModelChecks(model, (key, *required), (key,))


def _link(model: str, left: tuple[str, str], right: tuple[str, str]) -> ModelChecks:
    columns = (left[1], right[1])
    return ModelChecks(model, columns, columns, tuple((c, parent, c) for parent, c in (left, right)))


def _credit(model: str, movies: str, people: str) -> ModelChecks:
    return ModelChecks(
        model,
        ("credit_id", "movie_id", "person_id"),
        ("credit_id",),
        (("movie_id", movies, "movie_id"), ("person_id", people, "person_id")),
    )


SILVER_CHECKS = (
    _dim("genre", "genre_id", "name"),
    _dim("movie", "movie_id", "title"),
    _link("movie_genre", ("movie", "movie_id"), ("genre", "genre_id")),
    _dim("company", "company_id", "name"),
    _link("movie_company", ("movie", "movie_id"), ("company", "company_id")),
    _dim("country", "iso_3166_1"),
    _link("movie_country", ("movie", "movie_id"), ("country", "iso_3166_1")),
    _dim("language", "iso_639_1"),
    _dim("person", "person_id", "name"),
    _credit("credit_cast", "movie", "person"),
    _credit("credit_crew", "movie", "person"),
    _dim("keyword", "keyword_id", "name"),
    _link("movie_keyword", ("movie", "movie_id"), ("keyword", "keyword_id")),
)

GOLD_CHECKS = (
    _dim("dim_movie", "movie_id"),
    _dim("dim_person", "person_id"),
    _dim("dim_genre", "genre_id"),
    _dim("dim_company", "company_id"),
    _dim("dim_keyword", "keyword_id"),
    _dim("dim_date", "date_day"),
    ModelChecks(
        "fact_movie",
        ("movie_id",),
        ("movie_id",),
        (("movie_id", "dim_movie", "movie_id"), ("date_day", "dim_date", "date_day")),
    ),
    _credit("fact_movie_cast", "dim_movie", "dim_person"),
    _credit("fact_movie_crew", "dim_movie", "dim_person"),
    _link("bridge_movie_genre", ("dim_movie", "movie_id"), ("dim_genre", "genre_id")),
    _link("bridge_movie_company", ("dim_movie", "movie_id"), ("dim_company", "company_id")),
    ModelChecks("movie_analytics", ("movie_id", "title"), ("movie_id",), (("movie_id", "dim_movie", "movie_id"),)),
)
