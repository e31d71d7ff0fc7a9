"""Payload schemas and the text-to-type casts of the conforming jobs.

Every leaf is parsed as STRING first: a typed from_json field turns "12" into null, while a
text-then-cast path accepts both 12 and "12". Casts are strict (a bad value stops the run)
unless ``lenient`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import NUMERIC


def _struct(*names: str) -> str:
    return "STRUCT<" + ", ".join(f"`{n}`: STRING" for n in names) + ">"


# Cast and crew share one element type, so that the two arrays can be concatenated.
CREDIT_FIELDS = (
    "id", "name", "gender", "known_for_department", "popularity", "credit_id",
    "character", "order", "department", "job",
)

MOVIE_SCALARS = (
    "id", "title", "original_title", "overview", "release_date", "runtime", "status", "original_language",
    "popularity", "vote_average", "vote_count", "budget", "revenue", "adult", "poster_path", "backdrop_path",
)

PERSON_SCALARS = (
    "id", "name", "gender", "known_for_department", "popularity",
    "birthday", "deathday", "place_of_birth", "biography",
)

# Resource -> (scalar fields, array fields with their element types).
PAYLOAD_FIELDS: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "movie": (
        MOVIE_SCALARS,
        {
            "genres": _struct("id", "name"),
            "production_companies": _struct("id", "name", "origin_country"),
            "production_countries": _struct("iso_3166_1", "name"),
            "spoken_languages": _struct("iso_639_1", "english_name", "name"),
        },
    ),
    "credits": (("id",), {"cast": _struct(*CREDIT_FIELDS), "crew": _struct(*CREDIT_FIELDS)}),
    "keywords": (("id",), {"keywords": _struct("id", "name")}),
    "person": (PERSON_SCALARS, {}),
    "genre": ((), {"genres": _struct("id", "name")}),
    "movie_popular": (("page", "total_pages"), {"results": _struct("id")}),
    "movie_top_rated": (("page", "total_pages"), {"results": _struct("id")}),
}


def _array_objects(payload: Column, name: str, element: str) -> Column:
    texts = F.from_json(payload, f"`{name}` ARRAY<STRING>")[name]
    objects = F.filter(texts, lambda t: F.json_object_keys(t).isNotNull())
    return F.transform(objects, lambda t: F.from_json(t, element))


CORRUPT = "_corrupt_record"


def parse_document(payload: Column, resource: str) -> Column:
    """A document as one struct; the text itself is in ``CORRUPT`` if its shape is not the expected one."""
    scalars, arrays = PAYLOAD_FIELDS[resource]
    types = [f"`{s}` STRING" for s in scalars] + [f"`{a}` ARRAY<{t}>" for a, t in arrays.items()]
    return F.from_json(payload, ", ".join([*types, f"{CORRUPT} STRING"]), {"columnNameOfCorruptRecord": CORRUPT})


def document_fields(doc: Column, resource: str) -> dict[str, Column]:
    """The fields of a parsed document, and whether it had another shape (``malformed``).

    from_json gives up an array as a whole when one element is no object. Such documents, and no
    others, are read a second time element by element, and their objects are kept. Something that
    is no array gives no elements.
    """
    scalars, arrays = PAYLOAD_FIELDS[resource]
    malformed = doc[CORRUPT].isNotNull()
    fields = {s: doc[s] for s in scalars}
    for name, element in arrays.items():
        fields[name] = F.when(malformed, _array_objects(doc[CORRUPT], name, element)).otherwise(doc[name])
    return {**fields, "malformed": malformed}


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def clean(text: Column) -> Column:
    """Trim spaces (only spaces) and turn an empty rest into null."""
    return F.nullif(F.trim(text), F.lit(""))


def _cast(value: Column, dtype: str, lenient: bool) -> Column:
    return value.try_cast(dtype) if lenient else value.cast(dtype)


def as_bigint(text: Column, lenient: bool = False) -> Column:
    return _cast(text, "bigint", lenient)


def as_int(text: Column, lenient: bool = False) -> Column:
    return _cast(text, "int", lenient)


def as_numeric(text: Column, lenient: bool = False) -> Column:
    return _cast(text, NUMERIC, lenient)


def as_date(text: Column, lenient: bool = False) -> Column:
    return _cast(text, "date", lenient)


def as_boolean(text: Column, lenient: bool = False) -> Column:
    return _cast(text, "boolean", lenient)


def profit(revenue: Column, budget: Column) -> Column:
    return revenue - budget


def roi(revenue: Column, budget: Column) -> Column:
    """Profit per unit of budget as DECIMAL(38,18); null without a positive budget."""
    gain = profit(revenue, budget).cast("decimal(20,0)")
    return F.when(budget > 0, gain / budget.cast("decimal(20,0)"))
