"""Object keys, run ids, natural ids and record counts as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import (
    ENTITY_RESOURCES,
    JSON_SUFFIX,
    KEY_ROOT,
    LISTING_RESOURCES,
    MANIFEST_NAME,
    RUN_ID_LENGTH,
    RUN_ID_UNSAFE,
)


def safe_run_id(run_id: Column) -> Column:
    return F.substring(F.regexp_replace(run_id, RUN_ID_UNSAFE, "-"), 1, RUN_ID_LENGTH)


def with_json_suffix(name: Column) -> Column:
    return F.when(F.endswith(name, F.lit(JSON_SUFFIX)), name).otherwise(F.concat(name, F.lit(JSON_SUFFIX)))


def object_key(resource: Column, ingest_date: Column, run_id: Column, name: Column, root: str = KEY_ROOT) -> Column:
    return F.concat_ws(
        "/",
        F.lit(root),
        resource,
        F.concat(F.lit("ingest_date="), ingest_date.cast("string")),
        F.concat(F.lit("run_id="), safe_run_id(run_id)),
        with_json_suffix(name),
    )


def key_parts(key: Column, root: str = KEY_ROOT) -> Column:
    """Struct (resource, ingest_date, run_id, filename); null for a key of another shape.

    The file name keeps any further slashes.
    """
    pattern = f"(?s)^{root}/([^/]*)/ingest_date=([^/]*)/run_id=([^/]*)/(.*)$"
    fields = ("resource", "ingest_date", "run_id", "filename")
    parsed = F.struct(*[F.regexp_extract(key, pattern, i).alias(f) for i, f in enumerate(fields, start=1)])
    return F.when(key.rlike(pattern), parsed)


def is_manifest(key: Column) -> Column:
    return F.endswith(key, F.lit("." + MANIFEST_NAME)) | F.endswith(key, F.lit("/" + MANIFEST_NAME))


def page_name(page: Column) -> Column:
    return F.format_string("page_%03d", page)


def is_json_object(payload: Column) -> Column:
    """True for a readable document whose outermost value is an object."""
    return F.json_object_keys(payload).isNotNull()


def natural_id(resource: Column, payload: Column, filename: Column) -> Column:
    """Id of a document: its own id, else the file stem; listings use their page, the rest 0.

    Null when neither the id nor the stem is a number, so that the caller can set the row aside.
    """
    doc = F.from_json(payload, "id STRING, page STRING")
    stem = F.replace(filename, F.lit(JSON_SUFFIX), F.lit(""))
    page = F.coalesce(F.nullif(doc["page"], F.lit("")), F.lit("0"))
    text = (
        F.when(resource.isin(*ENTITY_RESOURCES), F.coalesce(doc["id"], stem))
        .when(resource.isin(*LISTING_RESOURCES), page)
        .otherwise(F.lit("0"))
    )
    return text.try_cast("bigint")


def record_count(resource: Column, payload: Column) -> Column:
    """Number of records inside a document; 1 for entities and for anything that is no object."""
    doc = F.from_json(
        payload,
        "genres ARRAY<STRING>, results ARRAY<STRING>, cast ARRAY<STRING>, crew ARRAY<STRING>, keywords ARRAY<STRING>",
    )

    def length(field: str) -> Column:
        return F.coalesce(F.size(doc[field]), F.lit(0))

    count = (
        F.when(resource == "genre", length("genres"))
        .when(resource.isin(*LISTING_RESOURCES), length("results"))
        .when(resource == "credits", length("cast") + length("crew"))
        .when(resource == "keywords", length("keywords"))
        .otherwise(F.lit(1))
    )
    return F.when(is_json_object(payload), count).otherwise(F.lit(1)).cast("bigint")
