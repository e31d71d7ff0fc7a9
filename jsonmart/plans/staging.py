"""Parse each resource once: payload text to columns, every leaf still text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ..functions.jsonx import document_fields, parse_document
from ..functions.variants import variant_fields


def stage(raw: DataFrame, resource: str) -> DataFrame:
    """Payloads of one resource as columns, with malformed, source_key and extracted_at.

    The resource filter prunes directories; the schema is fixed, so no pass infers it. Payloads are
    texts, or VARIANT, which was parsed when it was stored.
    """
    if isinstance(raw.schema["payload"].dataType, VariantType):
        fields = variant_fields(F.col("payload"), resource)
        rows = raw.where(F.col("resource") == resource)
        return rows.select(*[c.alias(name) for name, c in fields.items()], "source_key", "extracted_at")
    # Two steps, so that a document is parsed once and not once per field.
    parsed = raw.where(F.col("resource") == resource).select(
        parse_document(F.col("payload"), resource).alias("doc"), "source_key", "extracted_at"
    )
    fields = document_fields(F.col("doc"), resource)
    return parsed.select(*[c.alias(name) for name, c in fields.items()], "source_key", "extracted_at")
