"""Fields of documents that are kept as VARIANT.

A VARIANT is parsed once, when it is stored. Reading a field walks its binary form, and Spark moves the
walk into the scan where it can; no job parses text again. The fields are the same texts that the
parser of document texts gives, so the conforming jobs run on either.

Differences: a number is written anew (``1.50`` becomes ``1.5``, ``1e3`` becomes ``1000.0``), a
document with a repeated key is no document, and of an unreadable one nothing is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .jsonx import PAYLOAD_FIELDS


def with_variant(raw: DataFrame, column: str = "payload") -> DataFrame:
    """``raw`` with the document texts of ``column`` as VARIANT; null where a text can't be read."""
    return raw.withColumn(column, F.try_parse_json(F.col(f"`{column}`")))


def variant_fields(doc: Column, resource: str) -> dict[str, Column]:
    """The fields of a VARIANT document, and whether it had another shape (``malformed``).

    An element that is no object is left out of its array and its neighbours stay. Something that is no
    array gives no elements. A missing and a null array give none either, and are well-formed.
    """
    scalars, arrays = PAYLOAD_FIELDS[resource]
    fields = {name: F.try_variant_get(doc, f"$.{name}", "string") for name in scalars}
    malformed = doc.isNull() | F.try_variant_get(doc, "$", "map<string, variant>").isNull()
    for name, element in arrays.items():
        path = f"$.{name}"
        items = F.try_variant_get(doc, path, f"array<{element}>")  # an element of another shape becomes null
        fields[name] = F.filter(items, lambda item: item.isNotNull())
        present = F.try_variant_get(doc, path, "variant")
        kinds = F.try_variant_get(doc, path, "array<variant>")
        absent = present.isNull() | F.is_variant_null(present)
        nulls = F.size(F.filter(kinds, F.is_variant_null))
        other = F.size(kinds) - nulls - F.size(fields[name])
        malformed = malformed | (~absent & (items.isNull() | (other > 0)))
    return {**fields, "malformed": malformed}
