"""Array expansion, conformed dimensions, bridges and ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_array(
    df: DataFrame, arrays: str | Sequence[str], fields: Sequence[str], keep: Sequence[Column | str] = ()
) -> DataFrame:
    """One row per element of an array of structs: the kept columns, then the named element fields.

    Several arrays are read one after the other. Missing, null and empty arrays give no rows. The
    fields are zipped from one array each, as Spark prunes the scan to them only in this form;
    an explode of the whole array reads all fields of its elements.
    """
    names = [arrays] if isinstance(arrays, str) else list(arrays)

    def values(field: str) -> Column:
        if len(names) == 1:
            return F.col(f"{names[0]}.{field}")
        none = F.array().cast(df.select(f"{names[0]}.{field}").schema[0].dataType)
        return F.concat(*[F.coalesce(F.col(f"{n}.{field}"), none) for n in names])

    zipped = F.arrays_zip(*[values(f).alias(f) for f in fields])
    exploded = df.select(*keep, F.explode(zipped).alias("_item"))
    kept = exploded.columns[:-1]
    return exploded.select(*kept, "_item.*")


def conform_dim(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Largest value per key, each column on its own; aggregated before and after the shuffle."""
    return df.groupBy(key).agg(*[F.max(v).alias(v) for v in values])


def bridge(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Distinct (parent, child) pairs with both sides present."""
    return df.where(F.col(parent).isNotNull() & F.col(child).isNotNull()).select(parent, child).distinct()


def _listagg(value: str, order: Sequence[str], sep: str) -> Column:
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
    by = ", ".join(f"`{o}`" for o in order)
    return F.expr(f"listagg(`{value}`, '{quoted}') WITHIN GROUP (ORDER BY {by})")


def ordered_list(
    df: DataFrame,
    key: str,
    value: str,
    order: Sequence[str],
    alias: str,
    sep: str = ", ",
    chunk: Sequence[str] = (),
) -> DataFrame:
    """One string per key: the values in order; nulls are skipped, an all-null group gives null.

    ``chunk`` names leading order columns, or columns that rise with the order; the order must
    name at least one column more. With it, the list is built in two steps: one string per (key, chunk), then the strings of a key. A hot key is
    then spread over many tasks, and the last step only holds the text it has to return.
    """
    if not chunk:
        return df.groupBy(key).agg(_listagg(value, order, sep).alias(alias))
    within = [o for o in order if o not in chunk]  # a chunk column is constant inside its part
    parts = df.groupBy(key, *chunk).agg(_listagg(value, within, sep).alias("_part"))
    return parts.groupBy(key).agg(_listagg("_part", chunk, sep).alias(alias))
