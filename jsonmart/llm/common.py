"""Shared by the operators: whole-table reads, written intermediate tables, text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import fresh_dir

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again; cuts the lineage."""
    path = fresh_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_words(text: Column) -> Column:
    """array<string> of the words of ``text`` (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN, -1), "")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or a longer name that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


#: A side of a join is broadcast only if it was counted and has at most so many narrow rows (ids and hashes).
BROADCAST_ROWS = 1_000_000


def checked_broadcast(df: DataFrame) -> DataFrame:
    """``df``, a written table of few narrow columns, with a broadcast hint if it is small enough; else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: Texts of at most so many bytes are worked on at a time in a task; a longer one goes alone.
SLICE_BYTES = 4 << 20


def text_slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """The rows of Arrow ``batches`` in their order, cut where the bytes of the text ``column`` would exceed ``limit``."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
