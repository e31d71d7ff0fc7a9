"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key by ``order``, which must be total for the result to be repeatable.

    Spark plans the rank filter as a group limit below and above the shuffle, so a hot key sends
    at most one row per map task over the network, whatever its size.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_by(df: DataFrame, keys: Sequence[str], recency: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Most recent row per key."""
    return pick_first(df, keys, [F.col(recency).desc_nulls_last(), *tiebreak])
