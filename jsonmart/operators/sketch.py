"""Mergeable distinct counts: HyperLogLog states per group, kept as a table and united when asked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of a state's registers. The standard error of an estimate is 1.04 / sqrt(2^14), some 0.8 percent, whatever the
#: number of rows or states; a state takes 16 KB at most, far less while it has few values.
REGISTERS = 14
STANDARD_ERROR = 1.04 / 2 ** (REGISTERS / 2)


def sketched(df: DataFrame, groups: Sequence[str], column: str, state: str = "state") -> DataFrame:
    """One state of the distinct values of ``column`` per group, small enough to be stored by day and united later.

    Nulls are not counted. States are built before the shuffle, so a hot group sends one state per task.
    """
    return df.groupBy(*groups).agg(F.hll_sketch_agg(column, REGISTERS).alias(state))


def united(states: DataFrame, groups: Sequence[str], name: str, state: str = "state") -> DataFrame:
    """Estimated distinct values per group over all its states; a value in several of them counts once."""
    return states.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg(state)).alias(name))
