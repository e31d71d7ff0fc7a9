"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_dim(df: DataFrame, date_col: str) -> DataFrame:
    """Every day between the first and last date of a column; 1970-01-01 alone if it has none.

    The bounds are one aggregated row, so the series is as long as the calendar, not the data.
    """
    fallback = F.lit("1970-01-01").cast("date")
    bounds = df.agg(
        F.coalesce(F.min(date_col), fallback).alias("first"),
        F.coalesce(F.max(date_col), fallback).alias("last"),
    )
    day = F.col("date_day")
    # years first, then the days of each: no array is longer than a year, and tasks share the years
    years = bounds.select("first", "last", F.explode(F.sequence(F.year("first"), F.year("last"))).alias("y"))
    years = years.repartition("y").select(
        F.greatest("first", F.make_date("y", F.lit(1), F.lit(1))).alias("first"),
        F.least("last", F.make_date("y", F.lit(12), F.lit(31))).alias("last"),
    )
    return years.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("date_day")).select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.rpad(F.date_format(day, "EEEE"), 9, " ").alias("day_name"),
    )
