"""Incremental runs: pick up new landings, refresh tables from new payloads."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import KeyedTable
from ..sources.catalog import Catalog


def _now() -> Column:
    # A literal: current_timestamp() would differ between the two tables of one batch.
    return F.lit(datetime.now(timezone.utc))


def run_incremental(
    landing_stream: DataFrame, catalog: Catalog, checkpoint: str, run_ts: Callable[[], Column] = _now
) -> StreamingQuery:
    """Catalog every landed file that the checkpoint has not seen, then stop.

    Each micro-batch is upserted by key; a batch that is run again after a failure gives the same
    tables.
    """

    def sink(batch: DataFrame, _epoch: int) -> None:
        catalog.add(batch, run_ts())

    query = (
        landing_stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def watermark(target: DataFrame, ts_col: str = "loaded_at"):
    """Latest load time in a table; None while it is empty. One value comes back to the driver."""
    return target.agg(F.max(ts_col)).first()[0]


def since_watermark(raw: DataFrame, target: DataFrame, ts_col: str = "extracted_at", loaded_col: str = "loaded_at"):
    """Source rows newer than everything in the target, strictly.

    The bound is read once and used as a literal, so it reaches the scan as a pushed filter.
    """
    high = watermark(target, loaded_col)
    return raw if high is None else raw.where(F.col(ts_col) > F.lit(high))


def refresh_latest(
    staged: DataFrame,
    target: KeyedTable,
    conform: Callable[[DataFrame], DataFrame],
    id_col: str = "id",
    late: str = "drop",
    arrived: DataFrame | None = None,
) -> None:
    """Upsert the latest snapshot per key from payloads newer than the table's watermark.

    The watermark is table-wide: with ``late="drop"`` an older snapshot that arrives late is
    never looked at. With ``late="reprocess"`` every id among the ``arrived`` payloads (all, if not
    given) is conformed again from all its snapshots in ``staged``.
    """
    if late == "drop":
        target.upsert(conform(since_watermark(staged, target.read())))
    elif late == "reprocess":
        touched = (staged if arrived is None else arrived).select(id_col).distinct()
        target.upsert(conform(staged.join(touched, id_col, "left_semi")))
    else:
        raise ValueError(f"late must be 'drop' or 'reprocess', not {late!r}")
