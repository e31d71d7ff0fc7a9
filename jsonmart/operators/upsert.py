"""Keyed tables on plain parquet: the merge is a DataFrame, the write Spark's dynamic partition overwrite.

Rows lie in directories that follow from their key, so a key never moves and an upsert reads and
writes only the directories of its updates: the touched directories are a broadcast side of a plain equality
join on partition columns, which Spark turns into dynamic partition pruning of the scan.

By default the directories are hash parts. Their number is a power of two that fits the table: no part is planned for more
than ``part_rows`` rows, so one key never rewrites more than about that, however large the table is. The table
doubles its parts when an upsert finds them fuller; the new layout is written beside the old one and takes over with one
appended row. All rows are moved once per doubling, which costs less than they cost when they first came.

One writer at a time. Updates are written to a folder of their own first; a run that dies before its commit leaves
the table as it was, and the same upsert can be run again, also after one that died while Spark was exchanging
directories.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.values import COMPRESSION
from .pick import pick_first

#: Hash parts of a table that is still small.
KEY_PARTS = 8
#: Rows of a hash part, by default. Some 100 MB for rows of 100 bytes.
PART_ROWS = 1_000_000
#: Directory of keys for which an expression gives none; a null would need a null-safe join, which Spark doesn't prune.
NO_DIRECTORY = "-"
#: Column of the stored rows that tells whether a row has changed.
ROW_HASH = "_row_hash"


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` without the keys of ``new``, and ``new``. Both have unique keys without nulls."""
    return old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns).unionByName(new)


def row_hash(columns: Sequence[str]) -> Column:
    """128 bits of a row's values; a null hashes as such, not as nothing."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.concat_ws("-", F.hex(F.xxhash64(*parts)), F.hex(F.xxhash64(F.lit(1), *parts)))


class KeyedTable:
    """A parquet table with unique keys.

    ``directories`` maps names to expressions over the key columns; by default they are hash parts, as many
    as keep each at ``part_rows`` rows, ``parts`` (a power of two) at least.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType | str,
        keys: Sequence[str],
        directories: Mapping[str, Column] | None = None,
        parts: int = KEY_PARTS,
        part_rows: int = PART_ROWS,
    ):
        if parts < 1 or parts & (parts - 1):
            raise ValueError(f"parts must be a power of two, not {parts}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys = list(keys)
        self.part_rows = part_rows
        self._given = {d: F.coalesce(c.cast("string"), F.lit(NO_DIRECTORY)) for d, c in (directories or {}).items()}
        self._least_parts = parts
        rows = spark.createDataFrame([], self.schema).withColumn(ROW_HASH, F.lit(""))
        self._file_schema = rows.withColumns(self._directories(1)).schema  # explicit, as inference would turn '001' into 1

    def read(self) -> DataFrame:
        return self._rows(self.parts()).select(*self.schema.names)

    def exists(self) -> bool:
        return not self._rows(self.parts()).isEmpty()

    def files(self) -> dict[str, str]:
        """The stored files with their directories, by Spark's own listing; an upsert gives new files to what it rewrites."""
        below = f"/{self._data(self.parts())}/"
        return {f: f.rsplit(below, 1)[-1].rpartition("/")[0] for f in self._rows(self.parts()).inputFiles()}

    def parts(self) -> int:
        """Number of hash parts at present; 0 if the directories are given by expressions."""
        if self._given:
            return 0
        schema = "parts INT, at TIMESTAMP"
        layouts = self._stored(schema, self.spark.read.schema(schema).json, "layout")
        return layouts.agg(F.max_by("parts", "at")).first()[0] or self._least_parts

    def upsert(self, updates: DataFrame, latest_by: Sequence[str] = (), changed_only: bool = False) -> None:
        """Insert new keys, replace rows of known keys.

        Of several updates for one key the largest by ``latest_by`` wins; these columns need not be
        columns of the table. Without it, there is no such rule and two updates stop the run. With
        ``changed_only`` updates that are equal to the stored row are left out, by the stored hashes of the rows,
        so that a full recompute rewrites only directories with a change in them.
        """
        parts = self.parts()
        new, _ = self._stage(self._latest(updates, latest_by), parts, "staged")
        if changed_only:
            stored = self._rows(parts).select(*self.keys, ROW_HASH)
            new, _ = self._stage(new.join(stored, [*self.keys, ROW_HASH], "left_anti"), parts, "changed")
        touched = self._touched(new)
        rows = self._write(self._merged(new, touched, parts), parts, "dynamic")
        if parts and rows > self.part_rows:
            factor = self._doublings(-(-rows // touched.count()))
            if factor > 1:
                self._lay_out(self._rows(parts), parts * factor)

    def replace(self, df: DataFrame) -> None:
        """Full refresh: the new rows become the whole table."""
        parts = self.parts()
        staged, rows = self._stage(self._typed(df), parts, "staged")
        fitting = parts and max(parts, self._least_parts * self._doublings(-(-rows // self._least_parts)))
        if fitting == parts:
            self._write(staged, parts, "static")
        else:
            self._lay_out(staged, fitting)

    def _doublings(self, rows: int) -> int:
        """The power of two that brings ``rows`` of a part to the bound."""
        factor = 1
        while rows > factor * self.part_rows:
            factor *= 2
        return factor

    def _lay_out(self, rows: DataFrame, parts: int) -> None:
        self._write(rows.withColumns(self._directories(parts)), parts, "static")
        now = self.spark.range(1).select(F.lit(parts).alias("parts"), F.current_timestamp().alias("at"))
        now.coalesce(1).write.mode("append").json(f"{self.path}/layout")

    def _touched(self, new: DataFrame) -> DataFrame:
        """The directories of ``new``. Spark prunes only for a side that a comparison makes smaller, so there is one."""
        names = list(self._directories(1))
        return new.where(F.col(names[0]) >= (F.lit("") if self._given else F.lit(0))).select(*names).distinct()

    def _merged(self, new: DataFrame, touched: DataFrame, parts: int) -> DataFrame:
        # at most one narrow row for each directory of the table, so it may be broadcast
        old = self._rows(parts).join(F.broadcast(touched), touched.columns, "left_semi")
        return merge(old, new.select(*old.columns), self.keys)

    def _directories(self, parts: int) -> dict[str, Column]:
        return self._given or {"key_part": F.pmod(F.xxhash64(*self.keys), F.lit(parts)).cast("int")}

    def _latest(self, updates: DataFrame, latest_by: Sequence[str]) -> DataFrame:
        extra = [c for c in latest_by if c not in self.schema.names]
        rows = self._typed(updates, extra)
        if latest_by:
            # cut to one row per key and task before the shuffle; equal rows by all columns are one row
            order = [F.col(c).desc_nulls_last() for c in (*latest_by, *self.schema.names) if c not in self.keys]
            return pick_first(rows, self.keys, order or [F.lit(1)]).drop(*extra)
        rank = F.row_number().over(Window.partitionBy(*self.keys).orderBy(F.lit(1)))
        stop = F.raise_error(F.concat_ws(" ", F.lit("two updates for key"), *[F.col(k) for k in self.keys]))
        return rows.withColumn("_rank", rank).where(F.when(F.col("_rank") == 1, True).otherwise(stop.cast("boolean"))).drop("_rank")

    def _typed(self, df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema], *extra)

    def _stage(self, df: DataFrame, parts: int, name: str) -> tuple[DataFrame, int]:
        # Written once: the rows are read several times, and the source may be the table itself.
        path = f"{self.path}/{name}"
        if ROW_HASH not in df.columns:
            df = df.withColumn(ROW_HASH, row_hash(self.schema.names))
        seen = Observation()
        placed = df.withColumns(self._directories(parts)).observe(seen, F.count(F.lit(1)).alias("rows"))
        placed.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(self._file_schema).parquet(path), seen.get["rows"]

    def _rows(self, parts: int) -> DataFrame:
        return self._stored(self._file_schema, self.spark.read.schema(self._file_schema).parquet, self._data(parts))

    def _stored(self, schema: StructType | str, read: Callable[[str], DataFrame], name: str) -> DataFrame:
        try:
            return read(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def _data(self, parts: int) -> str:
        return f"data-{parts}" if parts else "data"

    def _write(self, df: DataFrame, parts: int, mode: str) -> int:
        """Write the rows to their directories; the number of rows written."""
        names = list(self._directories(1))
        seen = Observation()
        spread = df.hint("rebalance", *[F.col(d) for d in names]).observe(seen, F.count(F.lit(1)).alias("rows"))
        options = {"compression": COMPRESSION, "partitionOverwriteMode": mode}
        spread.write.mode("overwrite").options(**options).partitionBy(*names).parquet(f"{self.path}/{self._data(parts)}")
        return seen.get["rows"]
