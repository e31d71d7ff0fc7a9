"""Data checks as DataFrames, and the gate that stops a run on any failure."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

REPORT_COLUMNS = ("model", "test", "target", "failures")


class CheckFailed(RuntimeError):
    """Raised by the gate; carries the failing report rows."""

    def __init__(self, rows):
        self.rows = rows
        super().__init__("; ".join(f"{r.model}.{r.target} {r.test}: {r.failures}" for r in rows))


@dataclass(frozen=True)
class ModelChecks:
    """Checks of one table: columns that may not be null, the unique key, and the parents."""

    model: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    parents: tuple[tuple[str, str, str], ...] = ()  # (child column, parent model, parent column)

    @property
    def count(self) -> int:
        return len(self.not_null) + bool(self.unique) + len(self.parents)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with their row counts; null children pass.

    Child rows are folded to one per key value before the join, so a hot key joins as one row.
    """
    kind = _common([child.schema[column].dataType, parent.schema[parent_column].dataType])
    key, known = (F.col(c) if kind is None else F.col(c).cast(kind) for c in (column, parent_column))
    keys = child.where(F.col(column).isNotNull()).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(known.alias("key")), "key", "left_anti")


def _common(kinds: Sequence[DataType]) -> str | None:
    """The type to compare such keys in; None where Spark's own widening does it without loss of meaning."""
    numbers = all(isinstance(k, NumericType) for k in kinds)
    times = all(isinstance(k, (DateType, TimestampType, TimestampNTZType)) for k in kinds)
    return None if len(set(kinds)) == 1 or numbers or times else "string"


@dataclass(frozen=True)
class _Failure:
    """Rows that fail a check, and how often each of them counts."""

    when: Column
    check: int
    n: Column

    def entry(self) -> Column:
        return F.when(self.when, F.struct(F.lit(self.check).alias("check"), self.n.cast("bigint").alias("failures")))


@dataclass
class _KeySpace:
    """A key of a table, with the checks that one count of its values decides."""

    model: str
    columns: tuple[str, ...]
    unique: int | None = None
    nulls: list[tuple[int, int]] = field(default_factory=list)  # (column of the key, check)
    children: list[tuple[str, str, int, int | None]] = field(default_factory=list)  # (model, column, check, null check)

    def entries(self, tables: Mapping[str, DataFrame], number: int) -> DataFrame:
        """(space, slot, k0, ...): the key of every own row as slot 0, of every row of a child as a slot of its own."""
        sides = [(tables[self.model], self.columns)] + [(tables[m], (c,)) for m, c, _, _ in self.children]
        kinds = [_common([df.schema[columns[i]].dataType for df, columns in sides]) for i in range(len(self.columns))]
        parts = []
        for slot, (df, columns) in enumerate(sides):
            key = [F.col(c) if kind is None else F.col(c).cast(kind) for c, kind in zip(columns, kinds, strict=True)]
            named = [k.alias(f"k{i}") for i, k in enumerate(key)]
            parts.append(df.select(F.lit(number).alias("space"), F.lit(slot).alias("slot"), *named))
        return reduce(DataFrame.union, parts)

    def failures(self, number: int) -> list[_Failure]:
        keys = [F.col(f"k{i}") for i in range(len(self.columns))]
        here = F.col("space") == number
        known = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
        found = [_Failure(here & keys[i].isNull(), check, F.col("n0")) for i, check in self.nulls]
        if self.unique is not None:
            found.append(_Failure(here & known & (F.col("n0") > 1), self.unique, F.lit(1)))
        for slot, (_, _, check, null_check) in enumerate(self.children, start=1):
            n = F.col(f"n{slot}")
            found.append(_Failure(here & known & (F.col("n0") == 0) & (n > 0), check, n))
            if null_check is not None:
                found.append(_Failure(here & ~known & (n > 0), null_check, n))
        return found


def _counted(entries: DataFrame, slots: int) -> DataFrame:
    keys = [c for c in entries.columns if c != "slot"]
    return entries.groupBy(*keys).agg(*[F.count_if(F.col("slot") == s).alias(f"n{s}") for s in range(slots)])


def _listed(df: DataFrame, found: Sequence[_Failure]) -> DataFrame:
    """(check, failures) of the rows that fail a check; only for these the list of failures is made."""
    failing = df.where(reduce(lambda a, b: a | b, [f.when for f in found]))
    return failing.select(F.explode(F.array_compact(F.array(*[f.entry() for f in found]))).alias("f")).select("f.*")


def dq_report(tables: Mapping[str, DataFrame], checks: Iterable[ModelChecks]) -> DataFrame:
    """One row per declared check with its number of failures.

    Each key space (the unique key of a table, or a column that others point to) is counted in the type common to
    both sides: its own rows and those of all its children are folded to one row per value and task before the shuffle,
    so a hot key sends a row per task. Spaces with keys of one type share the aggregate and its shuffle. The counts give
    the duplicates, the children without a parent and the nulls of all these columns; the other columns are
    looked at without a shuffle. Numbers are compared as numbers, times as times; where one side is a text, both are.
    """
    declared: list[tuple[str, str, str]] = []
    spaces: dict[tuple[str, tuple[str, ...]], _KeySpace] = {}
    checks = list(checks)

    def declare(*check: str) -> int:
        declared.append(check)
        return len(declared) - 1

    def space(model: str, columns: tuple[str, ...]) -> _KeySpace:
        return spaces.setdefault((model, columns), _KeySpace(model, columns))

    failed = []
    for c in checks:
        nulls = {column: declare(c.model, "not_null", column) for column in c.not_null}
        if c.unique:
            own = space(c.model, tuple(c.unique))
            own.unique = declare(c.model, "unique", "-".join(c.unique))
            own.nulls += [(i, nulls.pop(k)) for i, k in enumerate(c.unique) if k in nulls]
        for column, parent, parent_column in c.parents:
            check = declare(c.model, "relationships", column)
            space(parent, (parent_column,)).children.append((c.model, column, check, nulls.pop(column, None)))
        if nulls:
            failed.append(_listed(tables[c.model], [_Failure(F.col(k).isNull(), n, F.lit(1)) for k, n in nulls.items()]))
    alike: dict[tuple, list[tuple[int, _KeySpace, DataFrame]]] = {}
    for number, space_ in enumerate(spaces.values()):
        entries = space_.entries(tables, number)
        alike.setdefault(tuple(f.dataType for f in entries.schema), []).append((number, space_, entries))
    for group in alike.values():
        slots = 1 + max(len(s.children) for _, s, _ in group)
        counted = _counted(reduce(DataFrame.union, [e for _, _, e in group]), slots)
        failed.append(_listed(counted, [f for n, s, _ in group for f in s.failures(n)]))
    totals = reduce(DataFrame.union, failed).groupBy("check").agg(F.sum("failures").alias("failures"))
    listed = F.array(*[F.struct(F.lit(k).alias("check"), F.lit(m).alias("model"), F.lit(t).alias("test"), F.lit(c).alias("target"))
                       for k, (m, t, c) in enumerate(declared)])
    report = totals.sparkSession.range(1).select(F.inline(listed))
    return report.join(totals, "check", "left").select(
        "model", "test", "target", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    )


def gate(report: DataFrame) -> None:
    """Stop the run if any check failed. The report holds one row per check."""
    failed = report.where("failures > 0").orderBy("model", "test", "target").collect()
    if failed:
        raise CheckFailed(failed)
