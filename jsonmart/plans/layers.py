"""The layered build: raw -> staged -> silver -> gold, each table written once and read back."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import COMPRESSION, PAYLOAD_RESOURCES
from ..operators.quality import dq_report, gate
from ..operators.upsert import merge
from ..streaming.incremental import since_watermark
from .checks import GOLD_CHECKS, SILVER_CHECKS
from .gold import GOLD
from .questions import QUESTIONS
from .silver import SILVER
from .staging import stage

#: Conformed tables that a later build merges into those of the published one, with their keys.
INCREMENTAL = {"movie": "movie_id", "person": "person_id"}

#: Staged leaves are texts, mostly of many values. A dictionary of each costs more time than it saves in bytes.
STAGED_OPTIONS = {"parquet.enable.dictionary": "false"}

#: Tables of one layer that are built side by side.
JOBS = 8


class Layers:
    """The tables of one warehouse root, build by build.

    ``raw`` gives the raw payload rows of a resource. A staged, silver or gold table is written when it is
    first read as an input, so payload text is parsed once, and a lost executor costs a re-read and not a
    rebuild. ``plan_*`` give the unwritten plans. Every build has a folder of its own; readers of
    ``published`` see the last build whose checks all passed, whatever a later one does. With ``staged_views`` the
    staged tables are not written: for payloads that are stored as VARIANT, already parsed, so that each reader walks
    to its own fields only.
    """

    def __init__(self, spark: SparkSession, root: str, raw: Callable[[str], DataFrame], staged_views: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self._raw = raw
        self._staged_views = staged_views
        self._guard = Lock()
        self._begin(None)

    def _begin(self, before: str | None) -> None:
        """A new, empty build; ``before`` is the build that its incremental tables go on from."""
        self.build_id = uuid4().hex
        self._before = before
        self._written: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = {}

    def _table(self, name: str, plan: Callable[[], DataFrame], **options: str) -> DataFrame:
        with self._guard:
            lock = self._locks.setdefault(name, Lock())
        with lock:
            if name not in self._written:
                df = plan()
                path = f"{self.root}/builds/{self.build_id}/{name}"
                df.write.options(compression=COMPRESSION, **options).parquet(path)
                self._written[name] = self.spark.read.schema(df.schema).parquet(path)
            return self._written[name]

    def raw(self, resource: str) -> DataFrame:
        return self._raw(resource)

    def plan_staged(self, resource: str) -> DataFrame:
        return stage(self.raw(resource), resource)

    def staged(self, resource: str) -> DataFrame:
        if self._staged_views:
            return self.plan_staged(resource)
        return self._table(f"staged/{resource}", lambda: self.plan_staged(resource), **STAGED_OPTIONS)

    def plan_silver(self, name: str) -> DataFrame:
        inputs, build = SILVER[name]
        staged = self._inputs(inputs, self.staged)
        key = INCREMENTAL.get(name)
        if key is None or self._before is None:
            return build(*staged)
        old = self.spark.read.parquet(f"{self.root}/builds/{self._before}/silver/{name}")
        # movies load by time; people have two sources and are conformed in full, then merged by id
        new = build(since_watermark(staged[0], old)) if name == "movie" else build(*staged)
        return merge(old, new, [key])

    def silver(self, name: str) -> DataFrame:
        return self._table(f"silver/{name}", lambda: self.plan_silver(name))

    def plan_gold(self, name: str) -> DataFrame:
        inputs, build = GOLD[name]
        return build(*self._inputs(inputs, self.silver))

    def gold(self, name: str) -> DataFrame:
        return self._table(f"gold/{name}", lambda: self.plan_gold(name))

    def question(self, name: str) -> DataFrame:
        inputs, build = QUESTIONS[name]
        return build(*self._inputs(inputs, self.gold))

    def _inputs(self, names: Sequence[str], read: Callable[[str], DataFrame]) -> list[DataFrame]:
        return list(self._build(names, read).values()) if len(names) > 1 else [read(n) for n in names]

    def _build(self, names: Iterable[str], read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        names = list(names)
        # The tables of a layer do not depend on each other; their jobs run side by side, so that the last tasks of
        # one do not leave the cores idle.
        with ThreadPoolExecutor(max_workers=JOBS) as pool:
            return dict(zip(names, pool.map(read, names), strict=True))

    def build_staged(self) -> dict[str, DataFrame]:
        return self._build(PAYLOAD_RESOURCES, self.staged)

    def build_silver(self) -> dict[str, DataFrame]:
        return self._build(SILVER, self.silver)

    def build_gold(self) -> dict[str, DataFrame]:
        # The mart of many tables takes longest, so it starts first.
        return self._build(sorted(GOLD, key=lambda n: len(GOLD[n][0]), reverse=True), self.gold)

    def silver_report(self) -> DataFrame:
        return dq_report(self.build_silver(), SILVER_CHECKS)

    def gold_report(self) -> DataFrame:
        return dq_report(self.build_gold(), GOLD_CHECKS)

    def build(self) -> None:
        """Build everything anew, incremental tables from the published build; publish if all checks pass.

        Gold is only started when the silver checks pass.
        """
        self._begin(self._published())
        gate(self.silver_report())
        gate(self.gold_report())
        pointer = self.spark.range(1).select(F.lit(self.build_id).alias("value"), F.current_timestamp().alias("at"))
        pointer.coalesce(1).write.mode("append").json(f"{self.root}/published")

    def _published(self) -> str | None:
        try:
            pointers = self.spark.read.schema("value STRING, at TIMESTAMP").json(f"{self.root}/published")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return pointers.agg(F.max_by("value", "at")).first()[0]

    def published(self, name: str) -> DataFrame:
        """A table, such as ``gold/fact_movie``, of the last build that passed its checks."""
        build = self._published()
        if build is None:
            raise LookupError("no build has been published yet")
        return self.spark.read.parquet(f"{self.root}/builds/{build}/{name}")
