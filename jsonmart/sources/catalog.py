"""Document catalog: object registry, payload rows, rejects and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import keys
from ..functions.values import KEY_ROOT, PAYLOAD_RESOURCES
from ..operators.quality import ModelChecks
from ..operators.upsert import KeyedTable
from .landing import changed_objects, documents

REGISTRY_SCHEMA = (
    "bucket STRING, key STRING, resource STRING, ingest_date DATE, dag_run_id STRING, "
    "bytes BIGINT, etag STRING, loaded_at TIMESTAMP"
)
PAYLOAD_SCHEMA = (
    "resource STRING, tmdb_id BIGINT, payload STRING, source_key STRING, extracted_at TIMESTAMP, dag_run_id STRING"
)
LISTING_SCHEMA = "key STRING, bytes BIGINT, last_modified TIMESTAMP"
COUNT_NAMES = ("ingest_objects", "raw_payloads", "skipped_manifests", "listed")
REGISTRY_KEYS = ("bucket", "key")
PAYLOAD_KEYS = ("resource", "tmdb_id", "source_key")

# Key and NOT NULL constraints of the two tables.
CATALOG_CHECKS = (
    ModelChecks(
        "ingest_objects",
        ("bucket", "key", "resource", "ingest_date", "dag_run_id", "loaded_at"),
        REGISTRY_KEYS,
    ),
    ModelChecks(
        "raw_payloads",
        ("resource", "tmdb_id", "payload", "source_key", "extracted_at", "dag_run_id"),
        PAYLOAD_KEYS,
    ),
)


def registry(landing: DataFrame, bucket: str, run_ts: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One registry row per document. ``run_ts`` is fixed once for a catalog run."""
    return documents(landing).select(
        F.lit(bucket).alias("bucket"),
        "key",
        "resource",
        "ingest_date",
        F.col("run_id").alias("dag_run_id"),
        "bytes",
        "etag",
        run_ts.cast("timestamp").alias("loaded_at"),
        *keep,
    )


def _candidates(landing: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    payload = F.col("payload")
    return (
        documents(landing)
        .where(F.col("resource").isin(*PAYLOAD_RESOURCES))
        .select(
            "resource",
            keys.natural_id(F.col("resource"), payload, F.col("filename")).alias("tmdb_id"),
            "payload",
            F.col("key").alias("source_key"),
            F.col("run_id").alias("dag_run_id"),
            F.when(~keys.is_json_object(payload), F.lit("not a JSON object")).alias("_reason"),
            *keep,
        )
        .withColumn("_reason", F.coalesce("_reason", F.when(F.col("tmdb_id").isNull(), F.lit("no natural id"))))
    )


def raw_payloads(landing: DataFrame, run_ts: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One payload row per JSON object of a known resource."""
    extracted_at = run_ts.cast("timestamp").alias("extracted_at")
    return (
        _candidates(landing, keep)
        .where("_reason IS NULL")
        .select("resource", "tmdb_id", "payload", "source_key", extracted_at, "dag_run_id", *keep)
    )


def quarantine(landing: DataFrame) -> DataFrame:
    """Documents of known resources that give no payload row, with the reason."""
    return (
        _candidates(landing)
        .where("_reason IS NOT NULL")
        .select(F.col("source_key").alias("key"), "resource", "payload", F.col("_reason").alias("reason"))
    )


def run_counts(landing: DataFrame) -> DataFrame:
    """Catalog counts per run: listed objects, registry rows, payload rows, skipped manifests."""
    manifest = keys.is_manifest(F.col("key"))
    payload = F.col("payload")
    has_row = (
        ~manifest
        & F.col("resource").isin(*PAYLOAD_RESOURCES)
        & keys.is_json_object(payload)
        & keys.natural_id(F.col("resource"), payload, F.col("filename")).isNotNull()
    )
    return (
        landing.where(F.col("resource").isNotNull())
        .groupBy("ingest_date", "run_id")
        .agg(
            F.count_if(~manifest).alias("ingest_objects"),
            F.count_if(has_row).alias("raw_payloads"),
            F.count_if(manifest).alias("skipped_manifests"),
            F.count(F.lit(1)).alias("listed"),
        )
    )


def run_manifests(landing: DataFrame, run_ts: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """One manifest row per run, ready for ``write_manifests``."""
    pairs = [p for n in COUNT_NAMES for p in (F.lit(n), F.col(n))]
    return run_counts(landing).select(
        "ingest_date",
        "run_id",
        run_ts.cast("timestamp").alias("extracted_at"),
        F.create_map(*pairs).alias("counts"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def write_manifests(manifests: DataFrame, path: str) -> None:
    """Store manifest rows, one directory per run: a run that is stored again replaces its manifest."""
    by_run = manifests.write.mode("overwrite").partitionBy("ingest_date", "run_id")
    by_run.options(ignoreNullFields=False, partitionOverwriteMode="dynamic").json(path)


def read_manifests(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stored manifests, with the ``schema`` of ``run_manifests``."""
    return spark.read.schema(schema).json(path).select(*schema.names)


def _key_directories(column: str) -> dict[str, Column]:
    parts = keys.key_parts(F.col(column))
    return {"key_resource": parts["resource"], "key_date": parts["ingest_date"]}


class Catalog:
    """The two catalog tables, upserted by key, and the objects that were read for them."""

    def __init__(self, spark: SparkSession, root: str, bucket: str = "landing"):
        self.spark = spark
        self.bucket = bucket
        # an object key names its resource and day, so a run touches the directories of its day only
        self.ingest_objects = KeyedTable(
            spark, f"{root}/ingest_objects", REGISTRY_SCHEMA, REGISTRY_KEYS, _key_directories("key")
        )
        self.raw_payloads = KeyedTable(
            spark, f"{root}/raw_payloads", PAYLOAD_SCHEMA, PAYLOAD_KEYS, _key_directories("source_key")
        )
        self.seen_objects = KeyedTable(spark, f"{root}/seen_objects", LISTING_SCHEMA, ("key",), _key_directories("key"))

    def add(self, landing: DataFrame, run_ts: Column) -> dict[str, int]:
        """Register a scan. Both writes are keyed, so a repeat of the same scan changes nothing.

        Of a document that was landed more than once, the last landing wins. Returns the counts of the scan by the
        names of ``run_counts``; they are observed while the rows are written, not counted in a scan of their own. A task
        that Spark has to run again may be observed twice: where counts must survive that, take ``run_counts``.
        """
        last = ("last_modified", "position")
        if landing.isEmpty():  # Spark drops an observation of nothing along with its stage
            return dict.fromkeys(COUNT_NAMES, 0)
        scan, kept = Observation(), Observation()
        known, manifest = F.col("resource").isNotNull(), keys.is_manifest(F.col("key"))
        scanned = landing.observe(
            scan,
            F.count_if(known & ~manifest).alias("ingest_objects"),
            F.count_if(known & manifest).alias("skipped_manifests"),
            F.count_if(known).alias("listed"),
        )
        self.ingest_objects.upsert(registry(scanned, self.bucket, run_ts, last), latest_by=last)
        payloads = raw_payloads(landing, run_ts, last).observe(kept, F.count(F.lit(1)).alias("raw_payloads"))
        self.raw_payloads.upsert(payloads, latest_by=last)
        counts = scan.get | kept.get
        return {name: counts[name] for name in COUNT_NAMES}

    def add_objects(self, root: str, run_ts: Column, key_root: str = KEY_ROOT) -> dict[str, int]:
        """Register the objects under ``root`` that are new or have another size or time than when they were read.

        The objects are listed without opening them; only those are read. A run that dies before its end is to be
        run again and then reads the same objects.
        """
        changed = changed_objects(self.spark, root, self.seen_objects.read(), key_root)
        counts = self.add(changed, run_ts)
        listed = changed.where(F.col("resource").isNotNull()).select(*self.seen_objects.schema.names)
        self.seen_objects.upsert(listed)
        return counts
