"""Landing zone: write and scan raw documents, with their audit data.

Two layouts are read. ``objects`` has one JSON document per file under the object key.
``batches`` is what ``write_landing`` makes: many documents per file, partitioned by resource,
ingest date and run, so that a run scan prunes directories and there are no tiny files.
Both give the same columns.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.values import KEY_ROOT

_LANDING_SCHEMA = (
    "key STRING, resource STRING, ingest_date DATE, run_id STRING, filename STRING, payload STRING, "
    "bytes BIGINT, etag STRING, last_modified TIMESTAMP, position BIGINT, request_path STRING, http_status INT"
)
_BATCH_SCHEMA = (
    "filename STRING, payload STRING, request_path STRING, http_status INT, landed_at BIGINT, position BIGINT, "
    "resource STRING, ingest_date DATE, run_id STRING"
)
_PARTITIONS = ("resource", "ingest_date", "run_id")


def write_landing(df: DataFrame, root: str, mode: str = "append") -> None:
    """Land documents: columns resource, ingest_date, run_id, name, payload; request_path and http_status if known.

    A struct payload is rendered as compact JSON with its nulls; a string is kept as it is. Each row
    keeps the time of this call and its position in ``df``: of two rows for one key the later is the newer.
    The rows are rebalanced by directory: small directories get one file, and a directory with
    most of the rows is split over many tasks.
    """
    payload: Column = F.col("payload")
    landed_at = int(datetime.now(timezone.utc).timestamp() * 1_000_000)
    if df.schema["payload"].dataType.typeName() == "struct":
        payload = F.to_json(payload, {"ignoreNullFields": "false"})
    df.select(
        keys.with_json_suffix(F.col("name")).alias("filename"),
        payload.alias("payload"),
        *_known_response(df),
        F.lit(landed_at).alias("landed_at"),
        F.monotonically_increasing_id().alias("position"),
        "resource",
        F.col("ingest_date").cast("date").alias("ingest_date"),
        keys.safe_run_id(F.col("run_id")).alias("run_id"),
    ).hint("rebalance", *[F.col(c) for c in _PARTITIONS]).write.option("compression", "gzip").partitionBy(*_PARTITIONS).mode(mode).json(root)


def _known_response(df: DataFrame) -> list[Column]:
    """request_path and http_status of the rows; null where they are not known."""
    kinds = {"request_path": "string", "http_status": "int"}
    return [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]


def _restrict(df: DataFrame, ingest_date: str | None, run_id: str | None) -> DataFrame:
    if ingest_date is not None:
        df = df.where(F.col("ingest_date") == F.lit(ingest_date).cast("date"))
    if run_id is not None:
        df = df.where(F.col("run_id") == keys.safe_run_id(F.lit(run_id)))
    return df


def read_landing(spark: SparkSession, root: str, ingest_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """Documents of the ``batches`` layout; date and run become partition filters."""
    df = spark.read.schema(_BATCH_SCHEMA).json(root)
    return _restrict(_batch_columns(df), ingest_date, run_id)


def read_landing_stream(spark: SparkSession, root: str, **options) -> DataFrame:
    """The same documents as a file stream."""
    return _batch_columns(spark.readStream.schema(_BATCH_SCHEMA).options(**options).json(root))


def _batch_columns(df: DataFrame) -> DataFrame:
    key = keys.object_key(F.col("resource"), F.col("ingest_date"), F.col("run_id"), F.col("filename"))
    return df.select(
        key.alias("key"),
        "resource",
        "ingest_date",
        "run_id",
        "filename",
        "payload",
        F.octet_length("payload").cast("bigint").alias("bytes"),
        F.sha2("payload", 256).alias("etag"),
        F.timestamp_micros("landed_at").alias("last_modified"),
        "position",
        "request_path",
        "http_status",
    )


def _object_source(reader, path: str) -> DataFrame:
    # The lookup option keeps Spark from reading types or conflicts into the directory names. Paths
    # end in a glob, as Spark would not list the folder of run manifests, '_run', by itself.
    return reader.schema("value STRING").option("recursiveFileLookup", True).text(path, wholetext=True)


def _key_of_path(path: Column, key_root: str) -> Column:
    return F.regexp_extract(path, f"(?s)({key_root}/.*)$", 1)


def _object_columns(df: DataFrame, key_root: str) -> DataFrame:
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return _landing_columns(
        df.select(
            _key_of_path(path, key_root).alias("key"),
            F.col("value").alias("payload"),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("last_modified"),
        ),
        key_root,
    )


def _landing_columns(objects: DataFrame, key_root: str) -> DataFrame:
    """The landing's columns from key, payload, bytes and last_modified."""
    return (
        objects.withColumn("_parts", keys.key_parts(F.col("key"), key_root))
        .select(
            "key",
            F.col("_parts.resource").alias("resource"),
            F.col("_parts.ingest_date").try_cast("date").alias("ingest_date"),
            F.col("_parts.run_id").alias("run_id"),
            F.col("_parts.filename").alias("filename"),
            "payload",
            "bytes",
            F.sha2("payload", 256).alias("etag"),
            "last_modified",
            F.lit(0).cast("bigint").alias("position"),
            F.lit(None).cast("string").alias("request_path"),
            F.lit(None).cast("int").alias("http_status"),
        )
    )


def read_objects(
    spark: SparkSession,
    root: str,
    ingest_date: str | None = None,
    run_id: str | None = None,
    key_root: str = KEY_ROOT,
) -> DataFrame:
    """Documents of the ``objects`` layout, read whole; a run is picked by a path glob.

    ``root`` is the folder above ``key_root``. Keys of another shape keep their row with null
    parts (see ``bad_keys``).
    """
    base = f"{root.rstrip('/')}/{key_root}"
    if ingest_date is None and run_id is None:
        return _object_columns(_object_source(spark.read, f"{base}/*"), key_root)
    run = "*" if run_id is None else spark.range(1).select(keys.safe_run_id(F.lit(run_id))).first()[0]
    path = f"{base}/*/ingest_date={ingest_date or '*'}/run_id={run}"
    try:
        return _object_columns(_object_source(spark.read, path), key_root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LANDING_SCHEMA)  # a run without objects


def read_objects_stream(spark: SparkSession, root: str, key_root: str = KEY_ROOT, **options) -> DataFrame:
    reader = spark.readStream.options(**options)
    return _object_columns(_object_source(reader, f"{root.rstrip('/')}/{key_root}/*"), key_root)


def changed_objects(spark: SparkSession, root: str, seen: DataFrame, key_root: str = KEY_ROOT) -> DataFrame:
    """Documents of the ``objects`` layout that ``seen`` (key, bytes, last_modified) does not have as they are now.

    The objects are listed as binary files without their content, which Spark does not open for that. The two
    ends of the time range of what is new go to the scan as filters on the file times, so of the older objects
    no byte is read either; without anything new there is no scan at all.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root.rstrip('/')}/{key_root}/*")
    named = listed.select(
        _key_of_path(F.col("path"), key_root).alias("key"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("last_modified"),
        F.col("content").cast("string").alias("payload"),
    )
    same = ["key", "bytes", "last_modified"]
    new = named.join(seen.select(*same), same, "left_anti")
    first, last = new.agg(F.min("last_modified"), F.max("last_modified")).first()
    if first is None:
        return spark.createDataFrame([], _LANDING_SCHEMA)
    return _landing_columns(new.where(F.col("last_modified").between(F.lit(first), F.lit(last))), key_root)


def bad_keys(landing: DataFrame) -> DataFrame:
    return landing.where(F.col("resource").isNull())


def documents(landing: DataFrame) -> DataFrame:
    """Landed objects with a well-formed key that are no manifests."""
    return landing.where(F.col("resource").isNotNull() & ~keys.is_manifest(F.col("key")))


def audit(landing: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """One audit row per document: where it came from, when, how many records and bytes.

    The path of the request and its status are null where the landing does not know them.
    """
    return documents(landing).select(
        *_known_response(landing),
        (F.current_timestamp() if extracted_at is None else extracted_at).alias("extracted_at"),
        keys.record_count(F.col("resource"), F.col("payload")).alias("record_count"),
        "resource",
        F.col("key").alias("data_key"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
    )
