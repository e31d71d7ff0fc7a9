"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

The layered queries run on payloads that Spark derives from the whole star-schema tables. The
layers below the asked one are written once per application and folder, in the shared scratch
folder; the asked table itself is returned as a plan.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.jsonx import as_int
from ..functions.values import COMPRESSION, LISTING_PAGES, PEOPLE_CAP
from ..functions.variants import with_variant
from ..operators import sketch
from ..operators.conform import bridge, explode_array, ordered_list
from ..operators.dates import date_dim
from ..operators.pick import latest_by
from ..operators.quality import CheckFailed, ModelChecks, dq_report, gate, orphan_keys
from ..operators.upsert import KeyedTable
from ..scratch import fresh_dir
from ..sources import catalog, landing, star_tables
from ..streaming.incremental import refresh_latest, run_incremental
from . import frontier, questions, silver
from .gold import GOLD
from .layers import Layers
from .questions import QUESTIONS
from .silver import SILVER
from .staging import stage

Query = Callable[[SparkSession, str], DataFrame]
col = F.col
table = star_tables.table

_layers: dict[tuple[str, str], Layers] = {}
_variant_layers: dict[tuple[str, str], Layers] = {}
_landings: dict[tuple[str, str], str] = {}
_streams: dict[tuple[str, str], catalog.Catalog] = {}
_objects: dict[tuple[str, str], str] = {}

RUN_TS = "2024-02-01 00:00:00"

#: Objects that one task writes, a file each.
OBJECTS_PER_TASK = 500


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _layers:
        raw = {r: (lambda build=build: build(spark, sf_dir)) for r, build in star_tables.RAW.items()}
        _layers[key] = Layers(spark, fresh_dir(spark, "layers"), lambda r: raw[r]())
    return _layers[key]


def _stored_payloads(spark: SparkSession, sf_dir: str, form: Callable[[DataFrame], DataFrame]) -> Callable[[str], DataFrame]:
    """The raw payloads by resource, each stored in the given form when it is first asked for."""
    path, stored, guards = fresh_dir(spark, "payloads"), {}, {r: Lock() for r in star_tables.RAW}

    def raw(resource: str) -> DataFrame:
        with guards[resource]:
            if resource not in stored:
                rows = form(star_tables.RAW[resource](spark, sf_dir))
                rows.write.option("compression", COMPRESSION).parquet(f"{path}/{resource}")
                stored[resource] = spark.read.schema(rows.schema).parquet(f"{path}/{resource}")
            return stored[resource]

    return raw


def variant_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers on payloads that are stored as VARIANT: each document is parsed once, when it is stored.

    A resource is stored when a table first asks for it. The staged tables are views of the stored documents.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _variant_layers:
        raw = _stored_payloads(spark, sf_dir, with_variant)
        _variant_layers[key] = Layers(spark, fresh_dir(spark, "variant-layers"), raw, staged_views=True)
    return _variant_layers[key]


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the text documents, landed once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        root = fresh_dir(spark, "landing")
        landing.write_landing(star_tables.landed_documents(spark, sf_dir), root)
        _landings[key] = root
    return _landings[key]


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles with at most six places, timestamps without zone."""
    out = []
    for f in df.schema:
        c, kind = col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "decimal":
            c = F.round(c, 6).cast("double")
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def _silver(name: str) -> Query:
    return lambda spark, sf: present(layers(spark, sf).plan_silver(name))


def _variant_silver(name: str) -> Query:
    return lambda spark, sf: present(variant_layers(spark, sf).plan_silver(name))


def _gold(name: str) -> Query:
    return lambda spark, sf: present(layers(spark, sf).plan_gold(name))


def _question(name: str) -> Query:
    return lambda spark, sf: present(layers(spark, sf).question(name))


def _departments_approx(spark, sf):
    """Sketch estimates differ by engine, so the row says whether each is within a fifth of the exact count."""
    crew = layers(spark, sf).gold("fact_movie_crew")
    exact = questions.departments(crew).toDF("department", "credits", "exact_movies", "exact_people")
    both = questions.departments(crew, approximate=True).drop("credits").withColumnRenamed("department", "named")
    both = exact.join(both, col("department").eqNullSafe(col("named")))

    def close(name: str):
        return (F.abs(col(name) - col(f"exact_{name}")) <= 0.2 * col(f"exact_{name}")).alias(f"{name}_close")

    return both.select("department", "credits", close("movies"), close("people"))


def _rebuilt_movie_analytics(spark, sf):
    """Built from the first snapshots, then again when the later ones have come; equal to the full build.

    The payloads are made once; each build reads and parses those that it sees.
    """
    seen = {"days": 0}
    last = F.lit(star_tables.FIRST_SNAPSHOT).cast("timestamp")
    stored = _stored_payloads(spark, sf, lambda rows: rows)

    def raw(resource):
        rows = stored(resource)
        return rows.where(col("extracted_at") <= last + F.make_dt_interval(F.lit(seen["days"])))

    warehouse = Layers(spark, fresh_dir(spark, "rebuilt"), raw)
    warehouse.build()
    seen["days"] = 1
    warehouse.build()
    return present(warehouse.published("gold/movie_analytics"))


def _movie_genre_current(spark, sf):
    return silver.movie_genre(layers(spark, sf).staged("movie"), current_only=True)


def _cast_rejects(spark, sf):
    ly = layers(spark, sf)
    return silver.cast_rejects(ly.staged("movie"), "movie").union(silver.cast_rejects(ly.staged("person"), "person"))


# ---- operators straight on a table ----------------------------------------------------------


def _latest_event_per_user(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_by(events, ["user_id"], "ts", [col("event_id").desc()])


def _json_prop_stats(spark, sf):
    k = as_int(F.from_json("props", "k STRING")["k"])
    return (
        table(spark, sf, "events")
        .select("event_type", k.alias("k"))
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(col("k").cast("bigint")).alias("sum_k"),
            F.min("k").alias("min_k"),
            F.max("k").alias("max_k"),
            F.count_distinct("k").alias("distinct_k"),
        )
    )


def _conversation_transcript(spark, sf):
    turns = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.floor(col("turn") / 256).alias("part"),
        F.concat_ws(": ", "role", "text").alias("line"),
    )
    return ordered_list(turns, "conv_id", "line", ["turn"], "transcript", sep=" | ", chunk=["part"])


def _event_types_per_user(spark, sf):
    kinds = bridge(table(spark, sf, "events"), "user_id", "event_type")
    return ordered_list(kinds, "user_id", "event_type", ["event_type"], "event_types")


def _distinct_users_sketched(spark, sf):
    """Users per event type from states by day, loaded in two increments with a day in both; exact beside it."""
    events = table(spark, sf, "events")
    by_day = ["event_type", "day"]
    states = sketch.sketched(events.withColumn("day", col("ts").cast("date")), by_day, "user_id")
    stored = KeyedTable(spark, fresh_dir(spark, "states"), "event_type STRING, day DATE, state BINARY", by_day)
    stored.upsert(states.where(F.dayofmonth("day") <= 15))
    stored.upsert(states.where(F.dayofmonth("day") >= 15))
    loaded, whole = (sketch.united(x, ["event_type"], n) for x, n in ((stored.read(), "loaded"), (states, "whole")))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    close = F.abs(col("loaded") - col("users")) <= 4 * sketch.STANDARD_ERROR * col("users")
    both = exact.join(loaded, "event_type").join(whole, "event_type")
    return both.select("event_type", "users", close.alias("close"), (col("loaded") == col("whole")).alias("same"))


def _order_dates(spark, sf):
    return date_dim(table(spark, sf, "orders").select(col("o_orderdate").cast("date").alias("d")), "d")


_EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _upsert_events(spark, sf):
    """First half of the month, then the second two thirds with doubled values, then that again."""
    events = _events(spark, sf)
    target = KeyedTable(spark, fresh_dir(spark, "events"), _EVENT_SCHEMA, ["event_id"])
    target.upsert(events.where(F.dayofmonth("ts") <= 15))
    later = events.where(F.dayofmonth("ts") >= 10).withColumn("value", col("value") * 2)
    target.upsert(later)
    target.upsert(later)
    return target.read()


def _one_key_upsert(spark, sf):
    """A table of 128 parts that grew to them; a new value for one key rewrites one directory, the rest stays as it is."""
    events = _events(spark, sf)
    rows = events.count()
    target = KeyedTable(spark, fresh_dir(spark, "events"), _EVENT_SCHEMA, ["event_id"], part_rows=max(1, rows // 100))
    target.upsert(events.where("event_id % 50 = 0"))
    first = target.parts()
    target.upsert(events)
    before = target.files()
    one = events.agg(F.min_by(F.struct(*events.columns), "event_id").alias("e")).select("e.*")
    target.upsert(one.withColumn("value", F.lit(-1.0)))
    after = target.files()
    rewritten = {(before | after)[f] for f in before.keys() ^ after.keys()}
    grown = F.lit(target.parts() > first).alias("grown")
    return target.read().agg(F.count(F.lit(1)).alias("events"), F.count_if(col("value") == -1.0).alias("changed")).select(
        "events", "changed", grown, F.lit(target.parts()).alias("parts"), F.lit(len(rewritten)).alias("rewritten")
    )


def _replace_events(spark, sf):
    """A full refresh leaves nothing of the rows before it."""
    events = _events(spark, sf)
    target = KeyedTable(spark, fresh_dir(spark, "events"), _EVENT_SCHEMA, ["event_id"])
    target.upsert(events.withColumns({"event_id": col("event_id") - 1, "value": F.lit(-1.0)}))
    target.replace(events)
    return target.read()


def _incremental_equals_full(spark, sf):
    """Latest event per user in three loads by watermark; the same as one load of everything."""
    events = _events(spark, sf)
    target = KeyedTable(
        spark, fresh_dir(spark, "latest"), "user_id BIGINT, loaded_at TIMESTAMP_NTZ, event_id BIGINT", ["user_id"]
    )

    def conform(df):
        latest = latest_by(df, ["user_id"], "ts", [col("event_id").desc()])
        return latest.select("user_id", col("ts").alias("loaded_at"), "event_id")

    for last_day in (10, 20, 31):
        seen = events.where(F.dayofmonth("ts") <= last_day).withColumn("extracted_at", col("ts"))
        refresh_latest(seen, target, conform)
    return target.read()


def _incremental_movie(spark, sf):
    """Movies snapshot by snapshot through the watermark; equal to the full build."""
    staged = layers(spark, sf).staged("movie")
    schema = silver.movie(staged).schema
    target = KeyedTable(spark, fresh_dir(spark, "movie"), schema, ["movie_id"])
    first = F.lit(star_tables.FIRST_SNAPSHOT).cast("timestamp")
    refresh_latest(staged.where(col("extracted_at") <= first), target, silver.movie)
    refresh_latest(staged, target, silver.movie)
    return present(target.read())


def _reprocessed_movie(spark, sf):
    """The older snapshot arrives after the newer one; its ids are conformed again."""
    staged = layers(spark, sf).staged("movie")
    target = KeyedTable(spark, fresh_dir(spark, "movie"), silver.movie(staged).schema, ["movie_id"])
    first = F.lit(star_tables.FIRST_SNAPSHOT).cast("timestamp")
    refresh_latest(staged.where(col("extracted_at") > first), target, silver.movie)
    late = staged.where(col("extracted_at") <= first)
    refresh_latest(staged, target, silver.movie, late="reprocess", arrived=late)
    return present(target.read())


def _incremental_person(spark, sf):
    """People are recomputed in full and merged by id."""
    full = layers(spark, sf).plan_silver("person")
    target = KeyedTable(spark, fresh_dir(spark, "person"), full.schema, ["person_id"])
    target.upsert(full.withColumn("name", F.when(col("person_id") % 3 == 0, "stale").otherwise(col("name"))))
    target.upsert(full, changed_only=True)
    return present(target.read())


# ---- landing and catalog ---------------------------------------------------------------------


def _landed(spark, sf, **run):
    return landing.read_landing(spark, landing_root(spark, sf), **run)


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def _catalog_registry(spark, sf):
    return present(catalog.registry(_landed(spark, sf), "landing", _run_ts()))


def _raw_payload_ids(spark, sf):
    rows = catalog.raw_payloads(_landed(spark, sf), _run_ts())
    return present(rows.select("resource", "tmdb_id", "source_key", F.sha2("payload", 256).alias("payload_hash"),
                               "extracted_at", "dag_run_id"))


def _quarantine(spark, sf):
    return catalog.quarantine(_landed(spark, sf))


def _record_counts(spark, sf):
    return landing.audit(_landed(spark, sf), _run_ts()).select("data_key", "resource", "record_count", "bytes")


def _run_counts(spark, sf):
    return catalog.run_counts(_landed(spark, sf))


def _audit(spark, sf):
    return present(landing.audit(_landed(spark, sf), _run_ts()))


def _run_manifests(spark, sf):
    """Stored for one half of the days, then again for all with a later count; one manifest per run stays."""
    manifests, path = catalog.run_manifests(_landed(spark, sf), _run_ts()), fresh_dir(spark, "manifests")
    even = F.dayofmonth("ingest_date") % 2 == 0
    catalog.write_manifests(manifests.where(even).withColumn("counts", F.create_map(F.lit("listed"), F.lit(-1).cast("bigint"))), path)
    catalog.write_manifests(manifests, path)
    stored = catalog.read_manifests(spark, path, manifests.schema)
    return present(stored.select("ingest_date", "run_id", "extracted_at", F.explode("counts").alias("name", "n")))


def _observed_run_counts(spark, sf):
    """Two catalog runs, the even days and then all; each returns what it saw while it wrote."""
    landed, cat = _landed(spark, sf), catalog.Catalog(spark, fresh_dir(spark, "observed"))
    even = landed.where(F.dayofmonth("ingest_date") % 2 == 0)
    counts = [(run, cat.add(rows, _run_ts())) for run, rows in (("even days", even), ("all days", landed))]
    values = [(run, *[c[n] for n in catalog.COUNT_NAMES]) for run, c in counts]
    return spark.createDataFrame(values, "run STRING, " + ", ".join(f"{n} BIGINT" for n in catalog.COUNT_NAMES))


def _landed_texts(spark, sf):
    """The texts inside the payloads are those of the table, in every character and byte."""
    title = F.get_json_object("payload", "$.title")
    return _landed(spark, sf).where(title.isNotNull()).select(
        "key", F.sha2(title, 256).alias("text_hash"), F.length(title).alias("chars"), F.octet_length(title).alias("utf8_bytes")
    )


def _supplier_objects(spark, sf) -> str:
    """Folder with suppliers as one JSON document per file, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _objects:
        number = col("s_suppkey")
        rows = table(spark, sf, "supplier").select(
            number.alias("id"),
            F.concat("s_name", F.lit(" é")).alias("name"),
            F.date_add(F.lit("2024-01-01").cast("date"), (number % 3).cast("int")).alias("ingest_date"),
            F.concat(F.lit("run-"), number % 2).alias("run_id"),
        )
        root = fresh_dir(spark, "objects")
        # A file takes far longer than a row to write, and the table is one split: the rows are dealt out first, and
        # each task moves its files into place itself, where the default leaves all of them to the driver.
        dealt = rows.repartition(max(1, -(-rows.count() // OBJECTS_PER_TASK)))
        one_each = dealt.write.option("maxRecordsPerFile", 1).partitionBy("ingest_date", "run_id")
        one_each.option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(f"{root}/tmdb/person")
        _objects[key] = root
    return _objects[key]


def _object_files(spark, sf):
    """The supplier objects, read back whole."""
    objects = landing.read_objects(spark, _supplier_objects(spark, sf)).where(col("filename").startswith("part-"))
    return objects.select("resource", "ingest_date", "run_id", "payload", "bytes", "etag")


def _object_registry(spark, sf):
    """The supplier objects by a listing; a second run finds nothing to read and changes nothing."""
    root, cat = _supplier_objects(spark, sf), catalog.Catalog(spark, fresh_dir(spark, "listed"))
    counts = [cat.add_objects(root, _run_ts()) for _ in range(2)]
    rows = cat.ingest_objects.read().select("resource", "ingest_date", "dag_run_id", "bytes", "etag", "loaded_at")
    return present(rows.withColumns({f"listed_{k}": F.lit(c["listed"]).cast("bigint") for k, c in enumerate(counts, start=1)}))


def _run_scan(spark, sf):
    run = {"ingest_date": "2024-01-04", "run_id": "manual__2024-01-04T00:00:00+00:00"}
    return _landed(spark, sf, **run).select("key", "filename", "bytes")


def _key_roundtrip(spark, sf):
    parts = keys.key_parts(col("key"))
    return _landed(spark, sf).select("key", parts.alias("p"), keys.is_manifest(col("key")).alias("manifest")).select(
        "key", "p.*", "manifest"
    )


def _key_rejects(spark, sf):
    """Keys of other shapes among good ones: the parser gives no parts for them."""
    doc = col("doc_id")
    key = keys.object_key(F.lit("movie"), F.lit("2024-01-01"), F.lit("r"), doc.cast("string"))
    broken = (
        F.when(doc % 5 == 1, F.concat(F.lit("other/"), key))
        .when(doc % 5 == 2, F.replace(key, F.lit("run_id="), F.lit("run=")))
        .when(doc % 5 == 3, F.substring_index(key, "/", 4))
        .otherwise(key)
    )
    documents = table(spark, sf, "documents").select(broken.alias("key"))
    rejected = keys.key_parts(col("key")).isNull().alias("rejected")
    return documents.select("key", rejected)


def _json_sink(spark, sf):
    """Customers landed as structs and read back as the text in the files."""
    customer = table(spark, sf, "customer")
    payload = F.struct(
        col("c_custkey").alias("id"),
        col("c_name").alias("name"),
        F.when(col("c_nationkey") > 4, col("c_nationkey")).alias("nation"),
    )
    rows = customer.select(
        F.lit("person").alias("resource"),
        F.lit("2024-01-01").alias("ingest_date"),
        F.lit("run 1").alias("run_id"),
        col("c_custkey").cast("string").alias("name"),
        payload.alias("payload"),
    )
    root = fresh_dir(spark, "sink")
    landing.write_landing(rows, root)
    return landing.read_landing(spark, root).select("key", "payload", "bytes")


def _stream(spark, sf) -> catalog.Catalog:
    """The catalog built by a file stream, twice over the same checkpoint."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _streams:
        root, work = landing_root(spark, sf), fresh_dir(spark, "stream")
        cat = catalog.Catalog(spark, f"{work}/catalog")
        for _ in range(2):
            stream = landing.read_landing_stream(spark, root)
            run_incremental(stream, cat, f"{work}/checkpoint", _run_ts)
        _streams[key] = cat
    return _streams[key]


def _stream_catalog(spark, sf):
    rows = _stream(spark, sf).raw_payloads.read()
    return present(rows.select("resource", "tmdb_id", "source_key", "extracted_at", "dag_run_id"))


def _stream_registry(spark, sf):
    return present(_stream(spark, sf).ingest_objects.read())


# ---- checks ----------------------------------------------------------------------------------

STAR_CHECKS = (
    ModelChecks("orders", ("o_orderkey", "o_custkey"), ("o_orderkey",), (("o_custkey", "customer", "c_custkey"),)),
    ModelChecks(
        "lineitem",
        ("l_orderkey", "l_linenumber"),
        ("l_orderkey", "l_linenumber"),
        (
            ("l_orderkey", "orders", "o_orderkey"),
            ("l_partkey", "part", "p_partkey"),
            ("l_suppkey", "supplier", "s_suppkey"),
        ),
    ),
    ModelChecks("customer", ("c_custkey",), ("c_custkey",), (("c_nationkey", "nation", "n_nationkey"),)),
    ModelChecks("nation", ("n_nationkey", "n_name"), ("n_nationkey",), (("n_regionkey", "region", "r_regionkey"),)),
    ModelChecks("labels", ("doc_id",), ("doc_id",), (("doc_id", "documents", "doc_id"),)),
)


def _dq_report(spark, sf):
    names = ("orders", "lineitem", "customer", "nation", "region", "part", "supplier", "labels", "documents")
    return dq_report({n: table(spark, sf, n) for n in names}, STAR_CHECKS)


def _catalog_dq_report(spark, sf):
    landed = _landed(spark, sf)
    tables = {
        "ingest_objects": catalog.registry(landed, "landing", _run_ts()),
        "raw_payloads": catalog.raw_payloads(landed, _run_ts()),
    }
    return dq_report(tables, catalog.CATALOG_CHECKS)


def _planted(spark, sf):
    """Orders, customers and nations with missing, repeated and dangling keys, for checks that have to fire."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    key = col("o_orderkey")
    orders = orders.select(
        F.when(key % 7 != 0, key).alias("o_orderkey"), F.when(key % 11 != 0, col("o_custkey")).alias("o_custkey")
    ).union(orders.where(key % 5 == 0))
    customers = table(spark, sf, "customer").where("c_custkey % 3 != 0").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").where("n_nationkey > 4").select("n_nationkey", F.nullif("n_name", F.lit("JAPAN")).alias("n_name"))
    return {"orders": orders, "customer": customers, "nation": nations}


PLANTED_CHECKS = (
    ModelChecks("orders", ("o_orderkey", "o_custkey"), ("o_orderkey",), (("o_custkey", "customer", "c_custkey"),)),
    ModelChecks("customer", ("c_custkey",), ("c_custkey",), (("c_nationkey", "nation", "n_nationkey"),)),
    ModelChecks("nation", ("n_nationkey", "n_name"), ("n_nationkey",)),
)


def _planted_dq_report(spark, sf):
    return dq_report(_planted(spark, sf), PLANTED_CHECKS)


def _gate_failures(spark, sf):
    """What the gate reports when it stops a run."""
    try:
        gate(_planted_dq_report(spark, sf))
    except CheckFailed as e:
        return spark.createDataFrame([tuple(r) for r in e.rows], "model STRING, test STRING, target STRING, failures BIGINT")
    raise AssertionError("the gate let a failing report pass")


def _planted_cast_rejects(spark, sf):
    """Orders as documents with texts that no cast can read, and some of another shape."""
    key = col("o_orderkey")
    bad = {"release_date": 3, "runtime": 5, "popularity": 7, "vote_average": 11, "vote_count": 13, "budget": 17, "revenue": 19, "adult": 23}
    fields = [F.when(key % 29 == 0, "no number").otherwise(key.cast("string")).alias("id")]
    fields += [F.when(key % n == 0, "unreadable").otherwise("").alias(name) for name, n in bad.items()]
    shape = F.when(key % 31 == 0, F.array(F.lit("text"))).alias("genres")
    docs = table(spark, sf, "orders").select(
        F.lit("movie").alias("resource"),
        key.alias("tmdb_id"),
        F.to_json(F.struct(*fields, shape)).alias("payload"),
        F.lit("k").alias("source_key"),
        _run_ts().alias("extracted_at"),
        F.lit("planted").alias("dag_run_id"),
    )
    return silver.cast_rejects(stage(docs, "movie"), "movie")


def _orphan_keys(spark, sf):
    """Documents without a label, through the operator behind the relationship check."""
    return orphan_keys(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id")


# ---- frontier --------------------------------------------------------------------------------


def _frontier_listing(resource: str) -> Query:
    return lambda spark, sf: frontier.listing_ids(layers(spark, sf).staged(resource))


def _frontier_ids(spark, sf, max_pages=None):
    ly = layers(spark, sf)
    return frontier.movie_ids(ly.staged("movie_popular"), ly.staged("movie_top_rated"), max_pages)


def _frontier_first_pages(spark, sf):
    return _frontier_ids(spark, sf, max_pages=LISTING_PAGES)


def _frontier_people(spark, sf):
    return frontier.people_ids(layers(spark, sf).staged("credits"))


def _frontier_people_cap(spark, sf):
    return frontier.cap(_frontier_people(spark, sf), PEOPLE_CAP)


def _frontier_people_first(spark, sf):
    """A cap below the number of people at any size."""
    return frontier.cap(_frontier_people(spark, sf), 7)


def _page_names(spark, sf):
    staged = layers(spark, sf).staged("movie_popular")
    return staged.select(
        keys.page_name(col("page").cast("int")).alias("name"), F.coalesce(F.size("results"), F.lit(0)).alias("results")
    )


def _payload_keywords(spark, sf):
    """Array expansion alone: the distinct keyword entries of every movie."""
    staged = layers(spark, sf).staged("keywords")
    items = explode_array(staged, "keywords", ["id", "name"], [col("id").alias("movie_key")])
    return items.distinct().groupBy("movie_key").agg(F.count(F.lit(1)).alias("entries"), F.max("name").alias("last_name"))


QUERIES: dict[str, Query] = {
    **{f"silver_{n}": _silver(n) for n in SILVER},
    **{f"variant_silver_{n}": _variant_silver(n) for n in SILVER},
    "silver_movie_genre_current": _movie_genre_current,
    "cast_rejects": _cast_rejects,
    **{n: _gold(n) for n in GOLD},
    **{n: _question(n) for n in QUESTIONS},
    "q5_departments_approx": _departments_approx,
    "latest_event_per_user": _latest_event_per_user,
    "json_prop_stats": _json_prop_stats,
    "conversation_transcript": _conversation_transcript,
    "event_types_per_user": _event_types_per_user,
    "order_dates": _order_dates,
    "payload_keywords": _payload_keywords,
    "upsert_events": _upsert_events,
    "replace_events": _replace_events,
    "incremental_equals_full": _incremental_equals_full,
    "incremental_movie": _incremental_movie,
    "reprocessed_movie": _reprocessed_movie,
    "incremental_person": _incremental_person,
    "catalog_registry": _catalog_registry,
    "raw_payload_ids": _raw_payload_ids,
    "quarantine": _quarantine,
    "record_counts": _record_counts,
    "audit": _audit,
    "landed_texts": _landed_texts,
    "object_files": _object_files,
    "run_counts": _run_counts,
    "run_manifests": _run_manifests,
    "observed_run_counts": _observed_run_counts,
    "object_registry": _object_registry,
    "one_key_upsert": _one_key_upsert,
    "distinct_users_sketched": _distinct_users_sketched,
    "run_scan": _run_scan,
    "key_roundtrip": _key_roundtrip,
    "key_rejects": _key_rejects,
    "json_sink": _json_sink,
    "stream_catalog": _stream_catalog,
    "stream_registry": _stream_registry,
    "dq_report": _dq_report,
    "catalog_dq_report": _catalog_dq_report,
    "planted_dq_report": _planted_dq_report,
    "gate_failures": _gate_failures,
    "planted_cast_rejects": _planted_cast_rejects,
    "rebuilt_movie_analytics": _rebuilt_movie_analytics,
    "orphan_keys": _orphan_keys,
    "silver_dq_report": lambda spark, sf: layers(spark, sf).silver_report(),
    "gold_dq_report": lambda spark, sf: layers(spark, sf).gold_report(),
    "frontier_popular": _frontier_listing("movie_popular"),
    "frontier_top_rated": _frontier_listing("movie_top_rated"),
    "frontier_ids": _frontier_ids,
    "frontier_first_pages": _frontier_first_pages,
    "frontier_people": _frontier_people,
    "frontier_people_cap": _frontier_people_cap,
    "frontier_people_first": _frontier_people_first,
    "page_names": _page_names,
}
