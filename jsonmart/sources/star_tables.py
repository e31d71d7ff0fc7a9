"""Star-schema tables as raw payloads: orders become movies, suppliers people, brands genres.

The documents hold the order lines in arrays. An order with very many lines is split into pages,
each a document of its own with the same id and time, so that no task has to gather it whole; the
conforming jobs collect arrays over all documents of an id, so they see no difference, and nothing in
a document depends on its place among the pages.

The payloads hold what real ones hold: later snapshots that differ, credits that were dropped or changed,
people known under several names, blank and quoted numbers, missing ids, and copies of a line.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import fresh_dir

col = F.col

# Lines per document above which an order is split.
DOCUMENT_LINES = 1000
# Lines that one task gathers into documents.
LINES_PER_TASK = 500_000
LISTING_PAGE_SIZE = 20
FIRST_SNAPSHOT = "2024-01-01 00:00:00"

_JSON = {"ignoreNullFields": "false"}

_long: dict[tuple[str, str, int], str] = {}
_long_guard = Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _payload_rows(df: DataFrame, resource: str, tmdb_id: Column, fields: list[Column], key: Column, day: Column):
    first = F.lit(FIRST_SNAPSHOT).cast("timestamp")
    return df.select(
        F.lit(resource).alias("resource"),
        tmdb_id.cast("bigint").alias("tmdb_id"),
        F.to_json(F.struct(*fields), _JSON).alias("payload"),
        key.alias("source_key"),
        (first + F.make_dt_interval(day)).alias("extracted_at"),
        F.lit("tables").alias("dag_run_id"),
    )


def _document_key(snapshot: Column) -> Column:
    base = F.concat(F.lit("k"), snapshot.cast("string"))
    return F.when(col("page") == 0, base).otherwise(F.concat(base, F.lit("-p"), col("page").cast("string")))


def _long_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with more lines than a document takes, and their number of documents.

    Counted and stored once per application and folder. They are few (a thousandth of the lines at most), and Spark
    sees that in the stored table: the lines and orders that are joined with it are not shuffled for it.
    """
    key = (spark.sparkContext.applicationId, sf_dir, DOCUMENT_LINES)
    with _long_guard:
        if key not in _long:
            counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
            path = fresh_dir(spark, "long-orders")
            counts.where(col("n") > DOCUMENT_LINES).select(
                "l_orderkey", F.ceil(col("n") / DOCUMENT_LINES).alias("pages")
            ).write.parquet(path)
            _long[key] = path
    kind = table(spark, sf_dir, "lineitem").schema["l_orderkey"].dataType.simpleString()
    return spark.read.schema(f"l_orderkey {kind}, pages BIGINT").parquet(_long[key])


def _paged_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines, copies too, with the page of the document they belong to; 0 but for long orders.

    Lines go to pages by their place in the table, so copies of one line spread like any others.
    """
    place = F.monotonically_increasing_id().alias("place")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *columns, place)
    page = F.pmod(F.xxhash64("place"), F.coalesce("pages", F.lit(1)))
    long_orders = _long_orders(spark, sf_dir)
    return lines.join(long_orders, "l_orderkey", "left").withColumn("page", page).drop("pages", "place")


def _by_document(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines dealt out by document before they are gathered, to more tasks than the session's where the table is large.

    The lines of an order come apart in the joins before, so gathering below the shuffle would fold nothing: it would
    sort them there and send an array of its own for each line.
    """
    tasks = -(-table(spark, sf_dir, "lineitem").count() // LINES_PER_TASK)
    if tasks <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return lines.repartition("l_orderkey", "page")
    return lines.repartition(tasks, "l_orderkey", "page")


def _paged_orders(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """One row per order and page. The numbers are made in two steps to keep each array short."""
    long_orders = _long_orders(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    last = F.coalesce("pages", F.lit(1)) - 1
    return (
        orders.join(long_orders, "o_orderkey", "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.floor(last / 1000))))
        .withColumn("page", F.explode(F.sequence(col("block") * 1000, F.least(last, col("block") * 1000 + 999))))
        .drop("pages", "block")
    )


def _parts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(col("p_partkey").alias("l_partkey"), *columns)


def _suppliers(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(col("s_suppkey").alias("l_suppkey"), *columns)


def _brand_number(brand: Column) -> Column:
    return F.substring_index(brand, "#", -1).cast("int")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots: one of every order, and a later one of every third with fewer genres and other makers.

    Every fiftieth order has a document without an id besides.
    """
    nation = table(spark, sf_dir, "nation")
    maker = nation.select(
        col("n_nationkey").alias("s_nationkey"),
        col("n_name").alias("maker_nation"),
    )
    lines = (
        _paged_lines(spark, sf_dir, "l_partkey", "l_suppkey")
        .join(_parts(spark, sf_dir, "p_brand"), "l_partkey")
        .join(_suppliers(spark, sf_dir, "s_name", "s_nationkey"), "l_suppkey")
        .join(maker, "s_nationkey")
    )
    genre = F.struct(_brand_number(col("p_brand")).alias("id"), col("p_brand").alias("name"))
    maker_item = F.struct(
        col("l_suppkey").alias("id"), col("s_name").alias("name"), col("maker_nation").alias("origin_country")
    )
    place = F.struct(
        F.concat(F.lit("C"), col("s_nationkey").cast("string")).alias("iso_3166_1"), col("maker_nation").alias("name")
    )
    per_document = _by_document(spark, sf_dir, lines).groupBy(col("l_orderkey").alias("o_orderkey"), "page").agg(
        F.sort_array(F.collect_set(genre)).alias("genres"),
        F.sort_array(F.collect_set(maker_item)).alias("production_companies"),
        F.sort_array(F.collect_set(place)).alias("production_countries"),
    )
    home = nation.join(table(spark, sf_dir, "region"), col("n_regionkey") == col("r_regionkey")).select(
        col("n_nationkey").alias("c_nationkey"), "r_regionkey", "r_name"
    )
    buyers = (
        table(spark, sf_dir, "customer")
        .select(col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
        .join(home, "c_nationkey")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    key = col("o_orderkey")
    snapshots = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # Joined by order and page, as the arrays were grouped: they are not shuffled again, and the
    # pages of a long order stay apart.
    docs = (
        _paged_orders(spark, sf_dir, orders.join(buyers, "o_custkey"))
        .join(per_document, ["o_orderkey", "page"], "left")
        .withColumn("s", F.explode(snapshots))
        .withColumn("no_id", F.explode(F.when(key % 50 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    )
    title = F.concat(F.lit("Order "), key.cast("string"))
    language = F.struct(
        F.concat(F.lit("R"), col("r_regionkey").cast("string")).alias("iso_639_1"),
        col("r_name").alias("english_name"),
        col("r_name").alias("name"),
    )
    no_budget = F.lit(None).cast("bigint")
    # A later snapshot has lost some genres, by genre and order; it names makers longer and their origin shorter.
    kept_genres = F.when(col("s") == 0, col("genres")).otherwise(F.filter("genres", lambda g: (g["id"] + key) % 4 != 0))
    first_only, later_only = F.when(col("s") == 0, " B").otherwise(""), F.when(col("s") == 1, " B").otherwise("")
    makers = F.transform(
        "production_companies",
        lambda m: F.struct(
            m["id"].alias("id"),
            F.concat(m["name"], later_only).alias("name"),
            F.concat(m["origin_country"], first_only).alias("origin_country"),
        ),
    )
    adult = F.when(key % 5 == 0, "true").when(key % 5 == 1, "false")
    fields = [
        F.when(~col("no_id"), key).alias("id"),
        title.alias("title"),
        F.when(key % 7 == 0, F.lit("  ")).otherwise(title).alias("original_title"),
        F.when(key % 11 == 0, F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("release_date"),
        F.when(key % 13 == 0, F.lit("")).otherwise((key % 200).cast("string")).alias("runtime"),
        adult.alias("adult"),
        col("o_orderstatus").alias("status"),
        F.lower("c_mktsegment").alias("original_language"),
        ((key % 1000).cast("decimal(10,0)") / 10).cast("decimal(10,1)").alias("popularity"),
        ((key * 7 % 100).cast("decimal(10,0)") / 10).cast("decimal(10,1)").alias("vote_average"),
        (key * 13 % 2000).alias("vote_count"),
        (F.floor("o_totalprice") + col("s")).alias("revenue"),
        F.when(key % 10 == 0, no_budget).otherwise(key * 37 % 500000).alias("budget"),
        kept_genres.alias("genres"),
        makers.alias("production_companies"),
        col("production_countries"),
        F.array(language).alias("spoken_languages"),
    ]
    source_key = F.concat(_document_key(col("s")), F.when(col("no_id"), "-no-id").otherwise(""))
    return _payload_rows(docs, "movie", key, fields, source_key, col("s"))


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are done are the cast, open ones the crew; both are suppliers.

    Every fourth order has a later snapshot without every third line, and with other roles. A supplier goes by
    several names of different popularity. The first line of every fifth order comes twice more, without a
    credit id and without a person.
    """
    lines = (
        _paged_lines(spark, sf_dir, "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag")
        .join(_parts(spark, sf_dir, "p_name", "p_type"), "l_partkey")
        .join(_suppliers(spark, sf_dir, "s_name", "s_acctbal"), "l_suppkey")
    )
    number = col("l_linenumber")
    odd = F.when((col("l_orderkey") % 5 == 0) & (number == 1), F.array(F.lit(0), F.lit(1), F.lit(2)))
    lines = _by_document(spark, sf_dir, lines).withColumn("odd", F.explode(F.coalesce(odd, F.array(F.lit(0)))))
    credit_id = F.concat_ws("-", col("l_orderkey").cast("string"), number.cast("string"))
    alias = F.concat("s_name", F.lit(" "), number.cast("string"))
    fame = F.when(number % 3 == 1, col("s_acctbal") + number).when(number % 3 == 2, col("s_acctbal"))
    who = {
        "credit_id": F.when(col("odd") == 1, "").otherwise(credit_id),
        "id": F.when(col("odd") != 2, col("l_suppkey")),
        "name": F.when(number % 3 == 1, alias).otherwise(col("s_name")),
        "gender": col("l_suppkey") % 3,
        "known_for_department": F.lit(""),
        "popularity": F.coalesce(fame.cast("decimal(12,2)").cast("string"), F.lit("")),
    }
    lines = lines.select(
        "l_orderkey", "page", "l_linenumber", "l_linestatus", "l_returnflag", "p_name", "p_type", *[c.alias(n) for n, c in who.items()]
    )

    def snapshot(s: int, changed: str) -> Column:
        actor = F.struct(*who, F.concat("p_name", F.lit(changed)).alias("character"), (number - 1).alias("order"))
        helper = F.struct(*who, col("p_type").alias("department"), F.concat("l_returnflag", F.lit(changed)).alias("job"))
        return F.struct(
            F.lit(s).alias("s"),
            F.when(col("l_linestatus") == "F", actor).alias("actor"),
            F.when(col("l_linestatus") == "O", helper).alias("helper"),
        )

    # The items are made where rows are expanded, in generated code; an aggregate evaluates its arguments without.
    first, later = snapshot(0, ""), snapshot(1, " II")
    seen = F.when((col("l_orderkey") % 4 == 0) & (number % 3 != 0), F.array(first, later)).otherwise(F.array(first))
    docs = lines.select("l_orderkey", "page", F.inline(seen)).groupBy("l_orderkey", "page", "s").agg(
        F.sort_array(F.collect_list("actor")).alias("cast"), F.sort_array(F.collect_list("helper")).alias("crew")
    )
    key = col("l_orderkey")
    fields = [key.alias("id"), col("cast"), col("crew")]
    return _payload_rows(docs, "credits", key, fields, _document_key(col("s")), col("s"))


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes as keywords; a size goes by several names."""
    lines = _paged_lines(spark, sf_dir, "l_partkey").join(_parts(spark, sf_dir, "p_size", "p_type"), "l_partkey")
    item = F.struct(col("p_size").alias("id"), col("p_type").alias("name"))
    docs = _by_document(spark, sf_dir, lines).groupBy("l_orderkey", "page").agg(F.sort_array(F.collect_set(item)).alias("keywords"))
    key = col("l_orderkey")
    return _payload_rows(
        docs, "keywords", key, [key.alias("id"), col("keywords")], _document_key(F.lit(0)), F.lit(0)
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail documents of every second supplier; every fourth has a later one, renamed and without a birthday."""
    nation = table(spark, sf_dir, "nation").select(col("n_nationkey").alias("s_nationkey"), "n_name")
    detailed = table(spark, sf_dir, "supplier").where(col("s_suppkey") % 2 == 0).join(nation, "s_nationkey")
    key = col("s_suppkey")
    snapshots = F.when(key % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    detailed = detailed.withColumn("s", F.explode(snapshots))
    born = F.date_add(F.lit("1950-01-01").cast("date"), (key % 20000).cast("int"))
    later = col("s") == 1
    fields = [
        key.alias("id"),
        F.when(later, F.concat("s_name", F.lit(" New"))).otherwise(col("s_name")).alias("name"),
        (key % 3).alias("gender"),
        col("s_acctbal").cast("decimal(12,2)").alias("popularity"),
        F.when(later, "").otherwise(F.date_format(born, "yyyy-MM-dd")).alias("birthday"),
        F.lit("").alias("deathday"),
        col("n_name").alias("place_of_birth"),
        F.lit(None).cast("string").alias("biography"),
    ]
    return _payload_rows(detailed, "person", key, fields, F.concat(F.lit("k"), col("s").cast("string")), col("s"))


def genre_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference list, ten numbers to a document: the brands without those divisible by five.

    Some have a larger name here than in the movies, and each document lists one that no movie has.
    """
    number = _brand_number(col("p_brand"))
    brands = table(spark, sf_dir, "part").select("p_brand", number.alias("number")).distinct().where("number % 5 != 0")
    longer = F.when(col("number") % 5 == 1, " Z").otherwise("")
    padded = F.concat(F.lit("  "), col("p_brand"), longer, F.lit(" "))
    page = F.floor(col("number") / 10)
    listed = F.collect_list(F.struct(col("number").alias("id"), padded.alias("name")))
    unused = F.struct((page + 1000).cast("int").alias("id"), F.lit(" Unused").alias("name"))
    docs = brands.groupBy(page.alias("list")).agg(F.sort_array(listed).alias("genres"), F.first(unused).alias("unused"))
    docs = docs.withColumn("genres", F.concat("genres", F.array("unused")))
    return _payload_rows(docs, "genre", F.lit(0), [col("genres")], F.concat(F.lit("k"), col("list").cast("string")), F.lit(0))


def _listing(spark: SparkSession, sf_dir: str, resource: str, orders: DataFrame) -> DataFrame:
    ids = orders.select(col("o_orderkey").alias("id")).distinct()
    page = F.floor(col("id") / LISTING_PAGE_SIZE) + 1
    pages = ids.groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(F.struct("id"))).alias("results"))
    last = table(spark, sf_dir, "orders").agg(F.floor(F.max("o_orderkey") / LISTING_PAGE_SIZE) + 1).scalar()
    docs = pages.withColumn("total_pages", last)
    fields = [col("page"), col("total_pages"), col("results")]
    key = F.concat(F.lit("page_"), col("page").cast("string"))
    return _payload_rows(docs, resource, col("page"), fields, key, F.lit(0))


def popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 20 orders that are not open."""
    orders = table(spark, sf_dir, "orders").where(col("o_orderstatus") != "O")
    return _listing(spark, sf_dir, "movie_popular", orders)


def top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 20 orders that are not done; orders in progress are on both listings."""
    orders = table(spark, sf_dir, "orders").where(col("o_orderstatus") != "F")
    return _listing(spark, sf_dir, "movie_top_rated", orders)


RAW = {
    "movie": movies,
    "credits": credits,
    "keywords": keywords,
    "person": people,
    "genre": genre_list,
    "movie_popular": popular,
    "movie_top_rated": top_rated,
}


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text documents as landing rows (resource, ingest_date, run_id, name, payload, request_path, http_status).

    The resources take turns, one of them unknown to the catalog. Every text is landed whole; every
    seventh has no id of its own. Beside them come manifests, arrays, and objects without a usable id.
    """
    key = col("doc_id")
    resources = ["genre", "movie_popular", "movie_top_rated", "movie", "credits", "keywords", "person", "configuration"]
    resource = F.element_at(F.array(*[F.lit(r) for r in resources]), (key % 8 + 1).cast("int"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 10).cast("int"))
    items = F.array_join(
        F.transform(F.sequence(F.lit(0), key % 4), lambda i: F.concat(F.lit('{"id":'), i.cast("string"), F.lit("}"))),
        ",",
    )
    own_id = F.when(key % 7 == 0, F.lit("null")).otherwise(key.cast("string"))
    wrapped = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))  # {"t":"..."}
    title = F.substring(wrapped, 6, F.length(wrapped) - 6)
    page = F.concat(F.lit(',"page":'), (key % 50).cast("string"))
    body = F.concat(
        F.lit('{"id":'), own_id, page, F.lit(',"title":'), title,
        *[F.concat(F.lit(f',"{a}":['), items, F.lit("]")) for a in ("genres", "results", "cast", "keywords")],
        F.lit(',"crew":[]}'),
    )
    number = key.cast("string")

    def row(name: Column, payload: Column) -> Column:
        return F.struct(name.alias("name"), payload.alias("payload"))

    no_id = F.concat(F.lit('{"id":null'), page, F.lit("}"))
    rows = F.array_compact(
        F.array(
            row(number, body),
            F.when(key % 9 == 0, row(F.concat(number, F.lit(".manifest")), F.lit("{}"))),
            F.when(key % 6 == 0, row(F.concat(number, F.lit("-list")), F.lit("[1,2]"))),
            F.when(key % 5 == 0, row(F.concat(F.lit("x"), number), no_id)),
        )
    )
    return (
        table(spark, sf_dir, "documents")
        .select(
            resource.alias("resource"),
            day.alias("ingest_date"),
            F.concat(F.lit("manual__"), day.cast("string"), F.lit("T00:00:00+00:00")).alias("run_id"),
            F.concat(F.lit("/"), resource, F.lit("/"), number).alias("request_path"),
            F.element_at(F.array(F.lit(200), F.lit(404), F.lit(None).cast("int"), F.lit(503)), (key % 4 + 1).cast("int")).alias("http_status"),
            F.explode(rows).alias("row"),
        )
        .select("resource", "ingest_date", "run_id", "row.name", "row.payload", "request_path", "http_status")
    )
