"""N-gram Jaccard self-join by vertical partitioning, down to components of linked documents.

All n-grams get one global order, rare ones first. The order is cut into fragments, and every
document's set is cut along it. Two documents that link must share an n-gram among the first few of both
sets (their prefixes), which proposes pairs; for a proposed pair the overlap is counted in each fragment
on its own, and the partial counts are summed per pair and compared with the exact bound.

Groups of copies stay small: equal sets are one class from the start. In a group of near copies pairs are
proposed only against a few pivots per round, and only between documents that earlier rounds have not
connected; what is still apart after that is proposed in full, and no pair is counted twice. Of those, each
component's closest pair is counted first, in two waves, and then the pairs that are still between components. So no
link between components is lost, and a group of m near copies costs some m pairs instead of m * m / 2.

Proposing. Linked sets share not one n-gram of their prefixes but many. Within the prefixes, n-grams are put in order
once more, by the exact number of prefixes that hold them. The first one that two prefixes share must have as many n-grams
from it on, in either, as linked prefixes share; where it has fewer, the pair is not proposed.

Counting. Two exact bounds rule out pairs before any set is fetched. The overlap of the prefixes, the first partial
count, rules out pairs that share no more than a passage. Parities rule out most of the rest: every set has one bit for each of
some buckets, telling whether it holds an odd number of the bucket's n-grams. Where the bits of two sets differ, the sets differ in
at least one n-gram, and linked sets differ in few. A longer row of bits folds onto a shorter one, so each set has bits
by its own size, and after the first round the bits folded onto 256 buckets already keep pairs from being proposed. Only the documents of the pairs that are left are cut into segments. Within a fragment 32 bits stand for an
n-gram. Equal bits of different n-grams can add to a count, or, within one set, take from it; a pair so near the bound, on
either side, that this could matter is counted again with all 63. The margin grows with the fragments.

Order. N-grams are counted over all documents in 65,536 hash buckets; a bucket's rank by count, then
the hash, is the place of an n-gram. Any fixed order gives the same links; this one keeps common passages
out of the prefixes. The table of ranks is the only thing the driver gathers, and its size is fixed.

Defined cases. Null or wordless text: 0 shingles, linked with nothing. Fewer than n words: the whole
sequence is the only shingle. Repeated rows and repeated ids: each distinct text is a document of its own
and ``component_id`` is the smallest id in the component; texts known only under a null id are found
by their hash. Hash values stand for n-grams (63 bits).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, free_name, saved
from .components import connected_components
from .shingles import shingle_set

_BUCKETS = 1 << 16
_SIGNS = 4  # longs that the parities of every set fold onto
_WAVES = 2  # times that components are joined by their closest pairs before all others are counted


@dataclass(frozen=True)
class JaccardJoin:
    """Links documents when 100 * intersection >= percent * union of their n-word shingles."""

    n: int = 5
    percent: int = 80
    fragments: int = 16
    pivot_rounds: int = 2


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))


def _ranks(texts: DataFrame, n: int) -> np.ndarray:
    """Rank of every hash bucket by its count over all documents; the order's fixed-size table."""

    def count(batches):
        total = np.zeros(_BUCKETS, dtype=np.int64)
        for batch in batches:
            sets = [shingle_set(t, n) for t in batch.column(0).to_pylist()]
            if sets:
                total += np.bincount((np.concatenate(sets) % _BUCKETS).astype(np.int64), minlength=_BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["bucket", "n"])

    counts = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(_BUCKETS, dtype=np.int64)
    for row in counts.collect():  # 65,536 rows at most
        total[row.bucket] = row.n
    ranks = np.empty(_BUCKETS, dtype=np.uint64)
    ranks[np.argsort(total, kind="stable")] = np.arange(_BUCKETS, dtype=np.uint64)
    return ranks


def _places(text: bytes | None, n: int, ranks: np.ndarray) -> np.ndarray:
    """The set of a text as sorted places in the global order (long, not negative)."""
    hashes = shingle_set(text, n)
    low = hashes % np.uint64(_BUCKETS)
    return np.sort(((ranks[low.astype(np.int64)] << np.uint64(47)) | (hashes >> np.uint64(17))).astype(np.int64))


def _parities(places: np.ndarray) -> np.ndarray:
    """For each bucket, by the low bits of a place, whether it holds an odd number of places; 64 buckets in each long.

    The buckets are a power of two, at least 256 and no fewer than the places.
    """
    buckets = max(64 * _SIGNS, 1 << max(0, len(places) - 1).bit_length())
    low = places & np.int64(buckets - 1)
    bits = np.zeros(buckets // 64, dtype=np.uint64)
    np.bitwise_xor.at(bits, low >> 6, np.uint64(1) << (low & 63).astype(np.uint64))
    return bits.view(np.int64)


def _list_array(parts: list[np.ndarray], width=np.int64) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, dtype=width)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _members(texts: DataFrame, spec: JaccardJoin, ranks) -> DataFrame:
    """One row per document: size of its set, the set's fingerprint (null: no words), its prefix and parities."""

    def describe(batches):
        for batch in batches:
            sizes, prints, prefixes, parities = [], [], [], []
            for text in batch.column("text").to_pylist():
                places = _places(text, spec.n, ranks.value)
                size = len(places)
                sizes.append(size)
                prints.append(xxhash.xxh3_128_digest(places.tobytes()) if size else None)
                # a partner shares at least ceil(percent * size / 100), so one of the first that may be missing + 1
                prefixes.append(places[: size - -(-spec.percent * size // 100) + 1])
                parities.append(_parities(places))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(prints, pa.binary()), _list_array(prefixes), _list_array(parities)],
                ["doc_id", "text_hash", "n_shingles", "print", "prefix", "parities"],
            )

    schema = "doc_id long, text_hash long, n_shingles long, print binary, prefix array<long>, parities array<long>"
    return texts.mapInArrow(describe, schema)


def _segments(texts: DataFrame, wanted: DataFrame, spec: JaccardJoin, ranks, wide: bool) -> DataFrame:
    """(cid, fragment, places) of the wanted classes; ``wanted`` has cid, print, doc_id and text_hash of one copy.

    A class may come more than once, if its text does.
    """
    borders = np.array([(k << 63) // spec.fragments for k in range(1, spec.fragments)], dtype=np.int64)
    width = np.int64 if wide else np.int32

    def cut(batches):
        for batch in batches:
            ids, fragments, parts = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("cid", "print", "text")), strict=True)
            for cid, fingerprint, text in rows:
                places = _places(text, spec.n, ranks.value)
                if xxhash.xxh3_128_digest(places.tobytes()) != fingerprint:
                    continue  # another text under the same id
                edges = np.searchsorted(places, borders)
                for fragment, part in enumerate(np.split(places.astype(width), edges)):
                    if len(part):
                        ids.append(cid)
                        fragments.append(fragment)
                        parts.append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(fragments, pa.int32()), _list_array(parts, width)],
                ["cid", "fragment", "places"],
            )

    found = texts.join(checked_broadcast(wanted.drop("text_hash")), "doc_id").select("cid", "print", "text")
    nameless = wanted.where("doc_id IS NULL").select("cid", "print", "text_hash")
    if not nameless.isEmpty():
        # such a text may be repeated without end, so one of its rows is picked before it is cut
        rows = texts.where("doc_id IS NULL").join(checked_broadcast(nameless), "text_hash")
        found = found.union(rows.groupBy("cid", "print").agg(F.first("text").alias("text")))
    return found.mapInArrow(cut, f"cid long, fragment int, places array<{'long' if wide else 'int'}>")


def _need(percent: int) -> Column:
    """How many n-grams linked sets of n_a and n_b share at least."""
    return F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100.0 + percent) - 1e-9)


def _prefix_need(percent: int) -> Column:
    """How many n-grams the prefixes of linked sets share at least.

    Sets that share ``need`` n-grams share k of their first size - need + k; the prefixes are so long for this k.
    """
    return _need(percent) + 1 - F.ceil(percent * F.greatest("n_a", "n_b") / 100)


def _signs() -> list[Column]:
    """The parities folded onto 256 buckets, in four columns; read where pairs are proposed."""

    def fold(k: int) -> Column:
        every_fourth = F.filter("parities", lambda bits, i: i % _SIGNS == k)
        return F.aggregate(every_fourth, F.lit(0).cast("long"), lambda total, bits: total.bitwiseXOR(bits))

    return [fold(k).alias(f"sign{k}") for k in range(_SIGNS)]


def _compatible(percent: int):
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return 100 * small >= percent * large


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("grp", *[F.col(c).alias(f"{c}_{name}") for c in rows.columns if c != "grp"])


def _apart(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Pairs of one group that are not connected yet, once each, the smaller class number first.

    The first n-gram that the prefixes of linked sets share is followed, in either prefix, by as many as they must
    share. Two sets that both come with the next size step have met with their own. Where the rows have signs, pairs
    go whose signs differ in more n-grams than linked sets do. Where they have ``main``, only rows inside the main
    component are not on the left.
    """
    met = _side(left, "a").join(_side(right, "b"), "grp").where(F.col("root_a") != F.col("root_b"))
    met = met.where(_compatible(percent)).where(~(F.col("up_a") & F.col("up_b")))
    met = met.where(F.least("left_a", "left_b") >= _prefix_need(percent))
    if "main" in left.columns:
        met = met.where(F.col("main_b") | (F.col("cid_a") < F.col("cid_b")))
    distance = F.lit(0)
    if "sign0" in left.columns:
        differing = [F.bit_count(F.col(f"sign{k}_a").bitwiseXOR(F.col(f"sign{k}_b"))) for k in range(_SIGNS)]
        distance = sum(differing[1:], differing[0])
        met = met.where(distance <= F.col("n_a") + F.col("n_b") - 2 * _need(percent))
    first = F.col("cid_a") < F.col("cid_b")
    return met.select(
        F.least("cid_a", "cid_b").alias("a"),
        F.greatest("cid_a", "cid_b").alias("b"),
        F.when(first, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(first, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
        distance.alias("distance"),
    ).distinct()


def _overlaps(pairs: DataFrame, texts: DataFrame, classes: DataFrame, spec: JaccardJoin, ranks, wide: bool) -> DataFrame:
    """``pairs`` (a, b, n_a, n_b) with ``spare``: by how much 100 * shared exceeds the bound.

    Partial overlaps are counted in each fragment and summed per pair. The side that comes in more pairs is
    fetched last, as it is the smaller table.
    """
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid")))
    times = saved(ends.groupBy("cid").count(), "ends")
    wanted = saved(classes.join(times, "cid").select("cid", "print", "doc_id", "text_hash"), "wanted")
    segments = saved(_segments(texts, wanted, spec, ranks, wide), "segments")
    times = checked_broadcast(times)
    known = pairs
    for end in ("a", "b"):
        known = known.join(times.select(F.col("cid").alias(end), F.col("count").alias(f"times_{end}")), end)
    swap = F.col("times_a") < F.col("times_b")
    known = known.select(
        "a", "b", "n_a", "n_b",
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("often"),
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("rare"),
    )
    hubs = checked_broadcast(saved(known.select(F.col("often").alias("cid")).distinct(), "hubs"))
    one = segments.select(F.col("cid").alias("rare"), "fragment", F.col("places").alias("places_r"))
    two = segments.join(hubs, "cid", "left_semi").select(F.col("cid").alias("often"), "fragment", F.col("places").alias("places_o"))
    partial = known.join(one, "rare").join(two, ["often", "fragment"])
    shared = F.size(F.array_intersect("places_r", "places_o")).alias("shared")
    partial = partial.select("a", "b", "n_a", "n_b", "fragment", shared)
    partial = partial.groupBy("a", "b", "n_a", "n_b", "fragment").agg(F.max("shared").alias("shared"))  # copies of a text
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return total.select("a", "b", "n_a", "n_b", (100 * F.col("shared") - spec.percent * union).alias("spare"))


def _least_difference(one: str, two: str) -> Column:
    """In how many n-grams two sets differ at least, by their parities.

    Sizes of linked sets differ by less than two times, so one of the two is folded once at most; others
    give no pair.
    """

    def folded(bits: Column, other: Column) -> Column:
        half = (F.size(bits) / 2).cast("int")
        halves = F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half)
        return F.when(F.size(bits) > F.size(other), F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))).otherwise(bits)

    a, b = F.col(one), F.col(two)
    differing = F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differing, F.lit(0), lambda total, bits: total + bits)


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes share as many n-grams, and whose parities differ as little, as those of linked documents must.

    Sets that share ``need`` n-grams share k of their first size - need + k; the prefixes are so long for the k below.
    They differ in n_a + n_b - 2 * need n-grams at most.
    """
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
    prefixes = classes.join(checked_broadcast(saved(ends, "ends")), "cid", "left_semi").select("cid", "prefix", "parities")
    met = pairs
    for end in ("a", "b"):
        columns = [F.col(c).alias(f"{c}_{end}") for c in ("prefix", "parities")]
        met = met.join(prefixes.select(F.col("cid").alias(end), *columns), end)
    need = _need(percent)
    spare = [F.size(f"prefix_{e}") - F.col(f"n_{e}") + need for e in ("a", "b")]
    shared = F.size(F.array_intersect("prefix_a", "prefix_b"))
    alike = _least_difference("parities_a", "parities_b") <= F.col("n_a") + F.col("n_b") - 2 * need
    return saved(met.where(alike & (shared >= F.least(*spare))).select("a", "b", "n_a", "n_b"), "promising")


def _linked(pairs: DataFrame, texts: DataFrame, classes: DataFrame, spec: JaccardJoin, ranks) -> DataFrame:
    """The pairs that link."""
    pairs = _promising(pairs, classes, spec.percent)
    # two n-grams by which a count may be off, and as many again as two sets of this size have by chance in all fragments
    chance = (F.col("n_a") + F.col("n_b")) * (F.col("n_a") + F.col("n_b")) / float(spec.fragments << 31)
    margin = (100 + spec.percent) * (2 + F.ceil(4 * chance))
    near = _overlaps(pairs, texts, classes, spec, ranks, wide=False).withColumn("margin", margin)
    near = saved(near.where("spare >= -margin"), "near")
    sure, close = near.where("spare >= margin"), near.where("spare < margin").drop("margin")
    links = sure.select("a", "b")
    if not close.isEmpty():
        again = _overlaps(close.drop("spare"), texts, classes, spec, ranks, wide=True)
        links = links.union(again.where("spare >= 0").select("a", "b"))
    return saved(links, "links")


def _pivot_order(turn: int) -> Column:
    """Pivots are first the sets with most common n-grams in their prefixes, then any."""
    return F.struct(F.lit(0) if turn else -F.col("left"), F.xxhash64("cid", F.lit(turn)))


def _still_open(rows: DataFrame) -> DataFrame:
    """Rows of the groups that hold more than one component; ``main``: the row is of its group's first pivot's."""
    first = F.min_by("root", _pivot_order(0)).alias("first")
    roots = rows.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high"), first)
    rows = rows.join(roots.where("low != high").select("grp", "first"), "grp")
    return rows.withColumn("main", F.col("root") == F.col("first")).drop("first")


def _merge(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """(cid, root) after connecting the components that ``links`` join; classes without links have no row."""
    if links.isEmpty():
        return roots
    if roots is None:
        return connected_components(links).select(F.col("node").alias("cid"), "root")
    ends = links
    for end in ("a", "b"):
        known = roots.select(F.col("cid").alias(end), F.col("root").alias(f"r_{end}"))
        ends = ends.join(known, end, "left").withColumn(f"r_{end}", F.coalesce(f"r_{end}", end))
    merged = saved(connected_components(ends.select(F.col("r_a").alias("a"), F.col("r_b").alias("b"))), "merged")
    moved = roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    moved = moved.select("cid", F.coalesce("top", "root").alias("root"))
    new = merged.select(F.col("node").alias("cid"), "root").join(roots, "cid", "left_anti")
    return saved(moved.union(new), "roots")


def _between(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The pairs of different components, with ``root_a`` and ``root_b``."""
    for end in ("a", "b"):
        if roots is None:
            pairs = pairs.withColumn(f"root_{end}", F.col(end))
        else:
            known = roots.select(F.col("cid").alias(end), F.col("root").alias(f"root_{end}"))
            pairs = pairs.join(known, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return pairs.where("root_a != root_b")


def _closest(pairs: DataFrame) -> DataFrame:
    """For each component the one of its pairs whose parities differ least: a pair for each component at most."""
    pair = F.struct("distance", F.xxhash64("a", "b"), "a", "b", "n_a", "n_b").alias("pair")
    ends = pairs.select(F.col("root_a").alias("root"), pair).union(pairs.select(F.col("root_b").alias("root"), pair))
    return ends.groupBy("root").agg(F.min("pair").alias("pair")).select("pair.a", "pair.b", "pair.n_a", "pair.n_b").distinct()


def linked_documents(docs: DataFrame, spec: JaccardJoin = JaccardJoin()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_shingles, component_id, component_text.

    ``component_text`` is the text hash of the component's first document, so (component_id,
    component_text) names one document even where ids repeat.
    """
    spark = docs.sparkSession
    texts = _texts(docs)
    ranks = spark.sparkContext.broadcast(_ranks(texts, spec.n))
    members = saved(_members(texts, spec, ranks), "members")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = members.where("print is not null").groupBy("print")
    classes = classes.agg(F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"), F.first("parities").alias("parities"))
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    # shared prefix n-grams first, then again with the size: sizes that may link share one of two size steps
    postings = classes.select("cid", "n", F.explode("prefix").alias("place"))
    shared = postings.groupBy("place").count().where("count > 1")
    common_first = Window.partitionBy("cid").orderBy(F.desc("count"), F.desc("place"))
    postings = postings.join(shared, "place").withColumn("left", F.row_number().over(common_first))
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / spec.percent) + 1e-9)).cast("long")
    postings = postings.select("cid", "n", "left", "place", F.posexplode(F.array(step, step + 1)).alias("up", "step"))
    grp, up = F.xxhash64("place", "step").alias("grp"), (F.col("up") == 1).alias("up")
    postings = saved(postings.select("cid", "n", "left", up, grp), "postings")
    groups = postings.groupBy("grp").agg(F.min("cid").alias("low"), F.max("cid").alias("high"))
    postings = saved(postings.join(groups.where("low != high").select("grp"), "grp"), "postings")

    roots: DataFrame | None = None
    tested: DataFrame | None = None
    rows = postings
    for turn in range(spec.pivot_rounds + 1):
        rows = rows.select("grp", "cid", "n", "left", "up")
        if roots is None:
            rows = rows.withColumn("root", F.col("cid")).withColumn("main", F.lit(False))
        else:
            rows = rows.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
            rows = saved(_still_open(rows), "open")
            rows = rows.join(classes.select("cid", *_signs()), "cid")
        if turn < spec.pivot_rounds:
            rows = rows.drop("main")
            chosen = rows.groupBy("grp").agg(F.min_by("cid", _pivot_order(turn)).alias("cid"))
            others = rows.join(chosen, ["grp", "cid"]).select(rows.columns)
        else:
            others = rows.where(~F.col("main"))
        pairs = _apart(others, rows, spec.percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = saved(pairs, "pairs")
        for _ in range(_WAVES if turn == spec.pivot_rounds else 0):
            if pairs.isEmpty():
                break
            closest = saved(_closest(_between(pairs, roots)), "closest")
            roots = _merge(roots, _linked(closest, texts, classes, spec, ranks))
            pairs = pairs.join(closest.select("a", "b"), ["a", "b"], "left_anti")
            pairs = saved(_between(pairs, roots).select("a", "b", "n_a", "n_b", "distance"), "pairs")
        if not pairs.isEmpty():
            roots = _merge(roots, _linked(pairs, texts, classes, spec, ranks))
            tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))

    grouped = classes.select("print", "cid")
    if roots is not None:
        grouped = grouped.join(roots, "cid", "left").select("print", F.coalesce("root", "cid").alias("root"))
    else:
        grouped = grouped.select("print", F.col("cid").alias("root"))
    out = members.select("doc_id", "text_hash", "n_shingles", "print")
    by_print = out.where("print is not null").groupBy("print").agg(F.min(first).alias("first"))
    tops = by_print.join(grouped, "print")
    heads = tops.groupBy("root").agg(F.min("first").alias("head"))
    heads = tops.select("print", "root").join(heads, "root").select("print", "head")
    return out.join(heads, "print", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.when(F.col("print").isNull(), F.col("text_hash")).otherwise(F.col("head.text_hash")).alias("component_text"),
    )


def keep_one(docs: DataFrame, spec: JaccardJoin = JaccardJoin()) -> DataFrame:  # noqa: B008
    """``docs`` with one document of each component, the one with the smallest id; repeated rows are one document.

    Rows without words and rows with a null id whose text has no equal stay.
    """
    linked = saved(linked_documents(docs, spec), "linked")
    mark = free_name(docs, "text_hash")
    columns = [f"`{c}`" for c in docs.columns]
    marked = docs.withColumn(mark, F.xxhash64(F.col("text")))
    is_head = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("component_text"))
    gone = saved(linked.where(~is_head).select("doc_id", "text_hash").distinct(), "gone")
    id_name, hash_name = free_name(marked, "gone_id"), free_name(marked, "gone_hash")
    gone = checked_broadcast(gone.toDF(id_name, hash_name))
    same = marked["doc_id"].cast("long").eqNullSafe(F.col(id_name)) & (marked[mark] == F.col(hash_name))
    kept = marked.join(gone, same, "left_anti")
    twice = linked.where(is_head & (F.col("n_shingles") > 0)).groupBy("doc_id", "text_hash").count().where("count > 1")
    twice = saved(twice.select("doc_id", "text_hash").toDF(id_name, hash_name), "twice")
    if not twice.isEmpty():
        again = kept["doc_id"].cast("long").eqNullSafe(F.col(id_name)) & (kept[mark] == F.col(hash_name))
        twice = checked_broadcast(twice)
        once = kept.join(twice, again, "left_semi").dropDuplicates(["doc_id", mark])
        kept = kept.join(twice, again, "left_anti").unionByName(once)
    return kept.select(*columns)
