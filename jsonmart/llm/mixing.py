"""Mixing of sources to target weights over a tree of domain, language and source.

Hierarchical budgeting. A token budget starts at the root. Every node hands its budget to its children by
their weights, but no child gets more than its whole subtree can give (its tokens times ``max_epochs``). What a
full child can't take goes to its siblings by their weights; only when a whole subtree is full does the rest go
to the siblings of its parent. Each leaf turns its quota into whole epochs plus the token-prefix of one more
epoch, whose order comes from a hash of seed, epoch, document id and text.

Everything is aggregates, windows over the few nodes of one parent, and joins. A leaf may hold any share of the
rows: its prefix is found from sums of hash buckets of some 4,096 documents, and documents are put in order only
inside the one bucket where the quota ends, after equal places are summed up. The selection is then a comparison of each document with the cut
of its leaf, so texts are never shuffled.

Defined cases. Null level values form the node '' of their level. Null or empty texts count 0 tokens; they
are taken where the prefix passes them. Nodes without a given weight weigh ``default_weight``; weight 0 gives
nothing. Rows with the same id and text in one leaf share a place in the order and are taken together or not at all;
rows with one id, or none, and different texts have places of their own. An empty table gives no rows. Tokens are words. Other columns pass through; ``copies`` gets a longer name on a clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, free_name, saved, split_words

LEVELS = ("domain", "lang", "source")
_BUCKET_DOCS = 4096


@dataclass(frozen=True)
class Mix:
    """``weights`` maps the path of a node, from the top, to its weight among its siblings."""

    weights: dict[tuple[str, ...], int] = field(default_factory=dict)
    budget_percent: int = 70  # of all tokens of the input; or ``budget_tokens``, which wins
    budget_tokens: int | None = None
    max_epochs: int = 1
    seed: int = 1
    default_weight: int = 1


def source_domain(source: Column) -> Column:
    """The default top level: the first source is the crawl, the next nine are books, all others forums."""
    books = [f"src{k}" for k in range(1, 10)]
    return F.when(source == "src0", "crawl").when(source.isin(books), "books").otherwise("forums")


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _narrow(docs: DataFrame, domain) -> DataFrame:
    empty = F.lit("")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("string"), empty).alias("id"),
        _text_key(F.col("text")).alias("text_key"),
        F.coalesce(domain(F.col("source")), empty).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), empty).alias("lang"),
        F.coalesce(F.col("source").cast("string"), empty).alias("source"),
        F.size(split_words(F.col("text"))).cast("long").alias("n_tokens"),
    )


def _weight(mix: Mix, depth: int) -> Column:
    """Weight of the node that the first ``depth`` levels name."""
    chosen = {path: w for path, w in mix.weights.items() if len(path) == depth}
    if not chosen:
        return F.lit(mix.default_weight).cast("long")
    weight = F.coalesce(
        *[
            F.when(F.concat_ws("\x1f", *LEVELS[:depth]) == "\x1f".join(path), F.lit(w).cast("long"))
            for path, w in chosen.items()
        ],
        F.lit(mix.default_weight).cast("long"),
    )
    return weight


def _pour(nodes: DataFrame, parent: tuple[str, ...]) -> DataFrame:
    """``budget`` of each node from ``given`` to its parent: capped shares by weight, the excess to its siblings.

    In the order of capacity per weight, the full nodes come first. The first that is not full fixes the
    level, tokens per weight, that it and all later nodes get.
    """
    by = [F.col(c) for c in parent] or [F.lit(0)]
    order = Window.partitionBy(*by).orderBy(F.col("capacity") / F.col("weight"), *LEVELS[: len(parent) + 1])
    upto, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    spent = F.coalesce(F.sum("capacity").over(upto), F.lit(0))
    nodes = nodes.withColumn("level", (F.col("given") - spent) / F.sum("weight").over(after).cast("double"))
    short = F.when(F.col("capacity") > F.col("level") * F.col("weight"), F.col("level"))
    nodes = nodes.withColumn("fixed", F.first(short, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    share = F.floor(F.col("fixed") * F.col("weight"))
    return nodes.withColumn("budget", F.when(F.col("fixed").isNull(), F.col("capacity")).otherwise(F.least("capacity", share)))


def leaf_quotas(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (levels, n_tokens, n_docs) with capacity, weight and quota."""
    leaves = leaves.withColumn("open", F.lit(True))
    for depth in range(1, len(LEVELS) + 1):
        leaves = leaves.withColumn("open", F.col("open") & (_weight(mix, depth) > 0))
    leaves = leaves.withColumn("capacity", F.when(F.col("open"), F.col("n_tokens") * mix.max_epochs).otherwise(0))
    tokens = F.floor(F.sum("n_tokens") * mix.budget_percent / 100) if mix.budget_tokens is None else F.lit(mix.budget_tokens)
    root = leaves.agg(F.least(tokens.cast("long"), F.sum("capacity")).alias("given"))
    above: DataFrame = root
    for depth in range(1, len(LEVELS) + 1):
        levels, parent = LEVELS[:depth], LEVELS[: depth - 1]
        nodes = leaves.groupBy(*levels).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", F.greatest(_weight(mix, depth), F.lit(1)))  # weight 0 has capacity 0
        nodes = nodes.join(above, list(parent)) if parent else nodes.join(F.broadcast(above))  # one row
        above = _pour(nodes, parent).select(*levels, F.col("budget").alias("given"))
    return leaves.select(*LEVELS, "n_tokens", "n_docs", "capacity").join(
        above.withColumnRenamed("given", "quota"), list(LEVELS)
    )


def _order_key(mix: Mix, epoch: Column, id_: Column, text_key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(mix.seed)), epoch.cast("string"), id_, text_key).cast("binary"))


def _bucket(key: Column, buckets: Column) -> Column:
    place = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.floor(place * buckets / F.lit(float(1 << 32))).cast("long")


def leaf_plan(narrow: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf: whole epochs, and up to which key the next epoch goes (null: none of it)."""
    leaves = saved(narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs")), "leaves")
    quotas = leaf_quotas(leaves, mix)
    whole = F.when(F.col("n_tokens") > 0, F.floor(F.col("quota") / F.col("n_tokens"))).otherwise(0).cast("long")
    quotas = quotas.withColumn("whole", whole).withColumn("rest", F.col("quota") - F.col("whole") * F.col("n_tokens"))
    quotas = saved(quotas.withColumn("buckets", F.floor(F.col("n_docs") / _BUCKET_DOCS) + 1), "quotas")

    part = checked_broadcast(quotas.where("rest > 0").select(*LEVELS, "whole", "rest", "buckets"))
    placed = narrow.join(part, list(LEVELS)).withColumn("key", _order_key(mix, F.col("whole") + 1, F.col("id"), F.col("text_key")))
    placed = placed.withColumn("bucket", _bucket(F.col("key"), F.col("buckets")))
    sums = placed.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n_tokens").alias("n_tokens"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket")
    sums = sums.withColumn("through", F.sum("n_tokens").over(running))
    # the first bucket that the quota does not cover; there is one, as the rest is less than the leaf
    edge = sums.where("through > rest").groupBy(*LEVELS).agg(
        F.min("bucket").alias("bucket"), F.min(F.struct("bucket", F.expr("through - n_tokens").alias("before"))).alias("at")
    )
    edge = saved(edge.select(*LEVELS, "bucket", F.col("at.before").alias("before")), "edges")
    last = placed.join(checked_broadcast(edge), [*LEVELS, "bucket"])
    last = last.groupBy(*LEVELS, "rest", "before", "key").agg(F.sum("n_tokens").alias("n_tokens"))  # one row per place
    inside = F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("key"))
    last = last.withColumn("through", F.col("before") + inside)
    cut = last.where("through <= rest").groupBy(*LEVELS).agg(F.max("key").alias("cut"))
    plan = quotas.join(edge, list(LEVELS), "left").join(cut, list(LEVELS), "left")
    return saved(plan.select(*LEVELS, "quota", "whole", "buckets", F.col("bucket").alias("edge"), "cut"), "plan")


def _copies(mix: Mix, id_: Column, text_key: Column, plan: dict[str, str]) -> Column:
    """How often a document is taken; ``plan`` names the columns of its leaf's plan."""
    whole, buckets, edge, cut = (F.col(plan[c]) for c in ("whole", "buckets", "edge", "cut"))
    key = _order_key(mix, whole + 1, id_, text_key)
    bucket = _bucket(key, buckets)
    inside = (bucket < edge) | ((bucket == edge) & (key <= cut))
    return whole + F.coalesce(inside, F.lit(False)).cast("long")


def selection(docs: DataFrame, mix: Mix, domain=source_domain) -> DataFrame:
    """(id, levels, n_tokens, copies) of the documents that the mix takes; copies counts their epochs."""
    narrow = saved(_narrow(docs, domain), "narrow")
    plan = leaf_plan(narrow, mix)
    taken = narrow.join(checked_broadcast(plan), list(LEVELS))
    taken = taken.withColumn("copies", _copies(mix, F.col("id"), F.col("text_key"), {c: c for c in plan.columns}))
    return taken.where("copies > 0").select("id", *LEVELS, "n_tokens", "copies")


def mixed(docs: DataFrame, mix: Mix, domain=source_domain) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with their own columns; a row comes once for each of its epochs."""
    plan = leaf_plan(saved(_narrow(docs, domain), "narrow"), mix)
    names = {c: free_name(docs, f"__{c}") for c in plan.columns}
    copies = free_name(docs, "__copies")
    empty = F.lit("")
    of = {c: F.coalesce(docs[c].cast("string"), empty) for c in ("doc_id", "lang", "source")}
    of["domain"] = F.coalesce(domain(docs["source"]), empty)
    plan = checked_broadcast(plan.toDF(*names.values()))
    same = [of[c] == plan[names[c]] for c in LEVELS]
    taken = _copies(mix, of["doc_id"], _text_key(docs["text"]), names)
    rows = docs.join(plan, same).withColumn(copies, taken).where(F.col(copies) > 0)
    if mix.max_epochs > 1:
        rows = rows.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return rows.select(*[docs[c] for c in docs.columns])
