"""Periodic runs of words by the dictionary of basic factors.

A run is a maximal stretch of words with smallest period q (words q apart are identical) that is long enough. The
dictionary names the factors of each power-of-two length s: equal factors have equal names, and a factor of length 2s
is the pair of names of its halves. For every start the successor is the next start of the same name. Occurrences
whose starts are at most s apart (so both lie within twice the length) form arithmetic progressions; their difference
p proposes a period. While the start moves on by one word and the successor stays p ahead, the progression extends the
same run, so one run is one maximal stretch of starts a..b and covers the words a to b + p + s.

Why this is exact, for p <= s: p is the smallest period of the stretch, as a smaller one would give a nearer successor;
and the stretch ends only where words p apart differ, as a nearer successor beside it would, by the theorem of Fine and
Wilf, also hold inside it. A run with period q and at least 3q words is seen whole at the first s >= q, since
q + s < 3q; each length reports the periods between s / 2 and s only, so nothing is found twice.

Work. A factor that does not recur in its document within a third of it (the largest period) drops out of the
dictionary, and with it all longer factors there; plain prose leaves after a few words' length. Texts of a task are named
together in one array, with a separator between documents that occurs once, so no factor reaches across. The work is
narrow: one pass over the documents, no shuffle; a document costs n log n at most.

Defined cases. Words are runs of anything but the six ASCII spaces. Null, empty and wordless texts have no words and no
runs, and collapse to the empty text. Words are compared byte by byte. Repeated rows are taken each; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import split_words, text_slices

RUN = "struct<start:long,length:long,period:long>"


@dataclass(frozen=True)
class PeriodicRuns:
    """Runs of at least ``min_words`` words and ``min_exponent`` periods (3 or more)."""

    min_words: int = 24
    min_exponent: int = 3

    def __post_init__(self):
        if self.min_exponent < 3:
            raise ValueError("runs of fewer than three periods are not all seen at the first length that covers one")


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of ``keys`` and, along it, whether a key differs from the one before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    return order, new


def runs_of(words: np.ndarray, widest: np.ndarray, spec: PeriodicRuns) -> np.ndarray:
    """All runs in ``words`` (ids; a separator occurs once) as rows start, length, period; by start, then period.

    ``widest`` has for each word the largest period that its document can hold.
    """
    found = [np.empty((0, 3), dtype=np.int64)]
    at, keys, s = np.arange(len(words)), words.astype(np.int64), 1
    top = int(widest.max(initial=0))
    while len(at) and s < 2 * top:
        order, new = _named(keys)
        starts = at[order]
        gap = np.diff(starts, append=0)
        gap[np.append(new[1:], True)] = len(words) + 1  # the last occurrence has no successor
        found.append(_stretches(starts, gap, s, spec))
        near = gap <= widest[starts]
        near[1:] |= near[:-1] & ~new[1:]
        order, starts, names = order[near], starts[near], np.cumsum(new)[near]
        name = np.zeros(len(words), dtype=np.int64)
        name[starts] = names
        at = np.sort(starts)
        at = at[at + s < len(words)]
        at = at[name[at + s] > 0]
        keys = name[at] * (len(words) + 1) + name[at + s]
        s *= 2
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _stretches(starts: np.ndarray, gap: np.ndarray, s: int, spec: PeriodicRuns) -> np.ndarray:
    """Runs with a period of more than s / 2 and at most s, from each start's distance to its successor."""
    fits = (gap <= s) & (2 * gap > s)
    a, p = starts[fits], gap[fits]
    order = np.argsort(a)
    a, p = a[order], p[order]
    if not len(a):
        return np.empty((0, 3), dtype=np.int64)
    cuts = np.flatnonzero((a[1:] != a[:-1] + 1) | (p[1:] != p[:-1]))
    first, last = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(a) - 1]])
    period = p[first]
    length = a[last] - a[first] + period + s
    long = length >= np.maximum(spec.min_words, spec.min_exponent * period)
    return np.stack([a[first], length, period], axis=1)[long]


def runs_of_texts(texts: list[bytes], spec: PeriodicRuns) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """The words and the runs of each text."""
    words = [t.split() for t in texts]  # bytes split at the six ASCII spaces only
    sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)  # with a separator after each text
    ids = pa.array([w for part in words for w in part], pa.binary()).dictionary_encode().indices.to_numpy()
    ends = np.cumsum(sizes)
    joined = np.empty(int(sizes.sum()), dtype=np.int64)
    separator = np.zeros(len(joined), dtype=bool)
    separator[ends - 1] = True
    joined[~separator] = ids
    joined[separator] = len(ids) + np.arange(len(texts))
    found = runs_of(joined, np.repeat((sizes - 1) // spec.min_exponent, sizes), spec)
    of = np.searchsorted(ends, found[:, 0], side="right")
    found[:, 0] -= (ends - sizes)[of]
    return words, np.split(found, np.searchsorted(of, np.arange(1, len(texts)))) if texts else []


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if len(runs):
        step = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(step, runs[:, 0] + runs[:, 2], 1)
        np.add.at(step, runs[:, 0] + runs[:, 1], -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(step)[:-1] == 0)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, spec: PeriodicRuns = PeriodicRuns()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs`` (doc_id, text): doc_id, runs (start, length, period), collapsed text."""
    kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def run(batches):
        for part in text_slices(batches):
            words, runs = runs_of_texts(part.column("text").to_pylist(), spec)
            counts = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            flat = np.concatenate(runs)
            rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind))
            texts = [collapsed(w, r) for w, r in zip(words, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(counts), rows), pa.array(texts, pa.binary())],
                ["doc_id", "runs", "collapsed"],
            )

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    found = rows.mapInArrow(run, f"doc_id long, runs array<{RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first; null without runs."""
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, x: F.when(better(best, x), x).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a repetition of known place in every tenth document, as a probe for the search.

    With h the CRC-32 of the decimal id and g = h / 10: where h % 10 = 0, the words from a = g % n on become copies of
    the first 1 + (n - a) / (3 + g % 8) of them, over and over. Other texts, and texts without an id, stay as they are.
    """
    doc_id = F.col("doc_id").cast("long")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = split_words(F.col("text"))
    g = F.floor(h / 10)
    chosen = docs.select(doc_id.alias("doc_id"), "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w").cast("long")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda k: F.get("w", (a + k % p).cast("int")))
    head = F.slice("w", F.lit(1), a.cast("int"))
    text = F.array_join(F.concat(head, tail), " ")
    return chosen.select("doc_id", F.when(F.col("w").isNotNull() & (n > 0), text).otherwise(F.col("text")).alias("text"))
