"""Benchmark decontamination: which documents contain a test item.

Size-partitioned MinHash containment search. Test items are grouped by the size of their shingle set into
partitions that double in size. The sketch of an item is its s smallest shingle hashes (a bottom-s MinHash). A
document that contains at least the share t of an item's m shingles misses at most (1 - t) * m of them, so it
holds one of any (1 - t) * m + 1; s is that number for the largest item of the partition, hence no true match
can be missed, however long the document is. Sketches hold small hashes only: of a document's shingles those
above the partition's largest sketch value are dropped by one comparison, the rest are looked up. Documents
need no sketch of their own, so short items are found inside long documents. Every candidate is then verified
by exact containment of its word shingles.

Distinct items are read in blocks of bounded size and broadcast; one scan of the documents holds several blocks,
whose sketches a Python worker builds once for all its tasks. Item shingles are made only for candidates.

Words are runs of letters and digits in lower case, so punctuation and line breaks do not hide a match.
Defined cases. Null or empty text, or one without words, matches nothing. An item of fewer than n words is one
shingle, its whole sequence, and is looked up among the document's windows of that length. Repeated documents or
items give repeated pairs of distinct rows only once per (doc_id, item_id); null ids are kept as ids. Other columns
are ignored.
"""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, free_name, saved
from .shingles import window_hashes, word_hashes

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Containment:
    """An item leaks into a document that holds at least ``percent`` of its distinct ``n``-word shingles."""

    n: int = 5
    percent: int = 80
    block_bytes: int = 16 << 20  # text of the test items in one broadcast
    scan_blocks: int = 4  # blocks that one scan of the documents holds


def _words(text: str | None) -> list[bytes]:
    return [w.encode() for w in _WORD.findall((text or "").lower())]


class _Index:
    """Sketches of a block of items: by shingle length and size partition, sorted hashes and the items they belong to."""

    def __init__(self, items: list[tuple[int | None, str | None]], spec: Containment):
        self.items, self.n, self.percent = items, spec.n, spec.percent
        sized: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = defaultdict(list)
        for k, (_, text) in enumerate(items):
            words = _words(text)
            if words:
                length = min(spec.n, len(words))
                hashes = np.unique(window_hashes(word_hashes(words), length))
                sized[length, len(hashes).bit_length()].append((k, hashes))
        self.partitions: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for (length, _), members in sized.items():
            largest = max(len(h) for _, h in members)
            s = largest - -(-spec.percent * largest // 100) + 1
            values = np.concatenate([h[:s] for _, h in members])  # np.unique has sorted them
            owners = np.concatenate([np.full(len(h[:s]), k) for k, h in members])
            order = np.argsort(values, kind="stable")
            self.partitions[length].append((values[order], owners[order]))
        self.shingles = lru_cache(maxsize=4096)(self._shingles)

    def _shingles(self, k: int) -> tuple[int, set[tuple[bytes, ...]]]:
        words = _words(self.items[k][1])
        length = min(self.n, len(words))
        return length, shingle_tuples(words, length)

    def candidates(self, word_values: np.ndarray) -> set[int]:
        found: set[int] = set()
        for length, partitions in self.partitions.items():
            hashes = window_hashes(word_values, length)
            for values, owners in partitions:
                small = hashes[hashes <= values[-1]]
                left, right = np.searchsorted(values, small), np.searchsorted(values, small, side="right")
                hit = right > left
                for a, b in set(zip(left[hit].tolist(), right[hit].tolist(), strict=True)):
                    found.update(owners[a:b].tolist())
        return found

    def matches(self, words: list[bytes]):
        """(item, shared, size) of every item that the words contain."""
        own: dict[int, set[tuple[bytes, ...]]] = {}
        for k in sorted(self.candidates(word_hashes(words))):
            length, want = self.shingles(k)
            if length not in own:
                own[length] = shingle_tuples(words, length)
            shared = len(want & own[length])
            if 100 * shared >= self.percent * len(want):
                yield self.items[k][0], shared, len(want)


def _indexes(scan_id: str, blocks, spec: Containment) -> list[_Index]:
    """The indexes of a scan, built once per worker process; those of an earlier scan are let go."""
    kept = sys.modules.setdefault("_kept_item_indexes", types.ModuleType("_kept_item_indexes"))
    if getattr(kept, "scan_id", None) != scan_id:
        kept.indexes = [_Index(block.value, spec) for block in blocks]
        kept.scan_id = scan_id
    return kept.indexes


def shingle_tuples(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[k:] for k in range(n)), strict=False))


def leaks(docs: DataFrame, items: DataFrame, spec: Containment = Containment()) -> DataFrame:  # noqa: B008
    """(doc_id, item_id, shared, item_size, text_hash): each document with each test item that it contains."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    items = saved(items.distinct(), "items")
    total = items.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    blocks = total // spec.block_bytes + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    out = None
    for first in range(0, blocks, spec.scan_blocks):
        held = []
        for k in range(first, min(first + spec.scan_blocks, blocks)):
            rows = [(r.item_id, r.text) for r in items.where(block == k).collect()]  # one block of bounded size
            held.append(spark.sparkContext.broadcast(rows))
        schema = "doc_id long, text_hash long, item_id long, shared long, item_size long"
        found = texts.mapInArrow(_scanner(held, spec), schema)
        out = found if out is None else out.union(found)
    return out.distinct()


def _scanner(blocks, spec: Containment):
    scan_id = uuid.uuid4().hex

    def scan(batches):
        indexes = _indexes(scan_id, blocks, spec)
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text"))
            for doc_id, text_hash, text in zip(*columns, strict=True):
                words = _words(text)
                out += [(doc_id, text_hash, *match) for index in indexes for match in index.matches(words)]
            names = ["doc_id", "text_hash", "item_id", "shared", "item_size"]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return scan


def keep_uncontaminated(docs: DataFrame, items: DataFrame, spec: Containment = Containment()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that contain no test item."""
    names = [free_name(docs, "leak_id"), free_name(docs, "leak_hash")]
    found = saved(leaks(docs, items, spec).select("doc_id", "text_hash").distinct().toDF(*names), "leaks")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(names[0])) & (F.xxhash64(docs["text"]) == F.col(names[1]))
    return docs.join(checked_broadcast(found), same, "left_anti")
