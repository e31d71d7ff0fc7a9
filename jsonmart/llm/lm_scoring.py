"""Language-model scores by masked pseudo-likelihood.

A small network predicts every token of a document from a window on both of its sides: the embeddings of the
two words before and the two after, each with its own table, are added, squashed, and mapped to a softmax over
word classes. The sum of the log-probabilities of all tokens, each given its neighbours, scores the document.

Classes are the most common words of the corpus, counted over all documents, and hash classes for all others. A word of a
hash class has the probability of its class times its own within the class: (n + 1) / (N + V + 1), for a word
counted n times in a class of V words and N tokens; the 1 that is left is for all words never counted. The counts of all
words stay a written table. Tasks hold a bounded number of the most frequent, as arrays of hashes and logarithms; the other
words of a document are joined with the table, one narrow row for each of them, with the times it occurs. Words
are told apart by 64 bits there.

Texts are read twice, to count their words and to encode them: the class of each word (a byte), the sum of what is known
within classes, and the words to be joined. Training and scoring read the written codes.

Training is data-parallel: each task trains a copy of the model in numpy on windows of every document it reads,
and copies are averaged, weighted by their windows, after every round. Word counts and copies grow with the
corpus and meet in Spark aggregates; the driver sees one row per common or held word, per hash class and per
parameter, and the held words, a fixed number. Copies and logarithms are added as whole numbers, so the order in which tasks
finish does not matter. How the input is dealt out to tasks does: other partitions train other copies, which moves the scores
somewhat, as another seed would. For equal scores on another cluster, keep the fitted model.

Defined cases. Null or wordless text: 0 tokens, score 0, null mean. Repeated rows are scored each, with scores
that are equal up to the rounding of 32-bit sums, some 1e-6 a token. Places beyond the ends of a text hold a class of their own. Texts are taken whole; round k trains on the
windows of each text whose place is k modulo ``stride``, and there are at least ``stride`` rounds, so every window is
a target. Other columns are ignored. On an empty table the model stays as it began.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import saved, text_slices
from .shingles import word_hashes

_SIDES = (-2, -1, 1, 2)
_FIXED = 1 << 20  # parameters are added in units of one millionth
_HELD_WORDS = 200_000
_FREQUENT_WORDS = 1 << 19  # words whose counts tasks hold (8 MB); those of others are joined
_BINS = 16  # of counts, a natural logarithm
_LOG_UNIT = 10**9  # logarithms are added in billionths


@dataclass(frozen=True)
class WindowModel:
    words: int = 127
    hash_classes: int = 32
    width: int = 16
    rounds: int = 2
    stride: int = 2
    batch: int = 256
    rate: float = 0.1
    seed: int = 7

    def __post_init__(self):
        if self.rounds < self.stride:
            raise ValueError("fewer rounds than stride leave windows untrained")

    @property
    def classes(self) -> int:
        return 1 + self.words + self.hash_classes  # class 0 stands beyond the ends


class _Classes:
    """Class of each word by its hash: common words have their own, others that of their hash."""

    def __init__(self, common: list[bytes], spec: WindowModel):
        hashes = word_hashes(common)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.spec = spec

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = 1 + self.spec.words + (hashes % np.uint64(self.spec.hash_classes)).astype(np.int32)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            out = np.where(self.sorted[at] == hashes, 1 + self.order[at].astype(np.int32), out)
        return out.astype(np.int32)


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the number of words of each."""
    words = [_words(text) for text in texts]
    return word_hashes([w for part in words for w in part]), np.array([len(part) for part in words], dtype=np.int64)


def _padded(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all texts with two empty places around each; places and text number of each token."""
    owners = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(codes)) + 2 * (owners + 1)
    ids = np.zeros(len(codes) + 2 * len(sizes) + 2, dtype=np.int32)
    ids[places] = codes
    return ids, places, owners


def _shapes(spec: WindowModel) -> list[tuple[int, ...]]:
    return [(len(_SIDES), spec.classes, spec.width), (spec.width,), (spec.width, spec.classes), (spec.classes,)]


def _start(spec: WindowModel) -> list[np.ndarray]:
    random = np.random.default_rng(spec.seed)
    return [random.normal(0, 0.1, s).astype(np.float32) for s in _shapes(spec)]


def _flat(model: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in model])


def _shaped(values: np.ndarray, spec: WindowModel) -> list[np.ndarray]:
    out, at = [], 0
    for shape in _shapes(spec):
        size = int(np.prod(shape))
        out.append(values[at : at + size].reshape(shape).astype(np.float32))
        at += size
    return out


def _logits(model, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden values, and logits of all classes that exp() can take, at ``places``."""
    tables, bias, out, out_bias = model
    hidden = np.tanh(sum(tables[k][ids[places + side]] for k, side in enumerate(_SIDES)) + bias)
    logits = hidden @ out
    logits += out_bias
    if np.abs(out).sum(axis=0).max() + np.abs(out_bias).max() > 60:  # hidden values are at most 1
        logits -= logits.max(axis=1, keepdims=True)
    return hidden, logits


def _forward(model, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden values and log-probabilities of all classes at ``places``."""
    hidden, logits = _logits(model, ids, places)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return hidden, logits


def _windows(places: np.ndarray, owners: np.ndarray, offset: int, stride: int) -> np.ndarray:
    """The places that are ``offset`` modulo ``stride`` in their own text."""
    if stride == 1 or not len(places):
        return places
    first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
    inside = places - np.repeat(places[first], np.diff(np.r_[first, len(places)]))
    return places[inside % stride == offset % stride]


def train_on(model: list[np.ndarray], memory: list[np.ndarray], ids: np.ndarray, places: np.ndarray, spec: WindowModel) -> None:
    """Steps of adaptive gradient descent over the windows at ``places``; changes ``model`` and ``memory``."""
    tables, _, out, _ = model
    sides, column = np.arange(len(_SIDES))[:, None] * spec.classes, np.arange(spec.width)
    for at in range(0, len(places), spec.batch):
        part = places[at : at + spec.batch]
        n = len(part)
        hidden, error = _logits(model, ids, part)
        np.exp(error, out=error)
        error /= error.sum(axis=1, keepdims=True)
        error[np.arange(n), ids[part]] -= 1
        error /= n
        back = (error @ out.T) * (1 - hidden**2)
        met = sides + ids[part + np.array(_SIDES)[:, None]]  # (side, window): row of the tables
        met = (met[:, :, None] * spec.width + column).ravel()
        moved = np.bincount(met, np.broadcast_to(back, (len(_SIDES), *back.shape)).ravel(), tables.size)
        slopes = [moved.reshape(tables.shape).astype(tables.dtype), back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
        for p, m, g in zip(model, memory, slopes, strict=True):
            m += g * g
            p -= spec.rate * g / (np.sqrt(m) + 1e-6)


def word_counts(docs: DataFrame, spec: WindowModel) -> DataFrame:
    """word, place of its hash class, n: the words of all documents and how often each occurs."""

    def count(batches):
        total: Counter = Counter()
        for part in text_slices(batches):
            for text in part.column("text").to_pylist():
                total.update(_words(text))
            if len(total) > _HELD_WORDS:
                yield _counted(total, spec)
                total.clear()
        yield _counted(total, spec)

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(count, "word binary, hash long, place int, n long")
    return counts.groupBy("word", "hash", "place").agg(F.sum("n").alias("n"))


def _counted(total: Counter, spec: WindowModel) -> pa.RecordBatch:
    words = list(total)
    hashes = word_hashes(words)
    places = (hashes % np.uint64(spec.hash_classes)).astype(np.int32)
    columns = [pa.array(words, pa.binary()), pa.array(hashes.view(np.int64)), pa.array(places), pa.array(list(total.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "hash", "place", "n"])


def _top(counts: DataFrame, spec: WindowModel) -> list[tuple[bytes, int, int]]:
    """Word, place and count of the most common words; ties go to the smaller word."""
    return [(bytes(r.word), r.place, r.n) for r in counts.orderBy(F.desc("n"), "word").limit(spec.words).collect()]


def common_words(docs: DataFrame, spec: WindowModel) -> list[bytes]:
    """The most common words of all documents; ties go to the smaller word."""
    return [word for word, _, _ in _top(word_counts(docs, spec), spec)]


class Fitted(tuple):
    """(common words, trained parameters), with the counts behind a word's probability within its class."""

    counts: DataFrame  # hash, n of all words
    frequent: tuple[np.ndarray, np.ndarray]  # sorted hashes of the words that tasks hold, n of each
    totals: np.ndarray  # tokens and words of each hash class


def _within(fitted: Fitted, counts: DataFrame, top: list[tuple[bytes, int, int]], spec: WindowModel) -> Fitted:
    totals = np.zeros(spec.hash_classes, dtype=np.int64)
    for r in counts.groupBy("place").agg((F.sum("n") + F.count("*")).alias("total")).collect():
        totals[r.place] = r.total
    for _, place, n in top:  # these have classes of their own
        totals[place] -= n + 1
    level = F.floor(F.log("n") * _BINS)
    least, room = 1 << 30, _FREQUENT_WORDS
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):  # one row per bin
        room -= r["count"]
        if room < 0:
            break
        least = r.level
    held = counts.where(level >= least).select("hash", "n").toArrow()  # no rows if even the highest level has too many
    hashes, n = (held.column(c).to_numpy() for c in ("hash", "n"))
    order = np.argsort(hashes.view(np.uint64))
    fitted.counts, fitted.totals = counts.select("hash", "n"), totals
    fitted.frequent = hashes.view(np.uint64)[order], n[order]
    return fitted


def _code_type(spec: WindowModel) -> np.dtype:
    return np.min_scalar_type(spec.classes)


def _read_codes(part: pa.RecordBatch, spec: WindowModel) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts of a batch of the encoded rows, and the number of words of each."""
    codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), dtype=_code_type(spec))
    return codes, part.column("n").to_numpy()


def _round(encoded: DataFrame, model: list[np.ndarray], spec: WindowModel, offset: int) -> list[np.ndarray]:
    """One round: every task trains its copy, the copies are averaged by their number of windows."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def train(batches):
        begun = shared.value
        own = [p.copy() for p in begun]
        memory, seen = [np.full_like(p, 1e-3) for p in own], 0
        for part in text_slices(batches, "codes"):
            ids, places, owners = _padded(*_read_codes(part, spec))
            places = _windows(places, owners, offset, spec.stride)
            train_on(own, memory, ids, places, spec)
            seen += len(places)
        if seen:
            values = np.rint(_flat(own).astype(np.float64) * _FIXED).astype(np.int64) * seen
            place = pa.array(np.arange(len(values)), pa.int32())
            yield pa.RecordBatch.from_arrays([place, pa.array(values), pa.array(np.full(len(values), seen))], ["place", "value", "n"])

    copies = encoded.where("hash IS NULL").select("codes", "n").mapInArrow(train, "place int, value long, n long")
    total = copies.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("n").alias("n"))
    values = _flat(model).astype(np.float64)
    for row in total.collect():  # one row per parameter
        values[row.place] = int(row.value) / row.n / _FIXED
    return _shaped(values, spec)


def _begun(docs: DataFrame, spec: WindowModel) -> Fitted:
    """The common words and the counts, with a model that has not been trained."""
    counts = saved(word_counts(docs, spec), "lm-words")
    top = _top(counts, spec)
    return _within(Fitted(([word for word, _, _ in top], _start(spec))), counts, top, spec)


def _trained(begun: Fitted, encoded: DataFrame, spec: WindowModel) -> Fitted:
    common, model = begun
    for k in range(spec.rounds):
        model = _round(encoded, model, spec, k)
    out = Fitted((common, model))
    out.counts, out.frequent, out.totals = begun.counts, begun.frequent, begun.totals
    return out


def fit(docs: DataFrame, spec: WindowModel = WindowModel()) -> Fitted:  # noqa: B008
    """Common words and the trained parameters."""
    begun = _begun(docs, spec)
    return _trained(begun, _encoded(docs, begun, spec), spec)


class _Encoder:
    """Classes of words, their logarithms within the class as far as they are known here, and the other words."""

    def __init__(self, common: list[bytes], frequent: tuple, totals: np.ndarray, spec: WindowModel):
        self.classes = _Classes(common, spec)
        self.held, counts = frequent
        self.first = 1 + spec.words  # of the hash classes
        self.logs = np.log(counts + 1.0)
        self.base = np.zeros(spec.classes)
        self.base[self.first :] = np.log(totals + 1.0)

    def parts(self, hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's logarithm, and whether the count of its word is not known here."""
        out, rare = -self.base[ids], ids >= self.first
        if len(self.held):
            at = np.minimum(np.searchsorted(self.held, hashes), len(self.held) - 1)
            held = rare & (self.held[at] == hashes)
            out[held] += self.logs[at[held]]
            rare &= ~held
        return out, rare

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Codes of all words, words and sum of each text; text, hash and times of the words to be joined."""
        hashes, sizes = _hashed(texts)
        codes = self.classes.of(hashes)
        own, rare = self.parts(hashes, codes)
        owners = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.bincount(owners, own, len(texts))
        order = np.lexsort((hashes[rare], owners[rare]))
        of, words = owners[rare][order], hashes[rare][order]
        new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (words[1:] != words[:-1])]) if len(of) else np.empty(0, np.int64)
        return codes, sizes, sums, (of[new], words[new], np.diff(np.r_[new, len(of)]))


def _encoded(docs: DataFrame, fitted: Fitted, spec: WindowModel) -> DataFrame:
    """Rows of two kinds by their number ``row``, written: without a hash, a text's codes, words and sum; with one, a word
    of it whose count is to be joined and the times it occurs."""
    shared = docs.sparkSession.sparkContext.broadcast((fitted[0], fitted.frequent, fitted.totals))

    def run(batches):
        encoder, first = _Encoder(*shared.value, spec), TaskContext.get().partitionId() << 40
        for part in text_slices(batches):
            codes, n, sums, (of, words, times) = encoder.encode(part.column("text").to_pylist())
            rows, more = np.arange(first, first + len(n)), len(words)
            first += len(n)
            codes = [c.tobytes() for c in np.split(codes.astype(_code_type(spec)), np.cumsum(n)[:-1])]
            fixed = np.rint(sums * _LOG_UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([rows, rows[of]])),
                    pa.concat_arrays([pa.nulls(len(n), pa.int64()), pa.array(words.view(np.int64))]),
                    pa.concat_arrays([part.column("doc_id"), pa.nulls(more, pa.int64())]),
                    pa.array(np.concatenate([n, times])),
                    pa.concat_arrays([pa.array(fixed), pa.nulls(more, pa.int64())]),
                    pa.concat_arrays([pa.array(codes, pa.binary()), pa.nulls(more, pa.binary())]),
                ],
                ["row", "hash", "doc_id", "n", "value", "codes"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return saved(rows.mapInArrow(run, "row long, hash long, doc_id long, n long, value long, codes binary"), "lm-codes")


def _sums(model: list[np.ndarray], codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each text, the sum of the log-probabilities of its classes."""
    ids, places, owners = _padded(codes, sizes)
    sums = np.zeros(len(sizes))
    for at in range(0, len(places), 1024):
        part = places[at : at + 1024]
        _, logits = _logits(model, ids, part)
        logs = logits[np.arange(len(part)), ids[part]] - np.log(np.exp(logits, out=logits).sum(axis=1))
        sums += np.bincount(owners[at : at + 1024], logs, len(sizes))
    return sums


def scores(docs: DataFrame, fitted: Fitted | None = None, spec: WindowModel = WindowModel()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, log_prob, mean_log_prob."""
    begun = fitted or _begun(docs, spec)
    encoded = _encoded(docs, begun, spec)
    fitted = fitted or _trained(begun, encoded, spec)
    shared = docs.sparkSession.sparkContext.broadcast(fitted[1])

    def run(batches):
        for part in text_slices(batches, "codes"):
            fixed = np.rint(_sums(shared.value, *_read_codes(part, spec)) * _LOG_UNIT).astype(np.int64)
            value = pa.array(fixed + part.column("value").to_numpy())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "doc_id", "n")), value], ["row", "doc_id", "n", "value"])

    own = encoded.where("hash IS NULL").select("row", "doc_id", "n", "value", "codes")
    own = own.mapInArrow(run, "row long, doc_id long, n long, value long")
    log = F.round(F.log(F.col("n") + 1) * _LOG_UNIT).cast("long").alias("log")
    logs = fitted.counts.groupBy("hash").agg(F.max("n").alias("n")).select("hash", log)
    words = encoded.where("hash IS NOT NULL").select("row", "hash", F.col("n").alias("times")).join(logs, "hash")
    none = F.lit(None).cast("long")
    words = words.select("row", none.alias("doc_id"), F.lit(0).cast("long").alias("n"), (F.col("times") * F.col("log")).alias("value"))
    scored = own.union(words).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.round(F.sum("value") / _LOG_UNIT, 4).alias("log_prob"),
    )
    mean = F.when(F.col("n_tokens") > 0, F.round(F.col("log_prob") / F.col("n_tokens"), 6))
    return scored.drop("row").withColumn("mean_log_prob", mean)
