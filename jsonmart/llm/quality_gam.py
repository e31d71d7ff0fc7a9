"""Quality classifier: a generalised additive model with pairwise interactions.

The score of a text is sigmoid(base + sum of f(x) over its features + sum of f(x, y) over a few pairs of features). Every
f is a lookup table over bins of its feature, learned by cyclic boosting: in each round the features take turns, and a
shallow tree (at most four leaves over the feature's bins) fitted to the present gradient adds a small step to the
feature's table. Then the pairs whose best cross-shaped cut explains most of what is left are boosted in the same way
with trees of one cut on each axis. So a model is a few small arrays that can be read and plotted, and scoring is a sum
of vectorised table lookups.

On Spark: one pass over the texts measures the features (numpy on the bytes of a text, narrow) and writes them, some
70 bytes a document. Labels are joined to these, so no text is shuffled. The model is fitted on at most ``max_rows``
labelled documents, those with the smallest hash of their id, which bounds what the driver takes; rows are put in one
order first, so every partitioning gives the same model. Scoring covers every document.

Only the text is an input of the score. Labels are learned only from documents that ``held_out`` leaves.

Defined cases. Null text is the empty text; it has features (zeros) and a score. A null id has no label and is not held
out. Repeated rows are scored each; contradicting labels of an id count once each; other label values than 0 and 1 are
ignored. Without labels of both kinds every score is the share of ones among them, 0.5 without any. Other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, text_slices
from .shingles import window_hashes, word_hashes

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "marks", "not_ascii", "spaces",
    "same_as_previous", "distinct_words", "top_word", "distinct_pairs", "repeated_lines", "line_words", "open_lines",
)


@dataclass(frozen=True)
class GamSpec:
    bins: int = 32
    pair_bins: int = 8
    rounds: int = 120
    pairs: int = 6
    pair_rounds: int = 60
    rate: float = 0.15
    penalty: float = 2.0
    max_rows: int = 200_000


def _class_table() -> np.ndarray:
    """One-hot classes of the 256 byte values: symbols, capitals, digits, other marks, beyond ASCII, white space, letters."""
    of = np.full(256, 3)
    of[128:] = 4
    for k, chars in enumerate((b"#*$%&|<>", bytes(range(65, 91)), b"0123456789")):
        of[list(chars)] = k
    of[list(b" \t\n\r\x0b\x0c")] = 5
    of[97:123] = 6
    return np.eye(7, dtype=np.int64)[of]


_CLASSES = _class_table()


def measure(text: bytes) -> list[float]:
    """The features of one text, by FEATURES."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    symbols, upper, digits, marks, beyond, spaces, lower = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
    letters = upper + lower + beyond
    hashes = word_hashes(words)
    pairs = window_hashes(hashes, 2)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        np.log1p(n),
        min((size - spaces) / n, 64.0),
        symbols / size,
        upper / max(1, letters),
        digits / size,
        marks / size,
        beyond / size,
        spaces / size,
        np.count_nonzero(hashes[1:] == hashes[:-1]) / n,
        len(np.unique(hashes)) / n,
        Counter(words).most_common(1)[0][1] / n,
        len(np.unique(pairs)) / max(1, len(pairs)),
        1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        sum(x.rstrip()[-1:] not in b".!?:;" for x in lines) / len(lines),
    ]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, one float per feature) for every row of ``docs`` (doc_id, text)."""

    def run(batches):
        for part in text_slices(batches):
            rows = np.array([measure(t) for t in part.column("text").to_pylist()], dtype=np.float32)
            columns = [pa.array(rows[:, k]) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *FEATURES])

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{f} float" for f in FEATURES))


@dataclass
class Gam:
    """Bin edges, the table of each feature, and pairs (feature, feature, table over their coarse bins)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.tables:
            bins = self.binned(x)
            for k, table in enumerate(self.tables):
                total += table[bins[:, k]]
            for j, k, table in self.pairs:
                total += table[self.coarse[j][bins[:, j]], self.coarse[k][bins[:, k]]]
        return 1 / (1 + np.exp(-total))


def _best_cut(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins into two; place 0: none gains."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + penalty) + (all_g - left_g) ** 2 / (all_h - left_h + penalty)
    k = int(np.argmax(gain))
    better = float(gain[k] - all_g**2 / (all_h + penalty))
    return (better, k + 1) if better > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    """Leaf values over the bins of one feature: a cut, then one in each half."""
    step = np.zeros(len(g))
    _, k = _best_cut(g, h, penalty)
    for start, end in ((0, k), (k, len(g))):
        _, inner = _best_cut(g[start:end], h[start:end], penalty)
        for a, b in ((start, start + inner), (start + inner, end)):
            if b > a:
                step[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return step


def _cross(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree with one cut on each axis of a grid."""

    def quarters(x):
        c = x.cumsum(0).cumsum(1)
        corner, right, down, total = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [corner, right - corner, down - corner, total - right - down + corner]

    values = [q / (w + penalty) for q, w in zip(quarters(g), quarters(h), strict=True)]
    gain = sum(v * q for v, q in zip(values, quarters(g), strict=True)) - g.sum() ** 2 / (h.sum() + penalty)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.empty_like(g)
    for v, rows, columns in zip(values, (slice(i + 1), slice(i + 1), slice(i + 1, None), slice(i + 1, None)),
                                (slice(j + 1), slice(j + 1, None)) * 2, strict=True):
        step[rows, columns] = v[i, j]
    return float(gain[i, j]), step


def fit(x: np.ndarray, y: np.ndarray, spec: GamSpec = GamSpec()) -> Gam:  # noqa: B008
    """The model of rows ``x`` (by FEATURES) and labels ``y`` (0 or 1)."""
    ones = int(y.sum())
    if ones in (0, len(y)):
        share = ones / len(y) if len(y) else 0.5
        return Gam(float(np.log((share + 1e-6) / (1 - share + 1e-6))), [])
    order = np.lexsort((y, *x.T))  # one order of the rows, whatever order they came in
    x, y = x[order], y[order].astype(float)
    steps = np.linspace(0, 1, spec.bins + 1)[1:-1]
    model = Gam(float(np.log(ones / (len(y) - ones))), [np.unique(np.quantile(c, steps, method="lower")) for c in x.T])
    bins = model.binned(x)
    widths = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(w) for w in widths]
    model.coarse = [np.arange(w) * spec.pair_bins // w for w in widths]
    total = np.full(len(y), model.base)

    def sums(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)

    for _ in range(spec.rounds):
        for k, width in enumerate(widths):
            step = spec.rate * _tree(*sums(bins[:, k], width), spec.penalty)
            model.tables[k] += step
            total += step[bins[:, k]]

    side = spec.pair_bins
    cells = {
        (j, k): model.coarse[j][bins[:, j]] * side + model.coarse[k][bins[:, k]]
        for k in range(len(widths)) for j in range(k) if min(widths[j], widths[k]) > 1
    }

    def cross(at):
        g, h = sums(at, side * side)
        return _cross(g.reshape(side, side), h.reshape(side, side), spec.penalty)

    best = sorted(cells, key=lambda pair: (-cross(cells[pair])[0], pair))[: spec.pairs]
    grids = {pair: np.zeros((side, side)) for pair in best}
    for _ in range(spec.pair_rounds):
        for pair in best:
            step = spec.rate * cross(cells[pair])[1]
            grids[pair] += step
            total += step.ravel()[cells[pair]]
    model.pairs = [(j, k, grids[j, k]) for j, k in best]
    return model


def held_out(doc_id: Column) -> Column:
    """Whether the labels of a document are kept from learning: CRC-32 of the decimal id leaves 1 by 3."""
    remainder = F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def learned(measured: DataFrame, labels: DataFrame, spec: GamSpec = GamSpec()) -> Gam:  # noqa: B008
    """The model learned from the measured documents with a label of quality that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    rows = measured.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES, "label").limit(spec.max_rows)
    taken = rows.select(*FEATURES, "label").toArrow()
    x = np.stack([taken.column(f).to_numpy() for f in FEATURES], axis=1)
    return fit(x, taken.column("label").to_numpy(), spec)


def scored(measured: DataFrame, model: Gam) -> DataFrame:
    """(doc_id, score) of every measured document."""

    def run(batches):
        for batch in batches:
            x = np.stack([batch.column(f).to_numpy() for f in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return measured.mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, spec: GamSpec = GamSpec()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted."""
    measured = saved(features(docs), "features")
    found = scored(measured, learned(measured, labels, spec))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
