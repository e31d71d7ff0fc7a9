"""Fill-in-the-middle transformation by repeated-capture matching.

A text is a sequence of units (lines by default). One full match of ``(unit)*`` by the regex library, which keeps
every repetition of a group, gives the ends of all units at once: their number and both cut offsets are read off
``match.ends(1)`` without a loop over units. The parts between the cuts are written in another order with markers:
prefix-suffix-middle (psm) or suffix-prefix-middle (spm).

The choice of cuts and form follows from the document's id alone: the first four 32-bit groups of the SHA-256 of
``seed:id``. So a rerun, a lost executor or another partitioning gives the same output.

Defined cases. Null text is the empty text. Empty texts, texts that hold one of the markers and texts that the units do
not cover whole (0 units) stay plain. A null id counts as an empty one. Repeated rows are transformed each; other
columns are ignored. A text is one value of one row and is matched whole; its unit ends are held at that time.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices


@dataclass(frozen=True)
class FillMiddle:
    """``percent`` of the documents are transformed, ``spm_percent`` of these with the suffix first."""

    unit: str = r"[^\n]*\n|[^\n]+"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    percent: int = 100
    spm_percent: int = 50
    seed: int = 7


def matcher(spec: FillMiddle):
    """The pattern whose first group captures every unit; possessive, so a long text keeps no states to go back to."""
    import regex

    return regex.compile(f"({spec.unit})*+")


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    name = "" if doc_id is None else str(doc_id)
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{name}".encode()).digest()[:16])


def transform(text: str, doc_id: int | None, spec: FillMiddle, pattern) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    match = pattern.fullmatch(text)
    ends = match.ends(1) if match else []
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, spec.seed)
    if not n or h3 % 100 >= spec.percent or any(m in text for m in (spec.prefix, spec.suffix, spec.middle)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut, end = (ends[k - 1] if k else 0 for k in (first, second))
    before = spec.prefix + text[:cut]
    after = spec.suffix + text[end:]
    form = "spm" if h4 % 100 < spec.spm_percent else "psm"
    output = (after + before if form == "spm" else before + after) + spec.middle + text[cut:end]
    return n, form, cut, end - cut, output


def fill_in_middle(docs: DataFrame, spec: FillMiddle = FillMiddle()) -> DataFrame:  # noqa: B008
    """One row per row of ``docs`` (doc_id, text): doc_id, n, form, prefix_chars, middle_chars, output."""

    def run(batches):
        pattern = matcher(spec)
        for part in text_slices(batches):
            ids = part.column("doc_id")
            rows = zip(part.column("text").to_pylist(), ids.to_pylist(), strict=True)
            n, form, prefix, middle, output = zip(*(transform(t, i, spec, pattern) for t, i in rows), strict=True)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(output, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, spec: FillMiddle = FillMiddle()) -> Column:  # noqa: B008
    """The text from ``output`` and ``form`` alone; no transformed text holds a marker, so the first one found is it."""

    def cut(text: Column, marker: str) -> tuple[Column, Column]:
        head = F.substring_index(text, marker, 1)
        return head, F.substring(text, F.length(head) + len(marker) + 1, F.length(text))

    _, body = cut(output, spec.prefix)
    prefix, rest = cut(body, spec.suffix)
    suffix, middle = cut(rest, spec.middle)
    psm = F.concat(prefix, middle, suffix)
    _, body = cut(output, spec.suffix)
    suffix, rest = cut(body, spec.prefix)
    prefix, middle = cut(rest, spec.middle)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
