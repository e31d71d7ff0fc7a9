"""WARC archives of pages: written with revisit records, read back by boundary-chain verification.

Writing. One record per page. Of the pages with equal payloads the one with the largest id keeps the payload
(response), the others point to it (revisit). Equal payloads are found by digest, with counts before the
shuffle; only digests that occur twice or more are joined back, salted, so no group of copies meets in one task.
Files are plain text written by Spark, a record's end being the line separator.

Reading. A payload may hold the very bytes that begin a record, so finding them proves nothing. Spark splits the
files at every occurrence, in parallel and wherever the file system keeps them. Each task takes each piece as a
candidate record, reads its header and emits where the next record would have to begin; chains inside a file split
are followed at once. Pointer jumping over the splits, from the start of each file, then keeps the candidates
that are reachable. What is not reachable is part of a payload and is put back into it.

Defined cases. Null html is an empty payload. A null url leaves out the header; line ends in a url are percent-
encoded. A null page_id is written as an empty id and never kept as the one others refer to. Repeated rows with
the largest id are all responses. Payloads smaller than ``min_bytes`` are all responses. An empty table gives an
archive without records. Archives must not be compressed as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, saved

MAGIC = "WARC/1.0\r\n"
_END = "\r\n\r\n"
_SALTS = 16


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of ``payload``: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _records(pages: DataFrame, min_bytes: int) -> DataFrame:
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("n_bytes", F.octet_length("payload").cast("long"))
    equal = rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    equal = equal.where("n > 1 AND keeper IS NOT NULL").select("digest", "keeper")
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    equal = checked_broadcast(saved(equal.withColumn("salt", salts), "copies"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int"))
    return rows.join(equal, ["digest", "salt"], "left")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """``pages`` (page_id, url, html) as WARC files in the folder ``path``."""
    rows = _records(pages, min_bytes)
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(_END),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    rows = rows.withColumn("block", http)
    uri = F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.col("url"), F.lit("\r\n"))).otherwise("")
    refers = F.when(
        revisit,
        F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
            F.col("keeper").cast("string"),
            F.lit(">\r\n"),
        ),
    ).otherwise("")
    record = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\n"),
        uri,
        refers,
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(_END),
        F.col("block"),
    )
    rows.select(record.alias("value")).write.option("lineSep", _END).text(path)


_PIECE = "path string, split long, start long, length long, next long, exit long, type string, id string, refers string, uri string, digest string, http_bytes long, payload_bytes long, payload_digest string"
_LENGTH = re.compile(rb"(?:^|\r\n)content-length:[ \t]*([0-9]+)[ \t]*(?=\r\n|\Z)", re.I)


def _field(head: bytes, name: bytes) -> str | None:
    m = re.search(rb"(?:^|\r\n)" + name + rb":[ \t]*([^\r\n]*)", head, re.I)
    return m[1].decode("utf-8", "replace").strip() if m else None


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _http_payload(block: bytes) -> tuple[int | None, bytes]:
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return None, block
    m = _LENGTH.search(head)
    return (int(m[1]) if m else None), payload


def _candidate(piece: bytes, start: int):
    """Header fields of the record that would begin before ``piece``; None if it has no whole header.

    Positions are those of pieces: one begins right after its magic.
    """
    at = piece.find(b"\r\n\r\n")
    m = _LENGTH.search(piece, 0, at) if at >= 0 else None
    if not m:
        return None
    head, body = piece[:at], at + 4
    end = body + int(m[1])
    whole = end + 4 <= len(piece)
    http, payload = _http_payload(piece[body:end])
    return {
        "next": start + end + 4 + len(MAGIC),
        "type": _field(head, b"WARC-Type"),
        "id": _field(head, b"WARC-Record-ID"),
        "refers": _field(head, b"WARC-Refers-To"),
        "uri": _field(head, b"WARC-Target-URI"),
        "digest": _field(head, b"WARC-Payload-Digest"),
        "http_bytes": http,
        "payload_bytes": len(payload) if whole else None,
        "payload_digest": _digest(payload) if whole else None,
    }


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"),
    )


def _candidates(batches):
    """Pieces of each file split with positions from the split's first piece, and where their chains leave it."""
    names = [c.split()[0] for c in _PIECE.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in _PIECE.split(", ")]
    held: list[dict] = []
    where, at = None, 0

    def flush():
        place = {row["start"]: row for row in held}
        for row in reversed(held):
            onward = place.get(row["next"])
            row["exit"] = onward["exit"] if onward and onward["exit"] is not None else row["next"]
        columns = [pa.array([row.get(n) for row in held], t) for n, t in zip(names, types, strict=True)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for path, split, value in zip(*(batch.column(c).to_pylist() for c in ("path", "split", "value")), strict=True):
            if (path, split) != where:
                if held:
                    yield flush()
                where, at = (path, split), 0
            row = {"path": path, "split": split, "start": at, "length": len(value), "next": None}
            row |= _candidate(value, at) or {}
            held.append(row)
            at += len(value) + len(MAGIC)
    if held:
        yield flush()


def _with_base(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``base``, the position in the file of each split's first piece."""
    size = F.sum(F.col("length") + len(MAGIC)).alias("size")
    splits = pieces.groupBy("path", "split").agg(size)
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).select("path", "split", "base")
    return pieces.join(checked_broadcast(saved(splits, "splits")), ["path", "split"])


def _reachable(candidates: DataFrame) -> DataFrame:
    """(path, start): where the chain from the start of each file enters a split.

    ``candidates`` has start and exit as positions in the file. Only targets of some chain can be entered; over
    these, reach and jumps double every round.
    """
    first = F.lit(len(MAGIC)).cast("long")
    targets = candidates.select("path", F.col("exit").alias("start")).distinct()
    jumps = candidates.join(targets, ["path", "start"], "left_semi").select("path", "start", "exit")
    starts = candidates.where(F.col("start") == first).select("path", "start", "exit")
    jumps = saved(jumps.union(starts).distinct(), "jumps")
    reach = saved(starts.select("path", "start"), "reach")
    size = reach.count()
    while True:
        hop = reach.join(jumps, ["path", "start"]).select("path", F.col("exit").alias("start"))
        hop = hop.join(jumps.select("path", "start"), ["path", "start"], "left_semi")
        reach = saved(reach.union(hop).distinct(), "reach")
        grown = reach.count()
        if grown == size:
            return reach
        size = grown
        onward = jumps.select("path", F.col("start").alias("exit"), F.col("exit").alias("far"))
        jumps = jumps.join(onward, ["path", "exit"], "left").select("path", "start", F.coalesce("far", "exit").alias("exit"))
        jumps = saved(jumps, "jumps")


def _walk(entries: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates on the chains from ``entries`` inside their splits; one split's candidates at a time."""
    entered = entries.withColumnRenamed("start", "entry").join(
        candidates.select("path", "split", F.col("start").alias("entry")), ["path", "entry"]
    )
    links = candidates.select("path", "split", "start", "next")
    links = links.join(entered, ["path", "split"])

    def follow(frame):
        onward = dict(zip(frame["start"], frame["next"], strict=True))
        found, at = [], int(frame["entry"].iloc[0])
        while at in onward:
            found.append(at)
            at = onward[at]
        return frame.iloc[[0] * len(found)][["path"]].assign(start=found)

    return links.groupBy("path", "split").applyInPandas(follow, "path string, start long")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in ``path``: file, offset, type, record id, uri, refers_to, digests and sizes.

    payload_bytes and payload_digest come from the payload as read; a revisit, which has none, has the size
    that its HTTP header and the digest that its WARC header state.
    """
    found = saved(_pieces(spark, path).mapInArrow(_candidates, _PIECE), "pieces")
    placed = _with_base(found)
    placed = placed.select(
        "*", *[(F.col(c) + F.col("base")).alias(f"{c}_at") for c in ("start", "next", "exit")]
    ).drop("start", "next", "exit", "base")
    placed = saved(placed.withColumnsRenamed({"start_at": "start", "next_at": "next", "exit_at": "exit"}), "placed")
    candidates = placed.where("start > 0 AND next IS NOT NULL")
    records = _walk(_reachable(candidates), candidates).join(candidates, ["path", "start"])
    records = saved(records, "records")
    broken = records.where("payload_digest IS NULL")
    if not broken.isEmpty():
        records = records.where("payload_digest IS NOT NULL").unionByName(_mended(spark, path, placed, broken))
    revisit = F.col("type") == "revisit"
    return records.select(
        F.col("path").alias("file"),
        (F.col("start") - len(MAGIC)).alias("offset"),
        F.col("type").alias("record_type"),
        F.col("id").alias("record_id"),
        F.col("uri").alias("url"),
        F.col("refers").alias("refers_to"),
        F.when(revisit, F.col("http_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("digest", "^sha1:", "")).otherwise(F.col("payload_digest")).alias("payload_digest"),
    )


#: A file is cut into stretches of so many bytes, on which pieces and the records around them are joined.
_STRETCH_BYTES = 1 << 16


def _stretch(position: Column) -> Column:
    return F.floor(position / F.lit(_STRETCH_BYTES)).cast("long")


def _mended(spark: SparkSession, path: str, placed: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds the magic, put together again from their pieces and measured."""
    ends = placed.groupBy("path").agg(F.max("start").alias("last"))  # a length may reach beyond its file
    spans = broken.select("path", F.col("start").alias("head"), "next").join(checked_broadcast(saved(ends, "ends")), "path")
    stretch = F.sequence(_stretch(F.col("head")), _stretch(F.least(F.col("next") - 1, F.greatest("head", "last"))))
    spans = spans.withColumn("stretch", F.explode(stretch)).drop("last")
    spans = checked_broadcast(saved(spans, "broken"))
    base = placed.groupBy("path", "split").agg(F.min("start").alias("base"))
    pieces = _pieces(spark, path).mapInArrow(_positions, "path string, split long, start long, value binary")
    pieces = pieces.join(checked_broadcast(saved(base, "bases")), ["path", "split"])
    pieces = pieces.select("path", (F.col("start") + F.col("base")).alias("start"), "value")
    inside = (F.col("start") >= F.col("head")) & (F.col("start") < F.col("next"))
    pieces = pieces.withColumn("stretch", _stretch(F.col("start")))
    parts = pieces.join(spans, ["path", "stretch"]).where(inside).drop("stretch")

    def join(frame):
        frame = frame.sort_values("start")
        whole = MAGIC.encode().join(frame["value"])
        size = int(frame["next"].iloc[0]) - int(frame["head"].iloc[0]) - len(MAGIC)
        fields = _candidate(whole[:size], 0)
        out = frame[["path", "head"]].head(1)
        return out.assign(bytes_=fields["payload_bytes"], digest_=fields["payload_digest"])

    measured = parts.groupBy("path", "head").applyInPandas(join, "path string, head long, bytes_ long, digest_ string")
    mended = broken.join(measured.withColumnRenamed("head", "start"), ["path", "start"])
    mended = mended.withColumn("payload_bytes", F.col("bytes_")).withColumn("payload_digest", F.col("digest_"))
    return mended.select(*broken.columns)


def _positions(batches):
    where, at = None, 0
    for batch in batches:
        starts = []
        for path, split, value in zip(*(batch.column(c).to_pylist() for c in ("path", "split", "value")), strict=True):
            if (path, split) != where:
                where, at = (path, split), 0
            starts.append(at)
            at += len(value) + len(MAGIC)
        arrays = [batch.column("path"), batch.column("split"), pa.array(starts, pa.int64()), batch.column("value")]
        yield pa.RecordBatch.from_arrays(arrays, ["path", "split", "start", "value"])
