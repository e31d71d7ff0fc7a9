"""Secret scan with a recursive decoding worklist.

A text is scanned for three kinds of secrets. Then every way in which a secret may be wrapped is undone, one
layer at a time. Percent escapes, Unicode escapes and character references are decoded over the whole layer; runs of
base64, also over several lines, give bytes. A run may be glued to a path or a name, so all four alignments are decoded.
Bytes are layers of their own: they are read as UTF-8, each byte that is not as its Latin character, and as UTF-16
where they alternate with zeros; wherever a compressed stream may begin in them (also in percent-escaped bytes), it is
expanded to further bytes. Each new layer goes on the worklist and is scanned and unwrapped like the first, until nothing
new appears. A layer that was seen before at the same place of the original is a cycle and is dropped. Every layer maps
its characters to the original text, so each finding has a span there: exact for escapes, to the base64 character for
base64, from the stream's first character to the end of the run for compressed text. Bytes are looked into only if they
hold twelve printable characters in a row, the least that any finding has, or a stream's first bytes.

The worklist holds iterators, so one layer of each depth is in memory. A stream that expands beyond ``max_layer_bytes``
is scanned in overlapping chunks of that size; ``n_streamed`` counts such streams. A stream within it is then found if
it ends in its chunk.

Spans are code points, end exclusive. Findings of the text itself (base) stay, whatever the layers add.

Defined cases. Null or empty text: no findings. Repeated rows and ids: each row is scanned on its own. Texts are
taken whole. A stream that breaks off gives what there is. Other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds in order, their patterns, and the least length of a finding (of the value, for assign).
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as a shorter run matches from no start
_MIN_VALUE, _MIN_ACCESS = 6, 20
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}(?:\\u[0-9A-Fa-f]{4})*|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&[A-Za-z]{2,8};")
#: A wrapped secret has 16 base64 characters at least: a keyword, a sign and six characters are twelve bytes.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of base64 of a wrapped run: full lines of one length, 16 at least, then a last one that is no longer.
_LINE_BREAK = re.compile(r"[ \t]*\r?\n[ \t]*")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: The first bytes of gzip, zlib, bzip2, xz and zstd streams.
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_PRINTABLE = re.compile(rb"[\t\r\n\x20-\x7e]{12}")
#: UTF-16 of twelve printable characters or more, low byte first or last.
_WIDE = re.compile(rb"(?:[\t\r\n\x20-\x7e]\x00){12,}|(?:\x00[\t\r\n\x20-\x7e]){12,}")
#: Visible ASCII with at least one percent escape, and what one byte of it is written as.
_UNIT = re.compile(r"%[0-9A-Fa-f]{2}|.", re.S)
_ESCAPED_DATA = re.compile(r"[!-$&-~]*%[0-9A-Fa-f]{2}(?:%[0-9A-Fa-f]{2}|[!-$&-~])*")

MAX_LAYER_BYTES = 16 << 20
#: Chunks of a long stream share so many bytes at most.
CHUNK_OVERLAP = 1 << 16

Span = tuple[int, int, int]  # start, kind, end


def find(text: str) -> list[Span]:
    """Findings of one layer, by start and kind."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= _MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


class _Layer:
    """A text and, for each of its characters, where it starts and ends in the original."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            n = len(self.text)
            return np.arange(n), np.arange(1, n + 1)
        return self.starts, self.ends

    def places(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends in the original of stretches from ``first`` to ``last``, both included."""
        return (first, last + 1) if self.starts is None else (self.starts[first], self.ends[last])

    def key(self) -> tuple:
        where = self.place(0, len(self.text)) if self.text else (0, 0)
        return hashlib.sha1(self.text.encode("utf-8", "surrogatepass")).digest(), where


def _replaced(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """``layer`` with every match of ``pattern`` decoded; None if nothing changes."""
    starts, ends = layer.arrays()
    parts, s_parts, e_parts, at, changed = [], [], [], 0, False
    for m in pattern.finditer(layer.text):
        pieces = decode(m[0])  # (character, offset in the match, end in the match)
        if pieces is None:
            continue
        changed = True
        parts += [layer.text[at : m.start()], "".join(p[0] for p in pieces)]
        s_parts += [starts[at : m.start()], starts[[m.start() + p[1] for p in pieces]]]
        e_parts += [ends[at : m.start()], ends[[m.start() + p[2] - 1 for p in pieces]]]
        at = m.end()
    if not changed:
        return None
    parts.append(layer.text[at:])
    return _Layer("".join(parts), np.concatenate([*s_parts, starts[at:]]), np.concatenate([*e_parts, ends[at:]]))


def _characters(data: bytes) -> tuple[str, np.ndarray, np.ndarray]:
    """Bytes as UTF-8, or by their Latin characters where they are not, with first byte and byte after of each character."""
    codes = np.frombuffer(data.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    raw = (codes >= 0xDC80) & (codes <= 0xDCFF)
    sizes = np.where(raw, 1, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))
    ends = np.cumsum(sizes)
    text = np.where(raw, codes - np.uint32(0xDC00), codes).astype("<u4").tobytes().decode("utf-32-le")
    return text, ends - sizes, ends


def _percent(run: str):
    text, starts, ends = _characters(bytes.fromhex(run.replace("%", "")))
    return list(zip(text, (3 * starts).tolist(), (3 * ends).tolist(), strict=True))


def _escape(run: str):
    if run[0] == "&":
        text = html.unescape(run)
        return None if text == run else [(c, 0, len(run)) for c in text]
    if run[1] == "u":
        units = [int(run[i + 2 : i + 6], 16) for i in range(0, len(run), 6)]
        text = b"".join(u.to_bytes(2, "big") for u in units).decode("utf-16-be", "replace")
        out, at = [], 0
        for c in text:
            size = 12 if ord(c) > 0xFFFF else 6
            out.append((c, at, min(at + size, len(run))))
            at = min(at + size, len(run) - 6)
        return out
    code = int(run[2:], 16)
    return [(chr(code), 0, len(run))] if code <= 0x10FFFF and not 0xD800 <= code < 0xE000 else None


class _Data:
    """Bytes and, for each of them, where it starts and ends in the original; streams of ``plain`` ones are not looked for."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, plain: bool = False):
        self.data, self.starts, self.ends, self.plain = data, starts, ends, plain

    def key(self) -> tuple:
        return hashlib.sha1(self.data).digest(), len(self.data), int(self.starts[0]), int(self.ends[-1])


def _promising(data: bytes) -> bool:
    return bool(_PRINTABLE.search(data) or _MAGIC.search(data) or _WIDE.search(data))


def _pieces(data: bytes, size: int, read: list[int]) -> Iterator[bytes]:
    """The content of the stream that ``data`` begins with, and of those that follow, in pieces of at most ``size`` bytes.

    ``read`` gets the number of bytes up to the end of each stream.
    """
    rest = data
    while rest:
        if rest[:4] == b"\x28\xb5\x2f\xfd":
            total = 0
            with zstandard.ZstdDecompressor().stream_reader(rest) as reader:
                while piece := reader.read(size):
                    total += len(piece)
                    yield piece
            if total > size:  # to find the end of the frame it would have to be held whole
                read.append(len(data))
                return
            opener = zstandard.ZstdDecompressor().decompressobj()
            opener.decompress(rest)
        elif rest[:2] == b"\x1f\x8b" or _MAGIC.match(rest[:2]):
            opener = zlib.decompressobj(31 if rest[:1] == b"\x1f" else 15)
            yield opener.decompress(rest, size)
            while not opener.eof and opener.unconsumed_tail:
                yield opener.decompress(opener.unconsumed_tail, size)
        elif rest[:3] == b"BZh" or rest[:6] == b"\xfd7zXZ\x00":
            opener = bz2.BZ2Decompressor() if rest[:1] == b"B" else lzma.LZMADecompressor()
            yield opener.decompress(rest, size)
            while not opener.eof and not opener.needs_input:
                yield opener.decompress(b"", size)
        else:
            return
        if not opener.eof:
            return
        read.append(len(data) - len(opener.unused_data))
        rest = opener.unused_data.lstrip(b"\0")


def _contents(data: bytes, limit: int, streamed: list[int], read: list[int]) -> Iterator[bytes]:
    """The content of a compressed run: whole, or beyond ``limit`` bytes in overlapping chunks."""
    held, cut = bytearray(), False
    try:
        for piece in _pieces(data, limit, read):
            held += piece
            if len(held) > limit:
                if not cut:
                    streamed.append(len(data))
                cut = True
                yield bytes(held)
                del held[: -min(CHUNK_OVERLAP, limit // 2)]
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        pass  # what came before the break stays
    if held:
        yield bytes(held)


def _views(layer: _Data, limit: int, streamed: list[int]) -> Iterator[_Layer | _Data]:
    """The contents of the streams in bytes, and the texts that the bytes outside of these may be."""
    data = layer.data
    opened = 0  # up to here a stream was read to its end, of which others are parts
    outside = bytearray(data)
    for m in () if layer.plain else _MAGIC.finditer(data):
        if m.start() < opened:
            continue
        start, end, read = layer.starts[m.start()], layer.ends[-1], [0]
        for content in _contents(data[m.start() :], limit, streamed, read):
            if _promising(content):
                opened = m.start() + read[-1]
                yield _Data(content, np.broadcast_to(start, len(content)), np.broadcast_to(end, len(content)))
        outside[m.start() : opened] = bytes(max(0, opened - m.start()))
    data = bytes(outside)
    if _PRINTABLE.search(data):
        text, first, after = _characters(data)
        yield _Layer(text, layer.starts[first], layer.ends[after - 1])
    for m in _WIDE.finditer(data):
        low = m.start() + (data[m.start()] == 0)
        text = data[low : m.end() : 2].decode("ascii")
        yield _Layer(text, layer.starts[m.start() : m.end() : 2], layer.ends[m.start() + 1 : m.end() : 2])


def _runs(text: str) -> Iterator[np.ndarray]:
    """Places of the characters of each base64 run: of lines that are wrapped, then of one line."""
    until = 0  # runs before it are lines of a wrapped run that was given
    for m in _BASE64.finditer(text):
        if m.start() < until or m[0][-1] == "=":
            yield np.arange(m.start(), m.end())
            continue
        places, width, at = [np.arange(m.start(), m.end())], m.end() - m.start(), m.end()
        while (gap := _LINE_BREAK.match(text, at)) and (line := _LINE.match(text, gap.end())):
            if line.end() - line.start() > width:
                break
            places.append(np.arange(line.start(), line.end()))
            at = line.end()
            if line.end() - line.start() < width or line[0][-1] == "=":
                break
        if len(places) > 1:
            until = at
            yield np.concatenate(places)
            if len(places[-1]) < width and text[at - 1] != "=":
                yield np.concatenate(places[:-1])  # the last line may be a word of what follows
        if len(places) != 2 or until != at or text[at - 1] == "=" or len(places[-1]) == width:
            yield places[0]


def _base64_data(layer: _Layer) -> Iterator[_Data]:
    """The bytes of each base64 run, at each of the four alignments."""
    table = str.maketrans("-_", "+/")
    until = -1  # end of the longest run so far; a part of it holds no stream that it does not
    for run in _runs(layer.text):
        plain, until = run[-1] <= until, max(until, run[-1])
        raw = "".join(layer.text[a : b + 1] for a, b in _stretches(run))
        body = raw.rstrip("=").translate(table)
        for skip in range(4):
            n = (len(body) - skip) * 3 // 4
            shifted = body[skip : skip + -(-n * 4 // 3)]
            try:
                data = base64.b64decode(shifted + "=" * (-len(shifted) % 4))
            except (binascii.Error, ValueError):
                continue
            if _promising(data):
                at = np.arange(len(data))
                first, last = run[skip + at * 4 // 3], run[skip + -(-(at + 1) * 4 // 3) - 1]
                last[-1] = run[-1]  # padding belongs to it
                yield _Data(data, *layer.places(first, last), plain)


def _percent_data(layer: _Layer) -> Iterator[_Data]:
    """The bytes of runs with percent escapes that may hold a compressed stream."""
    for m in _ESCAPED_DATA.finditer(layer.text):
        data = unquote_to_bytes(m[0])
        if _MAGIC.search(data):
            sizes = np.array([len(x) for x in _UNIT.findall(m[0])])
            after = m.start() + np.cumsum(sizes)
            yield _Data(data, *layer.places(after - sizes, after - 1))


def _unwrapped(layer: _Layer) -> Iterator[_Layer | _Data]:
    """All layers that one step of decoding gives."""
    text = layer.text
    if "%" in text:
        if (inner := _replaced(layer, _PERCENT, _percent)) is not None:
            yield inner
        yield from _percent_data(layer)
    if ("\\" in text or "&" in text) and (inner := _replaced(layer, _ESCAPE, _escape)) is not None:
        yield inner
    yield from _base64_data(layer)


def _stretches(places: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each row of neighbours among ``places``."""
    cuts = np.flatnonzero(np.diff(places) != 1)
    return list(zip(places[np.r_[0, cuts + 1]].tolist(), places[np.r_[cuts, len(places) - 1]].tolist(), strict=True))


def scan(text: str | None, limit: int = MAX_LAYER_BYTES) -> tuple[list[Span], list[Span], int]:
    """Base findings, all findings, and the number of streams read in chunks, of one text."""
    base = find(text) if text else []
    if not text or not ("%" in text or "\\" in text or "&" in text or _BASE64.search(text)):
        return base, base, 0
    spans, seen, streamed = set(base), set(), []
    first = _Layer(text)
    work: list[Iterator[_Layer | _Data]] = [iter((first,))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif (key := layer.key()) not in seen:
            seen.add(key)
            if isinstance(layer, _Data):
                work.append(_views(layer, limit, streamed))
                continue
            if layer is not first:
                for start, kind, end in find(layer.text):
                    a, b = layer.place(start, end)
                    spans.add((a, kind, b))
            work.append(_unwrapped(layer))
    return base, sorted(spans), len(streamed)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets(docs: DataFrame, max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base counts and digest, all spans."""

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base, spans, streamed = scan(text, max_layer_bytes)
                kinds = [kind for _, kind, _ in base]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                out.append((*(kinds.count(k) for k in range(3)), digest, written(spans), len(spans), streamed))
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans", "n_streamed"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long, n_streamed long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
