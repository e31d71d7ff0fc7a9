import base64
import hashlib
import os

import pytest

from jsonmart.llm import warc
from jsonmart.scratch import fresh_dir
from llm_fixtures import *  # noqa: F403

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
ROWS = [
    (1, "u1", "hello"),
    (2, "u\r\n2", "hello"),
    (3, None, ""),
    (4, "x", None),
    (5, "m", f"payload {FAKE * 3} é tail WARC/1.0\r\n"),
    (6, "y", "WARC/1.0\r\n"),
    (None, "n", "hello"),
    (7, "z", "WARC/1.0\r\n"),
    (7, "z", "WARC/1.0\r\n"),
    (8, "w", "WARC/1.0\r\nContent-Length: 900\r\n\r\n" + "x" * 2000),
    (9, "long", "word " * 20000),
    (10, "ends", "text\r\n\r\n"),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    out = []
    for i, url, payload in rows:
        size = len((payload or "").encode())
        same = [k for k, _, p in rows if (p or "") == (payload or "") and k is not None]
        keeper = max(same, default=None) if size >= min_bytes else None
        revisit = keeper is not None and i != keeper
        out.append((i, size, digest(payload), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


def read(spark, path):
    number = lambda x: None if x is None else int(x[10:-1]) if x[10:-1] else None
    rows = warc.read_records(spark, path).collect()
    return sorted(((number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows), key=str)


@pytest.fixture
def split_bytes(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split_bytes", ["97b", "300b", "1000b", "128m"], indirect=True)
@pytest.mark.parametrize("files", [1, 4])
def test_round_trip(spark, split_bytes, files):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(files)
    path = fresh_dir(spark, "warc")
    warc.write_archive(pages, path)
    assert read(spark, path) == expected(ROWS)


@pytest.mark.parametrize("min_bytes", [1, 6, 10**9])
def test_small_payloads_are_responses(spark, min_bytes):
    path = fresh_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame(ROWS, "page_id long, url string, html string"), path, min_bytes)
    assert read(spark, path) == expected(ROWS, min_bytes)


def test_sequential_reader_agrees(spark):
    """A plain walk over the bytes finds records at the same offsets, and nothing is left over."""
    path = fresh_dir(spark, "warc")
    pages = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, type string").coalesce(2)
    warc.write_archive(pages, path)
    offsets = {(r.file.removeprefix("file:").replace("///", "/"), r.offset) for r in warc.read_records(spark, path).collect()}
    walked = set()
    for name in os.listdir(path):
        if name.startswith("part-"):
            data, at = open(f"{path}/{name}", "rb").read(), 0
            while at < len(data):
                assert data[at : at + 10] == b"WARC/1.0\r\n"
                walked.add((f"{path}/{name}", at))
                head = data.index(b"\r\n\r\n", at)
                size = int(data[at:head].split(b"\r\nContent-Length: ")[1])
                assert data[head + 4 + size : head + 8 + size] == b"\r\n\r\n"
                at = head + 8 + size
    assert offsets == walked and len(walked) == len(ROWS)


def test_empty_table(spark):
    path = fresh_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_records(spark, path).count() == 0


def test_large_group_of_copies(spark):
    rows = [(k, f"u{k}", "same" if k % 3 else f"own {k}") for k in range(600)]
    path = fresh_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    assert read(spark, path) == expected(rows)


@pytest.mark.parametrize("stretch", [1 << 16, 100])
def test_many_pages_of_one_file_quote_the_magic(spark, tmp_path, monkeypatch, stretch):
    monkeypatch.setattr(warc, "_STRETCH_BYTES", stretch)
    quoted = [(k, None, f"page {k} " + "WARC/1.0\r\n" * (k % 4) + "x" * (k % 7 * 300)) for k in range(300)]
    warc.write_archive(spark.createDataFrame(quoted, "page_id long, url string, html string").coalesce(1), str(tmp_path / "a"))
    got = {r.record_id: (r.payload_bytes, r.payload_digest) for r in warc.read_records(spark, str(tmp_path / "a")).collect()}
    want = {f"<urn:page:{k}>": (len(h), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()) for k, _, h in quoted}
    assert got == want


def test_a_length_beyond_the_file_ends(spark, tmp_path):
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 900000000000000\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc"
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.warc").write_bytes(head.encode())
    rows = warc.read_records(spark, str(tmp_path / "b")).collect()
    assert [(r.record_id, r.payload_bytes, r.payload_digest) for r in rows] == [("<urn:page:1>", None, None)]
