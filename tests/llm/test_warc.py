"""WARC archives, against plain Python over the same rows."""

import base64
import gzip
import hashlib
import uuid

import pytest

from amphora.llm import queries, warc

ROWS = [
    (1, "http://a", "same"), (5, "http://b", "same"), (3, None, "same"), (2, "http://c\r\nX: y", None), (9, "u", ""), (None, "n", "same"),
    (4, "u", "line\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nContent-Length: 3\r\n\r\n0\r\n\r\n"), (6, "u", "é" * 3000), (7, "u", "x" * 4096), (8, "u", "\n\n"),
    (10, "u", "twice"), (10, "v", "twice"), (11, "u", "\r\n"), (None, "only", "null ids"), (None, "only", "null ids"), (12, "ünï", "퟿漢字\n" * 999),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", True) for r in ROWS], "page_id long, url string, html string, payload string, last boolean")


def expected(rows, least=0):
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        known = [x for x in groups[data] if x is not None]
        first = max(known) if known and len(groups[data]) > 1 and len(data) >= least else None
        revisit = first is not None and i != first
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk, least", [(warc.CHUNK_BYTES, 0), (64, 0), (1000, 5)])
def test_round_trip(spark, pages, tmp_path, chunk, least):
    path = str(tmp_path / uuid.uuid4().hex)
    warc.write_warc(pages, path, chunk_bytes=chunk, min_revisit_bytes=least)
    chunks = warc.read_chunks(spark, path, chunk_bytes=chunk).cache()
    records = warc.records(chunks)
    assert found(records) == expected(ROWS, least)
    assert all(r["digest_holds"] for r in records.collect())
    # Chunks put together again are the payload, and the digest of each chunk is that of all before it too.
    by_record = {}
    for r in sorted((r for r in chunks.collect() if r["record_type"] == "response"), key=lambda r: r["chunk_no"]):
        by_record.setdefault((r["record_id"], r["target_uri"], r["declared_digest"]), []).append(r)
    for rows in by_record.values():
        data = b""
        if len({r["chunk_no"] for r in rows}) < len(rows):
            continue  # equal rows of one id
        for n, r in enumerate(rows):
            data += bytes(r["data"])
            assert r["chunk_no"] == n and len(r["data"]) <= chunk and r["last"] == (n == len(rows) - 1)
            assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    uris = {r["target_uri"] for r in records.collect()}
    assert "http://c%0D%0AX: y" in uris and None in uris


def test_empty(spark, pages, tmp_path):
    warc.write_warc(pages.limit(0), str(tmp_path / "none"))
    assert warc.records(warc.read_chunks(spark, str(tmp_path / "none"))).collect() == []


def record(kind, body, http=b"HTTP/1.0 200 OK\r\nX: y\r\n\r\n", kind_of="application/http; msgtype=response"):
    block = http + body
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nContent-Type: {kind_of}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Members a record, payloads as they are, records of other kinds."""
    bodies = [b"", b"\n", bytes(range(256)) * 40, b"a\r\n\r\nWARC/1.0\r\n"]
    parts = [record("warcinfo", b"software: x\r\n", b"", "application/warc-fields"), *[record("response", b) for b in bodies], record("request", b"", b"GET / HTTP/1.1\r\n\r\n")]
    (tmp_path / "one.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "two.warc").write_bytes(b"".join(parts[1:3]))
    rows = warc.records(warc.read_chunks(spark, str(tmp_path), chunk_bytes=100)).collect()
    want = sorted((len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()) for b in bodies + bodies[:2])
    assert sorted((r["payload_bytes"], r["payload_digest"]) for r in rows if r["record_type"] == "response") == want
    assert sorted(r["record_type"] for r in rows if r["record_type"] != "response") == ["request", "warcinfo"]


def test_cut_archive_raises(spark, tmp_path):
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(record("response", b"abcdef")[:-8]))
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_chunks(spark, str(tmp_path)).collect()


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = queries.op13_warc(spark, sf_dir)
    assert all(r["digest_holds"] for r in got.collect())
    assert found(got.withColumnRenamed("page_id", "id")) == expected(pages)
