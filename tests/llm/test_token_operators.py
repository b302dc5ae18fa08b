"""Operators on token ids, against the libraries on whole texts."""

import hashlib
import struct
import uuid
import zlib
from collections import defaultdict

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from amphora.llm import byte_bpe, id_shards, packing, queries
from amphora.llm.encoders import EncoderSpec, read_ranks

WORD, BYTE = EncoderSpec(P.path("word_bpe_49k.json")), EncoderSpec(P.path("byte_bpe_50k.json"))
RANKS = EncoderSpec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD.path)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(RANKS.path), special_tokens={})


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_packing(request, library, table):
    df = request.getfixturevalue(table)
    pieces = packing.pack(df, WORD, open_windows=4, fan_in=2).collect()
    expected = sorted((r[0] is None, r[0] or 0, packed(ids_of(library, r[1]))) for r in rows_of(df))
    by_window = defaultdict(list)
    for p in pieces:
        by_window[p["sequence_id"]].append((p["offset"], p["length"]))
        assert len(p["ids"]) == 4 * p["length"]
    for window in by_window.values():
        at = 0
        for offset, length in sorted(window):
            assert offset == at
            at += length
        assert at <= 2048
    # Put the pieces of equal rows together again: every start has as many as there are rows.
    found = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["start"], p["ids"])):
        found[p["doc_id"]].append((p["start"], p["doc_tokens"], p["ids"]))
    total = sum(p["length"] for p in pieces)
    assert total == sum(len(e[2]) // 4 for e in expected)
    single = {d: v for d, v in found.items() if sum(e[1] == (d or 0) and e[0] == (d is None) for e in expected) == 1}
    whole = {(d is None, d or 0): b"".join(x[2] for x in v) for d, v in single.items()}
    assert all(whole.get((e[0], e[1]), e[2]) == e[2] for e in expected)
    assert len(by_window) * 2048 <= 1.35 * total + 2048 * 4


def test_open_windows_best_fit():
    windows = packing.OpenWindows(10, 2)
    assert windows.put(6) == (0, 0, None)
    assert windows.put(7) == (1, 0, None)
    assert windows.put(3) == (1, 7, None)  # room 3 fits better than room 4
    assert windows.put(8) == (2, 0, 1)  # none fits: the fullest goes
    assert windows.put(4) == (0, 6, None)


def test_packing_empty(spark, edge):
    assert packing.pack(edge.limit(0), WORD).collect() == []


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_id_shards(request, spark, library, table, tmp_path):
    df = request.getfixturevalue(table)
    path = str(tmp_path / uuid.uuid4().hex)
    id_shards.write_id_shards(df, WORD, path, shard_ids=3000)
    got = id_shards.read_id_shards(spark, path).collect()
    expected = sorted((r[0] is not None, r[0] or 0, packed(ids_of(library, r[1]))) for r in rows_of(df))
    assert sorted((r["key"] is not None, r["key"] or 0, r["ids"]) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["key"] for r in sorted(got, key=lambda r: r["start"])]
    assert [k for k in keys if k is not None] == sorted(k for k in keys if k is not None)
    some = id_shards.read_id_shards(spark, path, keys=[4, 9, -7, 10**12]).collect()
    assert sorted((r["key"], r["ids"]) for r in some) == sorted((e[1], e[2]) for e in expected if e[0] and e[1] in (4, 9))


def scans_of(df):
    """Rows that each file scan of an executed plan has given, and what it read."""
    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        elif "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName().startswith("Scan parquet"):
            yield node.metrics().apply("numOutputRows").value(), node.requiredSchema().fieldNames()
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))
    return [(rows, list(names)) for rows, names in walk(df._jdf.queryExecution().executedPlan())]


def test_one_key_reads_one_payload(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    id_shards.write_id_shards(documents.coalesce(1), WORD, path, shard_ids=3000)
    stored = {r["key"]: r for r in id_shards.read_id_shards(spark, path).collect()}
    assert spark.read.parquet(path).count() > 20
    for key in sorted(stored)[:: len(stored) // 4]:
        found = id_shards.find_keys(spark, path, [key])
        place = found.collect()
        assert [(r["key"], r["occurrence"], r["n_tokens"]) for r in place] == [(key, 0, stored[key]["n_tokens"])]
        assert all("payload" not in names and "keys" not in names for _, names in scans_of(found))
        payload = id_shards.payloads(spark, path, found)
        assert len(payload.collect()) == 1
        assert [rows for rows, names in scans_of(payload) if "payload" in names] == [1]
        assert id_shards.read_id_shards(spark, path, keys=[key]).collect() == [stored[key]]
    every = id_shards.read_id_shards(spark, path, keys=[k for k in stored if k is not None]).collect()
    assert sorted(every) == sorted(r for k, r in stored.items() if k is not None)
    assert id_shards.read_id_shards(spark, path, keys=[]).collect() == []


def test_more_shards_than_named(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(id_shards, "NAMED", 2)
    path = str(tmp_path / "shards")
    id_shards.write_id_shards(documents, WORD, path, shard_ids=3000)
    stored = {r["key"]: r for r in id_shards.read_id_shards(spark, path).collect()}
    some = sorted(k for k in stored if k is not None)[::7]
    assert sorted(id_shards.read_id_shards(spark, path, keys=[*some, -5]).collect()) == [stored[k] for k in some]


def test_ranks_of_blocks():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 2, 300, 20_000):
        hashes = id_shards.mix(rng.integers(0, 1 << 62, n), 1)
        levels = id_shards.PerfectHash.build(hashes)
        before, plain = 0, np.full(n, -1)
        for number, level in enumerate(levels):
            bits = np.unpackbits(np.frombuffer(level, dtype=np.uint8))
            at = (id_shards.mix(hashes, 3 + number) % np.uint64(len(bits))).astype(int)
            hit = (plain < 0) & (bits[at] == 1)
            plain[hit] = (before + np.cumsum(bits) - bits)[at[hit]]
            before += int(bits.sum())
        assert (id_shards.PerfectHash(levels).slots(hashes) == plain).all()


def test_perfect_hash_is_minimal():
    import numpy as np

    hashes = id_shards.mix(np.arange(5000), 1)
    index = id_shards.PerfectHash(id_shards.PerfectHash.build(hashes))
    assert sorted(index.slots(hashes).tolist()) == list(range(5000))
    others = id_shards.mix(np.arange(10**6, 10**6 + 5000), 1)
    slots = index.slots(others)
    stored = np.empty(5000, dtype="<u4")
    stored[index.slots(hashes)] = id_shards.fingerprints_of(hashes)
    taken = (slots >= 0) & (stored[np.maximum(slots, 0)] == id_shards.fingerprints_of(others))
    assert taken.sum() == 0


def test_id_shards_empty(spark, edge, tmp_path):
    path = str(tmp_path / "empty")
    id_shards.write_id_shards(edge.limit(0), WORD, path)
    assert id_shards.read_id_shards(spark, path).collect() == []


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_byte_bpe(request, tik, table):
    df = request.getfixturevalue(table)
    encoded = byte_bpe.encode(df, RANKS, with_offsets=True, offsets_digest=True)
    assert encoded.columns[:2] == ["doc_id", "text"]
    got = byte_bpe.decode(encoded, RANKS.path).select("text", "ids", "decoded", "starts", "ends", "n_split", "offsets_crc32").collect()
    assert len(got) == df.count()
    for r in got:
        text = r["text"] or ""
        assert r["ids"] == tik.encode_ordinary(text)
        assert r["offsets_crc32"] == zlib.crc32(packed(r["starts"] + r["ends"]))
        assert bytes(r["decoded"]).decode() == text
        at = split = 0
        for i, a, b in zip(r["ids"], r["starts"], r["ends"]):
            token = tik.decode_single_token_bytes(i)
            before, through = text.encode()[:at], text.encode()[: at + len(token)]
            assert a == len(before.decode(errors="ignore"))
            inside = through.decode(errors="ignore").encode() != through
            assert b == len(through.decode(errors="ignore")) + inside
            split += inside
            at += len(token)
        assert r["n_split"] == split


def test_byte_bpe_split_characters(spark):
    df = byte_bpe.encode(spark.createDataFrame([("日本語 ok",)], "text string"), RANKS)
    cut = df.selectExpr("slice(ids, 1, 1) AS ids")
    r = byte_bpe.decode(cut, RANKS.path).select(byte_bpe.decoded_text("decoded").alias("t"), "decoded").collect()[0]
    assert r["t"] == bytes(r["decoded"]).decode(errors="replace")


def test_byte_bpe_nulls(spark):
    df = byte_bpe.encode(spark.createDataFrame([(None,), ("a",)], "text string"), RANKS, null_as_empty=False, offsets_digest=True)
    assert {r["offsets_crc32"] for r in df.collect()} == {None, zlib.crc32(packed([0, 1]))}
    assert {r["decoded"] and bytes(r["decoded"]) for r in byte_bpe.decode(df, RANKS.path).collect()} == {None, b"a"}


def test_queries_of_token_operators(spark, library, tik):
    sf_dir = "/root/testdata/sf0.001"
    docs = dict(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    at = 0
    for r in sorted(queries.op3_id_shards(spark, sf_dir).collect(), key=lambda r: r["doc_id"]):
        ids = ids_of(library, docs[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(packed(ids)))
        at += len(ids)
    for r in queries.op1_packing(spark, sf_dir).collect():
        ids = ids_of(library, docs[r["doc_id"]])
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(packed(ids[r["start"] : r["start"] + r["length"]]))
    for r in queries.op8_byte_bpe(spark, sf_dir).collect():
        ids = tik.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
