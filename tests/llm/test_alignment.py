"""Cross-tokenizer alignment, against the libraries on whole texts."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from amphora.llm import alignment, queries

EDGE = ["", None, " ", "  ", "a", " a", "a ", "  two  spaces ", "▁", "x ▁y", "tab\tand\nline\r\n", "日本語 テキスト", "é é \U0001f600", "<|endoftext|> </s><0x41>", "a\x00b", "y" * 3000, "  nbsp   em",
        "don't  I'll\n\n é日本 ́x", "\x85 \x1c İΣ ß\r\n end", "same text here", "same text here", "﻿bom", "ﬁ ligature"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(queries.BYTE_BPE.path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def brute(libraries, rows):
    a, b = libraries
    back = {c: i for i, c in enumerate(alignment.aligner(queries.BYTE_BPE_TEXT, queries.PIECES).a.chars)}
    pairs, told = Counter(), []
    for i, text in rows:
        links, groups, a_ids, b_ids = [], [], [], []
        if text:
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            spell_a = [bytes([back[c] for c in a.id_to_token(x)]) for x in a_ids]
            spell_b = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in b_ids]
            if not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
                a_ids, b_ids = [], []
            ends = []
            for spell in (spell_a, spell_b):
                at, own = 0, {}
                for k, t in enumerate(spell):
                    at += len(t)
                    own[at] = k
                ends.append(own)
            if a_ids:
                i0 = j0 = 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    k, m = ends[0][end], ends[1][end]
                    links.append((a_ids[k], b_ids[m]))
                    groups.append(",".join(map(str, a_ids[i0 : k + 1])) + "|" + ",".join(map(str, b_ids[j0 : m + 1])))
                    i0, j0 = k + 1, m + 1
        pairs.update(links)
        told.append((i, len(a_ids), len(b_ids), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a_ids else ""))
    most = Counter()
    for (x, y), n in pairs.items():
        most[y] = max(most[y], n)
    return sorted(((i, na, nb, ng, len(ls), sum(pairs[x] == most[x[1]] for x in ls), sum(pairs[x] for x in ls), h) for i, na, nb, ng, ls, h in told), key=str)


def found(df, key="doc_id"):
    return sorted(((r[key], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [alignment.BLOCK_BYTES, 40])
def test_edges(spark, libraries, block):
    rows = [(i if i != 7 else None, t) for i, t in enumerate(EDGE)] + [(3, "other text of id 3")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n_a int, key string")
    got = alignment.align(df, queries.BYTE_BPE_TEXT, queries.PIECES, block_bytes=block)
    assert found(got) == brute(libraries, rows)


def test_each_chunk_path_equals_whole_texts(libraries):
    """Models with pieces beyond a space take whole texts; both give the same."""
    own = alignment.Aligner(queries.BYTE_BPE_TEXT, queries.PIECES)
    assert not own.b.over_spaces
    import numpy as np
    import pyarrow as pa

    texts = [t for t in dict.fromkeys(EDGE) if t]
    keys = [bytes([i]) * 16 for i in range(len(texts))]
    one = own.block(0, keys, pa.array(texts), np.ones(len(texts), dtype=np.int64))
    own.b.over_spaces = True
    two = own.block(0, keys, pa.array(texts), np.ones(len(texts), dtype=np.int64))
    weights = lambda row: {p: w for p, w in zip(row["pairs"].tolist(), row["weights"].tolist()) if w}
    assert one["hashes"] == two["hashes"] and weights(one) == weights(two)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df, queries.BYTE_BPE_TEXT, queries.PIECES).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert found(alignment.align(nothing, queries.BYTE_BPE_TEXT, queries.PIECES)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, libraries):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(queries.op12_alignment(spark, sf_dir)) == brute(libraries, rows)


def test_pair_counts(spark, libraries):
    df = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, "two")], "doc_id long, text string")
    rows = alignment.pair_counts(alignment.align_texts(df, queries.BYTE_BPE_TEXT, queries.PIECES)).collect()
    a, b = libraries
    assert {(a.id_to_token(r["a_id"]), b.id_to_piece(r["b_id"])): (r["n"], r["best"]) for r in rows} == {("Ġone", "▁one"): (2, True), ("Ġtwo", "▁two"): (3, True)}
