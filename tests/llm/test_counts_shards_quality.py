"""Token counts, shards and quality rules against plain Python versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from amphora.llm import quality, queries, sharding, token_counts
from amphora.llm.encoders import EncoderSpec

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["documents", "edge"])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts(request, table, name):
    df, library = request.getfixturevalue(table), Tokenizer.from_file(P.path(name))
    got = token_counts.count_tokens(df, EncoderSpec(P.path(name)))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    expected = Counter((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows_of(df))
    assert Counter(tuple(r) for r in got.collect()) == expected


ODD_TEXTS = [
    "Съешь ещё этих мягких французских булок, да выпей чаю.",
    "没有空格的文本，也有标点。" * 200,
    "tab\tin\tthe middle\x00and a zero, \x7f\x0b too",
    "“curly quotes” — and it’s an ellipsis…don't",
    "e\u0301 a\u0308o\u0308 ﬁn\u200d\u00a0no-break  two\n\n \t spaces \u2003em",
    "<|endoftext|>glued<|endoftext|>на</s> <s>[UNK] русском<unk>",
    "🙂🙃👩‍👩‍👧 नमस्ते दुनिया ٣٤٥ ½ Ⅷ",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("special_as_text", [False, True])
def test_token_counts_beyond_latin(spark, name, special_as_text):
    spec = EncoderSpec(P.path(name), special_as_text=special_as_text)
    rng = random.Random(5)
    alphabet = "".join(ODD_TEXTS)
    texts = ODD_TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(300)]
    got = token_counts.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spec).collect()
    library = Tokenizer.from_file(P.path(name))
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = special_as_text
    expected = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["n_tokens"] for r in got} == expected


def test_pieces_of_text_without_spaces():
    text = ODD_TEXTS[1]
    pieces, flat, at = token_counts.piece_table(queries.BYTE_BPE.load(), [text])
    assert len(pieces) <= 6 and at.tolist() == [0, len(flat)] and len(flat) >= 400
    assert "".join(pieces[i] for i in flat) == text


def test_token_counts_names(edge):
    with pytest.raises(ValueError):
        token_counts.count_tokens(edge.withColumnRenamed("doc_id", "n_tokens"), queries.BYTE_BPE, "n_tokens")


def test_token_counts_empty(edge):
    assert token_counts.count_tokens(edge.limit(0), queries.BYTE_BPE).collect() == []


# ------------------------------------------------------------ shards


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_shards(request, table):
    df = request.getfixturevalue(table)
    got = sharding.shard_by_bytes(df, n_shards=6).collect()
    size = lambda t: len((t or "").encode()) + 8
    expected = Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t in rows_of(df))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
    assert set(shards) <= set(range(6))
    last = None
    for shard in sorted(shards):
        rows = sorted(shards[shard], key=lambda r: r["slot"])
        assert [r["slot"] for r in rows] == list(range(len(rows)))
        keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
        assert keys == sorted(keys) and (last is None or keys[0] >= last)
        last = keys[-1]
    if table == "documents":
        sizes = [sum(r["size"] for r in rows) for rows in shards.values()]
        # Each cut is at most half a document from its place.
        assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)


def test_shards_of_a_hot_key(spark):
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS doc_id", "repeat('x', CAST(id % 50 AS INT)) AS text").repartition(5)
    sizes = [r["b"] for r in sharding.shard_by_bytes(df, n_shards=10, ranges=16).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 10 and max(sizes) <= 1.02 * min(sizes)


def test_shards_empty(edge):
    assert sharding.shard_by_bytes(edge.limit(0)).collect() == []


def test_range_numbers():
    bounds = [(2, 5), (4, 0), (4, 9), (8, 1)]
    keys, places = np.array([1, 2, 2, 4, 4, 4, 7, 8, 9]), np.array([9, 4, 5, 0, 8, 9, 0, 0, 0])
    assert sharding.range_numbers(keys, places, bounds).tolist() == [sum(b <= (k, p) for b in bounds) for k, p in zip(keys, places)]


# ------------------------------------------------------------ quality rules


def measures(text):
    text = text or ""
    words, lines = WORDS.findall(text), [x for x in text.split("\n") if WORDS.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_upper": len(re.findall("[A-Z]", text)),
        "n_marks": text.count("!"), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def rejected(m):
    return (
        m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] or not 3 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"]
        or 10 * m["n_symbols"] > m["n_words"] or 2 * m["n_upper"] > m["word_chars"] or 2 * m["n_marks"] > m["n_words"] or 2 * m["n_dup_lines"] > m["n_lines"]
    )


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_measures_and_verdicts(request, table):
    df = request.getfixturevalue(table)
    got = quality.screen(df, measured=list(quality.MEASURES)).collect()
    assert len(got) == df.count()
    for r in got:
        m = measures(r["text"])
        assert {k: r[k] for k in m} == m
        assert (r["rejected_by"] is not None) == rejected(m)
    plain = quality.screen(df)
    assert plain.columns == [*df.columns, "rejected_by"]
    assert sum(r["rejected_by"] is None for r in plain.collect()) == sum(not rejected(measures(t)) for _, t in rows_of(df))


def test_repeats_of_texts_too_long_to_pack(spark, monkeypatch):
    monkeypatch.setattr(quality, "POSITION_BITS", 3)
    df = spark.createDataFrame([("a b c d a b c e a b c",), ("a a a a a a a a a a",), ("a b",), ("a b c d e f g h i j k l",)], "text string")
    got = [r["n"] for r in df.select(quality.n_repeat_words(F.col("text")).alias("n")).collect()]
    assert got == [9, 10, 0, 0]


def test_order_is_by_rejections_per_cost(documents):
    found = quality.estimate(documents)
    gains = [e.rejected / e.cost for e in found]
    assert gains == sorted(gains, reverse=True) and {e.rule.name for e in found} == {r.name for r in quality.RULES}
    assert quality.screen(documents.limit(0)).collect() == []


def test_a_very_long_text_is_kept(spark):
    df = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(1_000_001)))], "doc_id long, text string")
    got = quality.screen(df, measured=["n_words", "n_repeat_words"]).collect()
    assert [(r["n_words"], r["n_repeat_words"], r["rejected_by"]) for r in got] == [(1_000_001, 0, None)]


def test_rules_keep_documents_of_good_quality(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good = quality.screen(docs.join(labels.where("quality = 1"), "doc_id"), measured=["n_words", "n_repeat_words"]).where("n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words")
    assert good.where("rejected_by IS NOT NULL").count() <= 0.002 * good.count()


def test_no_python_in_the_rules(documents):
    plan = quality.screen(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
