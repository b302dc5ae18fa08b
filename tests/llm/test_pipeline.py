"""The corpus pipeline, stage by stage, against plain Python versions."""

import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from amphora.llm import line_dedup, queries
from amphora.session import pin_table

from test_counts_shards_quality import measures, rejected
from test_dedup_operators import passages_removed, plain_fingerprint
from test_token_operators import ids_of, packed

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, documents):
    """Input and result of each stage, on documents with planted copies."""
    copies = documents.where("doc_id < 40").selectExpr("doc_id + 5000 AS doc_id", "concat(text, ' one more word') AS text", "lang", "source", "n_chars + 14 AS n_chars")
    docs, out = documents.unionByName(copies), {}
    for name, stage in pipeline.STAGES:
        result = pin_table(stage(spark, docs, None), name)
        out[name] = docs.collect(), result.collect(), result.columns
        docs = result
    return out


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_stages_return_the_columns_of_documents(results):
    assert [name for name, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
    for name, (_, rows, columns) in results.items():
        if name != "packing":
            assert columns == COLUMNS
            assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_quality_rules(results):
    before, after, _ = results["quality_rules"]
    assert by_id(after) == {r["doc_id"]: r for r in before if not rejected(measures(r["text"]))}


def test_quality_rules_keep_a_very_long_text(spark):
    docs = spark.range(1).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 1050000), x -> concat('w', x)), ' ') AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    assert [r["doc_id"] for r in pipeline.quality_rules(spark, docs, None).select("doc_id").collect()] == [0]


def test_line_dedup(spark, results):
    before, after, _ = results["line_dedup"]
    classes = line_dedup.line_classes(spark.createDataFrame(before)).collect()  # itself tested against a plain version
    gone = {(r["doc_id"], r["line_no"]) for r in classes if not r["kept"]}
    expected = {}
    for r in before:
        lines = r["text"].split("\n")
        kept = [x for n, x in enumerate(lines) if (r["doc_id"], n) not in gone]
        if len(kept) == len(lines) or any(x.strip() for x in kept):
            expected[r["doc_id"]] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in after} == expected
    assert len(gone) > 100


def test_simhash(results):
    before, after, _ = results["simhash_near_dedup"]
    rows = sorted(before, key=lambda r: r["doc_id"])
    prints = [plain_fingerprint(r["text"]) for r in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    assert by_id(after) == {rows[i]["doc_id"]: rows[i] for i in range(len(rows)) if root(i) == i}


def test_substring(results):
    before, after, _ = results["substring_dedup"]
    removed = passages_removed([(r["doc_id"], r["text"]) for r in before], 20)
    expected = {d: kept for d, [(n, gone, kept)] in removed.items() if not gone or gone < n}
    assert {r["doc_id"]: WORDS.findall(r["text"]) for r in after} == expected
    same = {r["doc_id"]: r["text"] for r in before}
    assert all(r["text"] == same[r["doc_id"]] for r in after if not removed[r["doc_id"]][0][1])


def test_packing(results):
    from tokenizers import Tokenizer

    before, after, _ = results["packing"]
    library = Tokenizer.from_file(queries.WORD_BPE.path)
    texts = {r["doc_id"]: ids_of(library, r["text"]) for r in before}
    assert Counter(r["doc_id"] for r in after if r["start"] == 0) == Counter(list(texts))
    assert sum(r["length"] for r in after) == sum(map(len, texts.values()))
    for r in after:
        ids = texts[r["doc_id"]]
        assert (r["doc_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(packed(ids[r["start"] : r["start"] + r["length"]])))


def test_run_is_the_stages_in_a_row(spark):
    sf_dir, docs = "/root/testdata/sf0.001", None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = pin_table(stage(spark, docs, sf_dir))
    pieces = lambda df: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert pieces(pipeline.run(spark, sf_dir)) == pieces(docs)


def test_edge_cases(spark, edge):
    for name, stage in pipeline.STAGES:
        assert stage(spark, edge.limit(0), None).count() == 0
        kept = stage(spark, edge, None)
        if name != "packing":
            assert kept.columns == edge.columns
            assert all(r["n_chars"] in (-1, None, len(r["text"] or "")) for r in kept.collect())


def test_registered_queries(spark):
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
