import datetime
import hashlib
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from amphora.functions.packed_rows import pack_rows, unpack_keys, unpack_rows
from amphora.operators import classifier as C
from amphora.operators.corpus import build_amp_database


def test_composition_and_numpy_embedder(spark):
    seqs = ["QVLLHQQALFGK", "kkww", "", "AAAB"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "id int, sequence string")
    jvm = {r.id: r.c for r in df.select("id", C.composition("sequence").alias("c")).collect()}
    py = {r.id: r.embedding for r in C.embed_with(df, "sequence", C.numpy_composition_embedder, 20)
          .collect()}
    for i in range(len(seqs)):
        assert np.allclose(jvm[i], py[i])
    assert abs(sum(jvm[0]) - 1.0) < 1e-12 and sum(jvm[2]) == 0.0


def test_split_is_deterministic(spark):
    df = spark.range(5000)
    a = C.split_dataset(df, "id").where("split = 'test'").select("id").collect()
    b = C.split_dataset(df.repartition(9), "id").where("split = 'test'").select("id").collect()
    assert sorted(a) == sorted(b) and 850 < len(a) < 1150


def test_negatives(spark):
    pos = spark.createDataFrame([("GLWSKIKE",), ("KKWWKK",), ("AAAAAAAAAAAA",)], "sequence string")
    neg = C.generate_negatives(spark, pos, 50, seed=3)
    rows = neg.collect()
    assert len(rows) == 50 and len({r.sequence for r in rows}) == 50
    assert all(6 <= len(r.sequence) <= 12 for r in rows)
    assert not {r.sequence for r in rows} & {"GLWSKIKE", "KKWWKK", "AAAAAAAAAAAA"}
    assert sorted(r.sequence for r in C.generate_negatives(spark, pos, 50, seed=3).collect()) == \
        sorted(r.sequence for r in rows)


def _brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y != 1]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_roc_auc_and_curve(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    auc = C.roc_auc(df).first().auc
    assert abs(auc - _brute_auc([r[1] for r in rows], [r[0] for r in rows])) < 1e-12
    curve = C.roc_curve(df).orderBy(F.col("threshold").desc()).collect()
    assert curve[-1].tpr == 1.0 and curve[-1].fpr == 1.0
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(curve, curve[1:]))


def test_classification_report(spark):
    rows = [(1, 1)] * 30 + [(1, 0)] * 10 + [(0, 0)] * 50 + [(0, 1)] * 10
    df = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r.metric: r for r in C.classification_report(df).collect()}
    assert abs(rep["1"].precision - 30 / 40) < 1e-12 and abs(rep["1"].recall - 30 / 40) < 1e-12
    assert abs(rep["0"].precision - 50 / 60) < 1e-12 and abs(rep["accuracy"].precision - 0.8) < 1e-12
    assert rep["weighted avg"].support == 100


def test_logistic_matches_objective(spark):
    """The MLlib fit minimises the C=1 L2 objective: its gradient is ~0."""
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 5))
    y = (X[:, 0] + 0.5 * X[:, 1] + rng.normal(scale=0.5, size=300) > 0).astype(int)
    df = spark.createDataFrame([(X[i].tolist(), int(y[i])) for i in range(300)], "f array<double>, label int")
    m = C.fit_logistic(df, "f", "label")
    w, b = m.coefficients.toArray(), m.intercept
    p = 1 / (1 + np.exp(-(X @ w + b)))
    grad_w = X.T @ (p - y) + w  # sklearn: 0.5||w||^2 + sum logloss
    grad_b = np.sum(p - y)
    assert np.max(np.abs(grad_w)) < 1e-3 and abs(grad_b) < 1e-3


def test_mean_pool(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, 5.0])], "g int, embedding array<double>")
    got = {r.g: r.pooled for r in C.mean_pool(df, ["g"]).collect()}
    assert got == {0: [2.0, 3.0], 1: [5.0, 5.0]}


def test_scorer_and_distinct(spark):
    peps = spark.createDataFrame([("KKWW",), ("KKWW",), ("DDEE",)], "peptide string")
    sc = C.prior_scorer()
    direct = sorted(r.amp_probability for r in C.score_peptides(peps, sc).collect())

    def score(df):
        emb = C.embed_with(df, "peptide", C.numpy_composition_embedder, 20)
        return emb.select("peptide", C.dot_probability("embedding", list(sc.weights), sc.bias)
                          .alias("amp_probability"))

    via = sorted(r.amp_probability for r in C.score_distinct(peps, score).collect())
    assert np.allclose(direct, via) and len(via) == 3
    assert build_amp_database  # imported API stays available


def test_exact_split_size(spark):
    df = spark.range(35897)
    out = C.split_dataset(df, "id", exact=True)
    assert out.where("split = 'test'").count() == 7180
    again = C.split_dataset(df.repartition(5), "id", exact=True).where("split = 'test'")
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in out.where("split = 'test'").collect())


def test_negatives_raise_when_too_few_exist(spark):
    import pytest

    pos = spark.createDataFrame([("AAA",)], "sequence string")
    # 20^3 - 1 sequences are free: more draws find 7 000 of them, 8 000 do not exist
    assert C.generate_negatives(spark, pos, 7_000, seed=1).select("sequence").distinct().count() == 7_000
    with pytest.raises(ValueError):
        C.generate_negatives(spark, pos, 8_000, seed=1)

def test_mean_pool_tokens(spark):
    # start token, two residues, end token; width 2
    df = spark.createDataFrame([([[9.0, 9.0], [1.0, 2.0], [3.0, 4.0], [7.0, 7.0]], 2)],
                               "tokens array<array<double>>, L int")
    assert C.mean_pool_tokens(df, "tokens", "L").first().pooled == [2.0, 3.0]


def test_embedding_scorer_needs_no_shuffle(spark):
    peps = spark.createDataFrame([("KKWW", 0), ("KKWW", 1), (None, 2), ("DDEE", 3), ("", 4)], "peptide string, i int")
    prior = C.prior_scorer()
    scorer = C.embedding_scorer(C.numpy_composition_embedder, 20, list(prior.weights), prior.bias)
    out = C.score_peptides(peps, scorer)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.i: r.amp_probability for r in out.collect()}
    want = {r.i: r.amp_probability for r in C.score_peptides(peps, prior).collect()}
    assert got.keys() == want.keys() and got[2] is None and want[2] is None
    assert all(abs(got[i] - want[i]) < 1e-12 for i in (0, 1, 3, 4))
    plain = {r.peptide: r.amp_probability for r in scorer(peps.where("peptide IS NOT NULL").select("peptide").distinct()).collect()}
    assert plain == {"KKWW": got[0], "DDEE": got[3], "": got[4]}
    assert peps.count() == C.embed_with(peps, "peptide", C.numpy_composition_embedder, 20).where("embedding IS NOT NULL OR i = 2").count()


def test_score_distinct_brings_peptides_together_once(spark):
    """An embedder sees each distinct peptide once in all, whatever the
    batches, and the rows are shuffled once and not joined."""
    rows = [(i, None if i % 50 == 0 else "K" * (1 + i % 7) + "WADE"[: i % 5]) for i in range(3000)]
    peps = spark.createDataFrame(rows, "i int, peptide string").repartition(6)
    embedded, composition = spark.sparkContext.accumulator(0), C.numpy_composition_embedder

    def make():
        embed = composition()

        def counted(seqs):
            embedded.add(len(seqs))
            return embed(seqs)

        return counted

    prior = C.prior_scorer()
    scorer = C.embedding_scorer(make, 20, prior.weights, prior.bias)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")  # a peptide's rows span batches
    try:
        out = C.score_distinct(peps, scorer)
        got = {r.i: r for r in out.collect()}
        assert embedded.value == len({p for _, p in rows if p is not None})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {r.i: r for r in C.score_distinct(peps, lambda distinct: scorer(distinct)).collect()}
    assert out.columns == ["peptide", "i", "amp_probability"] and got == want and len(got) == len(rows)
    assert C.score_distinct(peps, scorer, how="inner").count() == sum(p is not None for _, p in rows)
    assert "Join" not in out._jdf.queryExecution().toString()


def test_score_distinct_shuffles_packed_rows(spark):
    """A row takes a few bytes of the shuffle: one of its own was 20 and more."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("ACDEFGHIKLMNPQRSTVWY"), n)) for n in rng.integers(4, 30, 4000)]
    peptide = [words[i] for i in rng.integers(0, len(words), 60_000)]
    rows = pa.table({"accession_id": [f"doc_{i // 300}" for i in range(60_000)], "pos": pa.array([i % 300 for i in range(60_000)], pa.int32()), "peptide": peptide})
    rows = rows.combine_chunks().to_batches()[0]
    bucket = np.array([int(hashlib.md5(p.encode()).hexdigest(), 16) % 16 for p in peptide])
    assert sum(len(held) for _, held in pack_rows(rows, "peptide", bucket)) < 6 * len(peptide)
    prior = C.prior_scorer()
    peps = spark.createDataFrame([("KKWW", 0)], "peptide string, i int")
    out = C.score_distinct(peps, C.embedding_scorer(C.numpy_composition_embedder, 20, prior.weights, prior.bias))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(bucket" in plan and plan.count("Exchange") == 1


def test_packed_rows_come_back(spark):
    """Columns of any type, nulls, extremes and a clashing name; small chunks."""
    kinds = "peptide string, bucket long, s string, b binary, f double, ok boolean, l array<string>, d date, n decimal(20,3), t timestamp"
    day, now = datetime.date(2020, 2, 29), datetime.datetime(2020, 2, 29, 1, 2, 3, 4)
    rows = [(None if i % 7 == 0 else ("ÄK", "", "KW" * (i % 5), f"D{i}")[i % 4], (-(1 << 63), (1 << 63) - 1, i, 0)[i % 4], None if i % 3 else f"s{i % 9}", None if i % 11 else bytes([i % 256, 0]),
             None if i % 5 else i / 7, None if i % 2 else i % 4 == 0, None if i % 6 else ["x", None][: i % 3], None if i % 8 else day, None if i % 9 else Decimal(i) / 8, None if i % 10 else now) for i in range(700)]
    rows += [(None,) * 10, *rows[:5]]
    peps = spark.createDataFrame(rows, kinds).repartition(3)
    prior = C.prior_scorer()
    scorer = C.embedding_scorer(C.numpy_composition_embedder, 20, prior.weights, prior.bias)
    for df in (peps, peps.where("peptide IS NULL"), peps.where("false")):
        got, want = C.score_distinct(df, scorer), scorer.on_rows(df, "peptide")
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert Counter(map(repr, got.collect())) == Counter(map(repr, want.collect()))
    batch = pa.RecordBatch.from_pydict({"peptide": pa.array([r[0] for r in rows]), "s": pa.array([r[2] for r in rows])})
    bucket = np.array([0 if r[0] is None else len(r[0]) for r in rows])
    back = []
    for number, held in pack_rows(batch, "peptide", bucket):
        codes, (s,) = unpack_rows(held)
        keys = unpack_keys(held).to_pylist()
        assert len(set(keys)) == len(keys)
        back += [(number, None if c < 0 else keys[c], x) for c, x in zip(codes, s.to_pylist())]
    want = sorted(range(len(rows)), key=lambda i: bucket[i])
    assert back == [(bucket[i], rows[i][0], rows[i][2]) for i in want]
