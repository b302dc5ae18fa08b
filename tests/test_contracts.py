"""Null values, wider inputs and lazy plans, each against a plain version."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from amphora.functions import residues as R
from amphora.operators import bandit as B
from amphora.operators import classifier as C
from amphora.operators.ranking import global_rank, pivot_matrix
from amphora.operators.running import running
from amphora.plans import combination_screening as Q
from amphora.sources.fasta import read_fasta


@pytest.fixture()
def many_partitions(spark):
    """Sorted data stays in several partitions, so that carries are needed."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _rows(kind):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        key = None if rng.random() < 0.4 else rng.choice(["hot"] * 8 + ["a", "b"])
        value = rng.randint(-5, 9) if rng.random() < 0.6 else None
        if kind == "leading" and i < 2000 or kind == "trailing" and i > 500 or kind == "all":
            value = None
        rows.append((key, i, value))
    return rows


@pytest.mark.parametrize("kind", ["mixed", "leading", "trailing", "all"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_with_nulls_over_partitions(spark, many_partitions, kind, keys):
    df = spark.createDataFrame(_rows(kind), "k string, t int, v int").repartition(5)
    order = [F.col("t").asc()]
    aggs = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "lo": ("min", F.col("v")), "n": ("sum", F.lit(1))}
    got = running(df, order, aggs, keys=keys)
    pinned = df.orderBy(*[F.col(k) for k in keys], *order).select(F.spark_partition_id().alias("p"), "k")
    assert pinned.select("p").distinct().count() > 4
    if keys:
        assert pinned.groupBy("k").agg(F.countDistinct("p").alias("n")).agg(F.max("n")).first()[0] > 2
    w = Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.select("k", "t", F.sum("v").over(w), F.max("v").over(w), F.min("v").over(w), F.count("*").over(w))
    assert sorted(map(tuple, got.select("k", "t", "s", "m", "lo", "n").collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_global_rank_over_partitions(spark, many_partitions):
    df = spark.range(4000).selectExpr("id", "id * 7919 % 1009 AS v").repartition(6)
    got = {r["id"]: r["rank"] for r in global_rank(df, [F.col("v").desc(), F.col("id").asc()]).collect()}
    rows = sorted(((-r["v"], r["id"]) for r in df.collect()))
    assert got == {i: n for n, (_, i) in enumerate(rows, 1)}


def test_properties_in_either_case(spark):
    df = spark.createDataFrame([("qvllhqqalfgk",), ("QVLLHQQALFGK",), ("",), (None,)], "p string")
    rows = df.select(R.net_charge("p"), R.hydrophobic_fraction("p"), R.aromatic_fraction("p"), R.simple_amp_score("p"), C.prior_scorer().logit("p")).collect()
    assert rows[0] == rows[1] and (rows[0][0], rows[0][1], rows[0][3]) == (2, 0.5, 5)
    assert abs(rows[0][2] - 1 / 12) < 1e-12


def test_matrix_raises_on_missing_labels(spark):
    df = spark.createDataFrame([("r1", "a", 1.0), ("r1", "b", 2.0), ("r2", "a", 3.0)], "r string, c string, v double")
    assert sorted(map(tuple, pivot_matrix(df, "r", "c", "v", ["a", "b"]).collect())) == [("r1", 1.0, 2.0), ("r2", 3.0, None)]
    assert pivot_matrix(df, "r", "c", "v", ["a", "b"], ["r2", "r1"]).count() == 2
    for columns, rows in ((["a", "b", "x"], None), (["a"], None), (["a", "b"], ["r1", "r2", "r3"]), (["a", "b"], ["r1"])):
        with pytest.raises(Exception, match="column|row"):
            pivot_matrix(df, "r", "c", "v", columns, rows).collect()


def test_embedder_takes_nulls_and_long_sequences(spark, monkeypatch):
    monkeypatch.setattr(C, "EMBED_CHARS", 10)
    df = spark.createDataFrame([(i, s) for i, s in enumerate([None, "AAC", "", "A" * 50, "CC", None, "KA"])], "i int, s string")
    got = {r["i"]: r["embedding"] for r in C.embed_with(df, "s", C.numpy_composition_embedder, 20).collect()}
    assert got[0] is None and got[5] is None and sum(got[2]) == 0
    assert abs(got[1][C.ALPHABET.index("A")] - 2 / 3) < 1e-12 and got[3][C.ALPHABET.index("A")] == 1


def test_mean_pool_of_a_sequence_without_residues(spark):
    df = spark.createDataFrame([([[9.0, 9.0], [1.0, 2.0], [3.0, 4.0], [8.0, 8.0]], 2), ([[9.0, 9.0], [8.0, 8.0]], 0)], "t array<array<double>>, n int")
    assert [r["pooled"] for r in C.mean_pool_tokens(df, "t", "n").collect()] == [[2.0, 3.0], [0.0, 0.0]]


def test_assignment_answers_every_request(spark):
    values = spark.createDataFrame([(1, "b", 0.5), (1, "c", 0.5), (2, "a", 0.1)], "run_id long, action_id string, value double")
    requests = spark.range(600).selectExpr("id AS request_id", "id % 3 AS run_id")
    got = B.assign_actions(requests, values, 0.5, action_ids=["a", "b", "c", "d"]).collect()
    assert len(got) == 600
    assert {r["action_id"] for r in got if r["explore"]} == {"a", "b", "c", "d"}
    assert {(r["run_id"], r["action_id"]) for r in got if not r["explore"]} == {(0, "a"), (1, "b"), (2, "a")}
    own = B.assign_actions(requests, values, 0.5).collect()
    assert len(own) == 600 and {r["action_id"] for r in own if r["run_id"] == 1} == {"b", "c"}


def test_negatives_take_all_that_are_free(spark):
    positives = spark.createDataFrame([("A",), ("C",)], "sequence string")
    got = C.generate_negatives(spark, positives, 18, seed=1).collect()
    assert sorted(r["sequence"] for r in got) == sorted(set(C.ALPHABET) - {"A", "C"})
    with pytest.raises(ValueError, match="18 sequences are free"):
        C.generate_negatives(spark, positives, 19, seed=1)


def test_fasta_preambles(spark, tmp_path):
    (tmp_path / "bare.fasta").write_text("AAAA\nKK KK\n")
    (tmp_path / "note.fasta").write_text("CCCC\n>one\nAC\nDE\n>two\nFF\n")
    (tmp_path / "plain.fasta").write_text(">h1\nAC\n>h2\nDE\n")
    got = sorted((r["file"], r["header"], r["sequence"]) for r in read_fasta(spark, str(tmp_path)).collect())
    assert got == [("bare.fasta", "", "AAAAKKKK"), ("note.fasta", "", "CCCC"), ("note.fasta", "one", "ACDE"), ("note.fasta", "two", "FF"),
                   ("plain.fasta", "h1", "AC"), ("plain.fasta", "h2", "DE")]


def test_corpus_to_screening(spark, proteins):
    """Positives, negatives, fit, and the fitted model as the scorer of a screening."""
    positives = spark.createDataFrame([("".join(random.Random(i).choices("KRLWIF", k=12)), "made") for i in range(150)], "sequence string, source string")
    data = C.prepare_dataset(spark, positives, 150, seed=3).withColumn("features", C.composition("sequence"))
    model = C.fit_logistic(data.where("split = 'train'"), "features", "label")
    fitted = C.predict(model, data.where("split = 'test'"), "features")
    assert C.roc_auc(fitted.withColumnRenamed("probability_1", "score")).first().auc > 0.95
    linear = C.scorer_from_model(model)
    embedder = C.embedding_scorer(C.numpy_composition_embedder, 20, list(linear.weights), linear.bias)
    names = ["protein", "enzyme", "num_peptides", "num_predicted_amp", "top_peptide"]
    one, two = (Q.screen_combinations_ml(proteins, s).select(*names, "avg_probability", "rank").collect() for s in (linear, embedder))
    assert len(one) == 24
    by = {(r["protein"], r["enzyme"]): r for r in two}
    assert all(abs(r["avg_probability"] - by[r["protein"], r["enzyme"]]["avg_probability"]) < 1e-9 for r in one)
    rewards = Q.combo_rewards(proteins, embedder)
    assert rewards.count() == 32 and Q.rank_candidates(proteins, rewards, embedder).where("rank = 1").count() == 4


def test_features_with_probability(spark):
    df = spark.createDataFrame([("kkllwwkk", 1), (None, 2)], "peptide string, x int")
    got = {r["x"]: r for r in C.peptide_features_ml(df, C.prior_scorer()).collect()}
    assert got[1]["net_charge"] == 4 and got[1]["amp_prediction"] == 1 and got[2]["amp_probability"] is None
    p = 1 / (1 + np.exp(-(-2 + (4 * 4 + 2 * 4 + 1 * 2) / 8)))
    assert abs(got[1]["amp_probability"] - p) < 1e-9


def test_building_a_query_starts_no_job(spark):
    """Queries over documents that rank nothing are lazy; none counts partitions of an input."""
    from amphora.plans import registry

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    for name in ("digest_peptides", "sequential_digest", "combo_rewards", "peptide_counts", "cut_sites"):
        registry.REGISTRY[name].run(spark, "/root/testdata/sf0.001")
    assert len(tracker.getJobIdsForGroup("building")) <= 5  # a schema read for each table
    spark.sparkContext.setJobGroup("tests", "tests")
