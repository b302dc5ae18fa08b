from pyspark.sql import Window
from pyspark.sql import functions as F

from amphora.operators.corpus import length_stats
from amphora.operators.digest import digest
from amphora.operators.ranking import rank_within
from amphora.plans.combination_screening import combo_rewards
from amphora.plans.rule_screening import screen_combinations
from amphora.sources.sequences import attach_sequences, missing_sequences

SCHEMA = "protein string, accession_id string, sequence string"


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert screen_combinations(empty).count() == 0
    assert combo_rewards(empty).count() == 0
    assert length_stats(empty).count() == 0


def test_nulls_case_and_terminal_cuts(spark):
    cat = spark.createDataFrame([("a", "X1"), ("b", "X2"), ("c", "X3")], "protein string, accession_id string")
    seqs = spark.createDataFrame([("X1", "aaakrpk"), ("X2", None)], "accession_id string, sequence string")
    assert sorted(r.accession_id for r in missing_sequences(cat, seqs).collect()) == ["X2", "X3"]
    attached = attach_sequences(cat, seqs)
    peps = digest(attached, "sequence", ["trypsin"], min_length=1, keep=["protein"]).collect()
    # upper-cased; K before R cut, R before P blocked, terminal K not a cut
    assert [p.peptide for p in sorted(peps, key=lambda r: r.pos)] == ["AAAK", "RPK"]


def test_rewards_keep_empty_combinations(spark):
    seqs = spark.createDataFrame([("p", "P1", "KKKKKKKK")], SCHEMA)
    rows = {r.action_id: r for r in combo_rewards(seqs).collect()}
    assert len(rows) == 8
    assert rows[0].num_peptides == 0 and rows[0].reward == 0.0   # trypsin cuts to single K
    assert rows[2].num_peptides == 1                              # alcalase leaves it whole


def test_hot_key_rank_within(spark):
    # one key holds most rows and spans many partitions
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 10).cast("string"))).alias("k"),
        (F.col("id") * 7919 % 5000).alias("v")).repartition(9)
    got = rank_within(df, ["k"], [F.col("v").desc()])
    hot = sorted((r.rank, r.v) for r in got.where("k = 'hot'").collect())
    assert [r for r, _ in hot] == list(range(1, len(hot) + 1))
    assert [v for _, v in hot] == sorted((v for _, v in hot), reverse=True)


def test_candidate_ranks_equal_a_window(spark, proteins):
    from amphora.plans import combination_screening as Q

    ranked = Q.rank_candidates(proteins, Q.combo_rewards(proteins))
    w = Window.partitionBy("protein").orderBy(F.col("probability").desc(), "pos", "sequence")
    rows = ranked.withColumn("expected", F.row_number().over(w)).collect()
    assert rows and all(r["rank"] == r["expected"] for r in rows)


def test_screen_hot_key_many_rows(spark, proteins):
    """One protein key repeated over many rows (spread over many tasks):
    partial aggregation merges them into one exact summary per enzyme."""
    lf = proteins.where("protein = 'lactoferrin'")
    many = lf.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("copy").repartition(16)
    one = {r.enzyme: r for r in screen_combinations(lf).collect()}
    hot = {r.enzyme: r for r in screen_combinations(many).collect()}
    for e, r in one.items():
        h = hot[e]
        assert h.num_peptides == 40 * r.num_peptides
        assert (h.max_score, h.top_peptide) == (r.max_score, r.top_peptide)
        assert h.num_score_ge_3 == 40 * r.num_score_ge_3 and abs(h.avg_score - r.avg_score) < 1e-12
