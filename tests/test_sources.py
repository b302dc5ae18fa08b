"""Readers and writers, resolved names, stored scores and selections by counts."""

import random

import pytest
from pyspark.sql import functions as F

from amphora.functions.enzymes import resolve_combos
from amphora.functions.residues import valid_alphabet
from amphora.operators import classifier as C
from amphora.sources import fasta
from amphora.sources.files import list_folders, path_exists


def test_fasta_is_the_same_for_any_split(spark, tmp_path):
    rng = random.Random(4)
    body = lambda: "\n".join("".join(rng.choice("ACDE \t") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 4)))
    (tmp_path / "a.fasta").write_text("".join(f">h{i} x\n{body()}\n" for i in range(60)))
    (tmp_path / "b.fasta").write_text("preamble\n" * 30 + "".join(f">b{i}\r\n{body()}\r\n" for i in range(20)))
    (tmp_path / "c.fasta").write_text("ACDE\n" * 50)
    (tmp_path / "d.fasta").write_text("")
    read = lambda: sorted(tuple(r) for r in fasta.read_fasta(spark, str(tmp_path)).collect())
    whole = read()
    assert sum(r[0] == "c.fasta" for r in whole) == 1 and ("b.fasta", "", "preamble" * 30) in whole
    for size in ("64", "200", "777"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            assert read() == whole
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csvs_by_name(spark, tmp_path):
    for i in range(40):
        names = ["ID", "SEQUENCE"] if i % 2 else ["SEQUENCE", "NOTE", "ID"]
        (tmp_path / f"peptides{i}.csv").write_text(",".join(names) + "\n" + ",".join(f'"A{n},{i}"' for n in names) + "\n")
    got = fasta.read_peptide_csvs(spark, str(tmp_path / "peptides*.csv"))
    assert sorted(r["sequence"] for r in got.collect()) == sorted(f"ASEQUENCE,{i}" for i in range(40))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2  # one scan, not forty
    (tmp_path / "peptides_bad.csv").write_text("ID,OTHER\n1,2\n")
    with pytest.raises(ValueError, match="peptides_bad.csv"):
        fasta.read_peptide_csvs(spark, str(tmp_path / "peptides*.csv"))


def test_published_results(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(100).select((F.col("id") + 1).alias("rank"), F.array(F.lit(1.5)).alias("v"))
    fasta.publish_results(rows.repartition(7), path)
    assert fasta.read_published(spark, path).count() == 100
    fasta.publish_results(rows.limit(3), path)
    got = fasta.read_published(spark, path)
    assert sorted(r["rank"] for r in got.collect()) == [1, 2, 3] and got.dtypes == rows.dtypes
    assert len(list_folders(spark, path)) == 2  # the earlier one is still there for who reads it


def test_stored_scores(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def score(distinct):
        n = distinct.count()
        seen.add(n)
        return distinct.withColumn("amp_probability", F.length("peptide") / 100.0)

    scorer = C.stored_scorer(score, str(tmp_path / "scores"), "m1")
    peptides = spark.createDataFrame([("AC",), ("ACD",), ("AC",), (None,)], "peptide string")
    first = sorted(C.score_distinct(peptides, scorer).collect(), key=str)
    assert seen.value == 2 and len(first) == 4  # the null peptide keeps its row
    assert sorted(C.score_distinct(peptides, scorer).collect(), key=str) == first and seen.value == 2
    more = peptides.unionAll(spark.createDataFrame([("KKKK",)], "peptide string"))
    assert C.score_distinct(more, scorer).where("amp_probability IS NOT NULL").count() == 4 and seen.value == 3
    C.score_distinct(peptides, C.stored_scorer(score, str(tmp_path / "scores"), "m2")).collect()
    assert seen.value == 5 and path_exists(spark, str(tmp_path / "scores" / "model=m2"))


@pytest.mark.parametrize("below", [1, 7, 4096, 10_000_000])
def test_nth_smallest(spark, below):
    rng = random.Random(below)
    values = sorted(rng.sample(range(below), min(below, 50)))
    df = spark.createDataFrame([(v,) for v in values], "id long")
    for n in {1, len(values) // 2 or 1, len(values)}:
        assert C.nth_smallest(df, "id", n, below) == values[n - 1]
    with pytest.raises(ValueError):
        C.nth_smallest(df, "id", len(values) + 1, below + 1)


def test_names_and_alphabet(spark):
    df = spark.createDataFrame([(["Trypsin", "nope", None, "PEPSIN"],), ([],), (None,)], "given array<string>")
    got = [(r["enzymes"], r["unknown"]) for r in resolve_combos(df, "given").collect()]
    assert got == [(["trypsin", "pepsin"], ["nope"]), ([], []), (None, None)]
    letters = spark.createDataFrame([("ACDE",), ("ACDE\n",), ("",)], "s string").select(valid_alphabet("s").alias("ok"))
    assert [r["ok"] for r in letters.collect()] == [True, False, False]


def test_predict_keeps_the_callers_columns(spark):
    rows = [([float(i % 5), 1.0], i % 2, "kept") for i in range(40)]
    df = spark.createDataFrame(rows, "v array<double>, label int, features string")
    out = C.predict(C.fit_logistic(df, "v", "label"), df, "v")
    assert {r["features"] for r in out.collect()} == {"kept"} and set(out.columns) == {"v", "label", "features", "prediction", "probability_1"}


def test_dropping_pins(spark):
    from amphora.session import dropping_pins, pin_table

    place = lambda df: df.inputFiles()[0].rpartition("/")[0]
    kept = pin_table(spark.range(5))
    with dropping_pins(spark):
        inner = place(pin_table(spark.range(5)))
        assert path_exists(spark, inner)
    assert not path_exists(spark, inner) and kept.count() == 5
    after = pin_table(spark.range(3))
    assert after.count() == 3
