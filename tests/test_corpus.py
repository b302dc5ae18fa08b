import os

import pytest
from pyspark.sql import functions as F

from amphora.operators import corpus as U
from amphora.sources.fasta import read_fasta, read_peptide_csvs, read_results, write_results

FASTA = ">Your search led to 3 peptides\n>AP1\nGLWSK\n\n>AP2\n  AAAK  \nLLRR\n\n>AP3\n\n>AP4\r\nKKWW\r\n"


def test_read_fasta(spark, tmp_path):
    p = tmp_path / "a.fasta"
    p.write_text(FASTA)
    rows = read_fasta(spark, str(p)).orderBy("header").collect()
    assert [(r.header, r.sequence) for r in rows] == [("AP1", "GLWSK"), ("AP2", "AAAKLLRR"), ("AP4", "KKWW")]


AMP_DATA = os.environ.get("AMPHORA_AMP_DATA", "")  # folder with raw/ and processed/


@pytest.mark.skipif(not os.path.exists(os.path.join(AMP_DATA, "raw", "apd6_natural.fasta")),
                    reason="set AMPHORA_AMP_DATA to the folder holding the AMP FASTA files")
def test_shipped_fasta_counts(spark):
    base = os.path.join(AMP_DATA, "raw") + "/"
    nat = read_fasta(spark, base + "apd6_natural.fasta")
    ani = read_fasta(spark, base + "apd6_animal.fasta")
    assert nat.count() == 3306 and ani.count() == 2580
    corpus = nat.select("sequence", F.lit("APD6").alias("source")).unionByName(
        ani.select("sequence", F.lit("APD6").alias("source")))
    assert corpus.select(F.upper("sequence")).distinct().count() == 3308
    assert U.build_amp_database([corpus]).count() == 3305


def test_dedupe_first_source_wins(spark):
    a = spark.createDataFrame([("gLWSKik", "DBAASP"), ("AAAA", "DBAASP")], "sequence string, source string")
    b = spark.createDataFrame([("GLWSKIK", "APD6"), ("KKKK", "APD6"), ("XXBZ", "APD6"), ("EL", "APD6"),
                               (None, "APD6"), ("", "APD6")], "sequence string, source string")
    db = {r.sequence: r.source for r in U.build_amp_database([a, b]).collect()}
    assert db == {"GLWSKIK": "DBAASP", "AAAA": "DBAASP", "KKKK": "APD6"}
    br = U.source_breakdown(U.build_amp_database([a, b])).collect()
    assert [(r.source, r["count"]) for r in br] == [("DBAASP", 2), ("APD6", 1)]


def test_length_stats(spark):
    for seqs, med in ((["AAAA", "AAAAA", "AAAAAAA"], 5.0), (["AAAA", "AAAAA", "AAAAAA", "AAAAAAAA"], 5.5)):
        df = spark.createDataFrame([(s,) for s in seqs], "sequence string")
        r = U.length_stats(df).first()
        lens = [len(s) for s in seqs]
        mean = sum(lens) / len(lens)
        std = (sum((x - mean) ** 2 for x in lens) / (len(lens) - 1)) ** 0.5
        assert (r.n, r.min_length, r.max_length) == (len(lens), min(lens), max(lens))
        assert abs(r.mean_length - mean) < 1e-12 and r.median_length == med
        assert abs(r.std_length - std) < 1e-9


def test_peptide_csvs_and_results(spark, tmp_path):
    (tmp_path / "peptides1.csv").write_text("ID,SEQUENCE,EXTRA\n1,GLWSK,x\n2,,y\n")
    (tmp_path / "peptides2.csv").write_text("SEQUENCE,OTHER\nKKWW,1\n")
    df = read_peptide_csvs(spark, str(tmp_path / "peptides*.csv"))
    assert sorted(r.sequence for r in df.collect()) == ["GLWSK", "KKWW"]
    empty = read_peptide_csvs(spark, str(tmp_path / "missing" / "*.csv"))
    assert empty.count() == 0 and empty.columns == ["sequence", "source"]


def test_write_read_results(spark, tmp_path, proteins):
    from amphora.plans.rule_screening import ranked_screening

    res = ranked_screening(proteins)
    out = str(tmp_path / "screening")
    write_results(res, out)
    back = read_results(spark, out)
    assert back.count() == 24
    assert back.orderBy("rank").first().top_peptide == "QVLLHQQALFGK"


def test_amp_database_from_files(spark, tmp_path):
    from amphora.plans.amp_corpus import build_amp_database_from_files

    (tmp_path / "peptides1.csv").write_text("SEQUENCE\nGLWSKIK\nAAAA\n")
    (tmp_path / "apd.fasta").write_text(">x\nglwskik\n>y\nKKKK\n>z\nEL\n")
    db = {r.sequence: r.source for r in build_amp_database_from_files(
        spark, str(tmp_path / "peptides*.csv"), [str(tmp_path / "apd.fasta")]).collect()}
    assert db == {"GLWSKIK": "DBAASP", "AAAA": "DBAASP", "KKKK": "APD6"}
    only_csv = build_amp_database_from_files(spark, str(tmp_path / "peptides*.csv"))
    assert only_csv.count() == 2
