"""U3 from files: peptide CSV exports and APD FASTA files -> AMP database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amphora import fixed
from amphora.operators.corpus import build_amp_database
from amphora.sources.fasta import read_apd, read_peptide_csvs


def build_amp_database_from_files(spark: SparkSession, csv_glob: str,
                                  fasta_paths: Sequence[str] | None = None) -> DataFrame:
    """Corpora in the fixed precedence (CSV exports before APD FASTA), then
    upper-case, dedupe (first source wins), alphabet and length filters.
    Without FASTA files the database is built from the CSV exports alone."""
    by_source = {
        "DBAASP": read_peptide_csvs(spark, csv_glob, source="DBAASP"),
    }
    if fasta_paths:
        by_source["APD6"] = read_apd(spark, fasta_paths, source="APD6").select("sequence", "source")
    ordered = [by_source[name] for name, _ in sorted(fixed.SOURCE_PRIORITY, key=lambda x: x[1])
               if name in by_source]
    return build_amp_database([c.select("sequence", F.col("source")) for c in ordered])
