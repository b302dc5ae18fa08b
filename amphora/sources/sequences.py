"""Sequence inputs: one-file-per-sequence folders (S1), the missing-sequence
report (S2), the catalogue -> sequence join (J2), and stand-in sequences
derived from the driver's ``documents`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amphora import fixed
from amphora.functions.residues import drop_missing, protein_like
from amphora.session import spread


def read_sequence_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file is one sequence; the accession is the file stem.
    All white space (including line ends) is removed; sequences are kept as
    read otherwise (case is normalised by the operators)."""
    raw = spark.read.text(path, wholetext=True)
    name = F.col("_metadata.file_name")
    return raw.select(
        F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1).alias("accession_id"),
        F.regexp_replace("value", r"\s+", "").alias("sequence"),
    )


def missing_sequences(proteins: DataFrame, sequences: DataFrame) -> DataFrame:
    """Catalogue entries without a usable sequence."""
    usable = sequences.where(drop_missing("sequence")).select("accession_id")
    return proteins.join(usable, "accession_id", "left_anti")


def attach_sequences(proteins: DataFrame, sequences: DataFrame) -> DataFrame:
    """Catalogue -> sequence by accession (inner; missing ones dropped).
    The catalogue is the small side; Spark broadcasts it when its size
    estimate is under the broadcast threshold, else it sort-merges."""
    usable = sequences.where(drop_missing("sequence"))
    return proteins.join(usable, "accession_id", "inner").select(
        "protein", "accession_id", "sequence"
    )


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-proteins from ``documents``: the residue letters of ``text``,
    upper-cased; ``protein = 'doc_' || doc_id``, ``accession_id = doc_id``.
    Documents without any residue letter are dropped (P10)."""
    # Where a number of input partitions is set, before the text clean-up.
    docs = spread(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
    seq = protein_like("text")
    # "Has a residue letter" is tested with an early-exit rlike: Catalyst
    # pushes this filter below the repartition, so it must stay cheap.
    letters = fixed.STANDARD_RESIDUES + fixed.STANDARD_RESIDUES.lower()
    return docs.where(F.col("text").rlike(f"[{letters}]")).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("protein"),
        F.col("doc_id").cast("string").alias("accession_id"),
        seq.alias("sequence"),
    )
