"""AMP corpus: union of sources, case-insensitive dedupe with source
precedence, alphabet and length filters, and summaries (U1-U3, P8-P10,
A7, A8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amphora import fixed
from amphora.functions.residues import drop_missing, min_length, valid_alphabet


def union_corpora(corpora: Sequence[DataFrame], seq_col: str = "sequence") -> DataFrame:
    """Bag union of ``(sequence, source)`` inputs; list position is the
    precedence (0 wins), kept as ``source_priority``."""
    out = None
    for i, c in enumerate(corpora):
        part = c.select(F.col(seq_col).alias("sequence"), "source",
                        F.lit(i).alias("source_priority"))
        out = part if out is None else out.unionByName(part)
    return out


def dedupe_by_sequence(corpus: DataFrame) -> DataFrame:
    """One row per upper-cased sequence; the surviving source is the one
    with the lowest precedence (ties: smallest source name), never an
    arbitrary survivor. Partial aggregation collapses a hot sequence on the
    map side."""
    return corpus.groupBy(F.upper("sequence").alias("sequence")).agg(
        F.min_by("source", F.struct("source_priority", "source")).alias("source"))


def build_amp_database(corpora: Sequence[DataFrame],
                       min_len: int = fixed.CORPUS_MIN_LENGTH) -> DataFrame:
    """P10 -> U1 -> P1 -> U2 -> P8 -> P9 as one plan (one shuffle, the
    dedupe). Filters that do not depend on the survivor run before the
    shuffle: alphabet and length only look at the upper-cased sequence."""
    return build_amp_database_tagged(union_corpora(corpora), min_len)


def build_amp_database_tagged(tagged: DataFrame,
                              min_len: int = fixed.CORPUS_MIN_LENGTH) -> DataFrame:
    """U3 over one table already carrying ``source_priority`` (e.g. corpora
    stored together and told apart by a column: one scan instead of one per
    corpus)."""
    upper = F.upper("sequence")
    kept = tagged.where(drop_missing("sequence") & valid_alphabet(upper)
                        & min_length(upper, min_len))
    return dedupe_by_sequence(kept)


def source_breakdown(corpus: DataFrame) -> DataFrame:
    """Rows per source, most first."""
    return corpus.groupBy("source").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.col("count").desc(), F.col("source"))


def length_stats(corpus: DataFrame, seq_col: str = "sequence") -> DataFrame:
    """Count, min, max, mean, exact median and sample std of lengths.

    All come from the length histogram (one row per distinct length, bounded
    by the longest sequence): the exact median is its weighted percentile, and
    the variance is taken from whole numbers, so no digits are lost."""
    hist = corpus.groupBy(F.length(seq_col).alias("len")).agg(F.count(F.lit(1)).alias("c")).where("len IS NOT NULL")
    whole = F.col("len").cast("decimal(18,0)")
    sums = hist.agg(
        F.sum("c").alias("n"), F.min("len").alias("min_length"), F.max("len").alias("max_length"),
        F.sum(F.col("len") * F.col("c")).alias("s1"), F.sum((whole * F.col("len") * F.col("c")).cast("decimal(38,0)")).alias("s2"),
        F.percentile("len", F.lit(0.5), F.col("c")).alias("median_length"))
    n, s1 = F.col("n"), F.col("s1")
    spread = n.cast("decimal(19,0)") * F.col("s2").cast("decimal(19,0)") - s1.cast("decimal(19,0)") * s1.cast("decimal(19,0)")
    var = F.try_divide(spread.cast("double"), n.cast("double") * (n - 1))
    return sums.where("n > 0").select(
        "n", "min_length", "max_length", (s1.cast("double") / n).alias("mean_length"), "median_length", F.sqrt(var).alias("std_length"))
