"""Sorts, ranks and top-k.

A global rank must not funnel all rows through one task (a window without
``partitionBy`` does exactly that). ``global_rank`` sorts with Spark's range
partitioning, pins the sorted partitions with a reliable ``checkpoint`` so
both passes below see identical partitions, counts rows per partition (one
row per partition), turns the counts into offsets, and adds
``offset + position within partition``. The only broadcast is the offsets
table, bounded by the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amphora.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add a 1-based ``name`` column following ``order`` (must be a total
    order for a deterministic result), computed without a single-partition
    window."""
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = ordered.select("*", F.shiftrightunsigned(mid, 33).alias("_pid"),
                            (mid.bitwiseAND(F.lit(_LOW33))).alias("_local"))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a tiny table, so a global window is fine here.
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(
                Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_off"),
    )
    ranked = tagged.join(F.broadcast(offsets), "_pid").select(
        *[F.col(c) for c in df.columns],
        (F.col("_off") + F.col("_local") + F.lit(1)).cast("bigint").alias(name),
    )
    return ranked


def screening_order() -> list[Column]:
    """T1 sort keys, with protein and enzyme as deterministic tie-breakers."""
    return [
        F.col("num_score_ge_4").desc(),
        F.col("num_score_ge_3").desc(),
        F.col("max_score").desc(),
        F.col("avg_score").desc(),
        F.col("protein").asc(),
        F.col("enzyme").asc(),
    ]


def rank_screening(results: DataFrame, with_rank: bool = True) -> DataFrame:
    """Rule-screening summary ranked best first."""
    order = screening_order()
    return global_rank(results, order) if with_rank else results.orderBy(*order)


def ml_order(key: str = "top_probability") -> list[Column]:
    return [F.col(key).desc(), F.col("protein").asc(), F.col("enzyme").asc()]


def rank_screening_ml(results: DataFrame, with_rank: bool = True) -> DataFrame:
    """Classifier summary by top probability. When the summary carries
    ``_top_key`` (the top logit, same order) it is used and dropped."""
    key = "_top_key" if "_top_key" in results.columns else "top_probability"
    order = ml_order(key)
    out = global_rank(results, order) if with_rank else results.orderBy(*order)
    return out.drop("_top_key")


def rank_within(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                name: str = "rank", key_rows: DataFrame | None = None) -> DataFrame:
    """T3 per group: 1-based position inside each group following ``order``
    (a total order inside the group). Computed as a distributed running
    count, so a hot group (a third of all rows under one key) is split over
    many tasks instead of being ranked by one ``row_number`` task."""
    from amphora.operators.running import running

    return running(df, order, {name: ("sum", F.lit(1).cast("bigint"))}, keys=list(partition), key_rows=key_rows)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """T5 global: TakeOrderedAndProject keeps k rows per task, then k."""
    return df.orderBy(*order).limit(k)


def top_k_within(df: DataFrame, k: int, partition: Sequence[str],
                 order: Sequence[Column], name: str = "rank") -> DataFrame:
    """T5 per group: ``row_number`` inside groups, keep rank <= k. Spark
    plans this with a WindowGroupLimit that keeps at most k rows per group
    in every task before the shuffle, so even a hot group sends k rows per
    task to the final window."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def pivot_matrix(results: DataFrame, row: str, col: str, value: str,
                 col_values: Sequence[str], row_order: Sequence[str] | None = None) -> DataFrame:
    """``row`` x listed ``col`` values matrix of ``value``.

    A duplicated (row, col) pair or a missing listed label raises: the
    checks are folded into the same aggregation with ``raise_error``."""
    checked = results.groupBy(row, col).agg(
        F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v")
    ).select(
        row,
        col,
        F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate pair: "),
               F.col(row).cast("string"), F.lit("/"), F.col(col).cast("string"))))
        .otherwise(F.col("_v")).alias("_v"),
    )
    # Every label, listed or found, is in the pivot or raises: a value of an
    # unlisted column, a listed column or row without any value.
    listed = F.col(col).isin(list(col_values))
    named = lambda what: F.raise_error(F.concat(F.lit(f"{what}: "), F.col(col).cast("string")))
    checked = checked.withColumn(col, F.when(listed, F.col(col)).otherwise(named("unlisted column")))
    out = checked.groupBy(row).pivot(col, list(col_values)).agg(F.max("_v"))
    found = checked.agg(F.collect_set(F.when(F.col("_v").isNotNull(), F.col(col))).alias("_cols"), F.collect_set(F.col(row)).alias("_rows"))
    absent = F.array_except(F.array(*[F.lit(c) for c in col_values]), F.col("_cols"))
    checks = F.when(F.size(absent) > 0, F.raise_error(F.concat(F.lit("no value in column: "), F.array_join(absent, ", "))))
    if row_order is not None:
        lost = F.array_except(F.array(*[F.lit(r) for r in row_order]), F.col("_rows"))
        checks = checks.when(F.size(lost) > 0, F.raise_error(F.concat(F.lit("no value in row: "), F.array_join(lost, ", "))))
    told = found.select(F.coalesce(checks.cast("boolean"), F.lit(True)).alias("_complete"))
    out = out.where(told.scalar())
    if row_order is not None:
        pos = F.array_position(F.array(*[F.lit(r) for r in row_order]), F.col(row))
        out = out.withColumn(
            "row_order",
            F.when(pos > 0, pos).otherwise(
                F.raise_error(F.concat(F.lit("unlisted row: "), F.col(row).cast("string")))
            ).cast("int"),
        )
    return out


CANDIDATE_COLUMNS = ("protein", "enzyme", "top_peptide", "top_probability",
                     "num_predicted_amp", "avg_probability")


def candidate_columns(ranked_ml: DataFrame) -> DataFrame:
    """The six-column view of the classifier ranking (plus ``rank``
    when present)."""
    extra = ["rank"] if "rank" in ranked_ml.columns else []
    return ranked_ml.select(*CANDIDATE_COLUMNS, *extra)
