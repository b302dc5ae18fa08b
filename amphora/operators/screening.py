"""Per (sequence, enzyme) summaries of peptide scores (A1-A5, C4).

Every summary is a ``groupBy`` with partial aggregation: the map side
collapses all peptides of a group in a task to one buffer row before the
exchange, so a hot key (one protein holding a third of all peptides) costs
one row per task in the shuffle, not one row per peptide. An aggregate that
keeps a string (the top peptide) is sort-based in Spark, so peptide rows are
first folded by runs (``fold_runs``) and only runs are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amphora import fixed
from amphora.fixed import EnzymeRule
from amphora.functions.cleavage import peptide_cutter, slices_of, string_offsets
from amphora.functions.residues import amp_scores, peptide_features, upper_amp_score
from amphora.operators.digest import _rules, digest, peptide_bounds
from amphora.operators.ranking import rank_within
from amphora.operators.running import HOT_KEY_ROWS, _differs
from amphora.session import pin_table


def first_at_max(value: str | Column, score: str | Column, pos: str | Column = "pos") -> Column:
    """A3: ``value`` of the highest ``score``; among equal scores the one at
    the lowest position (first occurrence), as a deterministic aggregate."""
    score = F.col(score) if isinstance(score, str) else score
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.max_by(value, F.struct(score, -pos))


def _folded(groups: list[str], kinds: dict[str, str], schema: pa.Schema):
    """``mapInArrow`` function of ``fold_runs``."""

    def fold(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = True
        for name in groups:
            new |= _differs(batch.column(name), None)
        starts, run = np.flatnonzero(new), np.cumsum(new)
        # First of each run by (score descending, pos ascending) as Spark
        # orders them: NaN above all numbers, nulls last.
        score, pos = batch.column("_score"), batch.column("pos")
        key = pc.fill_null(score, pa.scalar(0, score.type)).to_numpy(zero_copy_only=False)
        kind = np.where(score.is_null().to_numpy(zero_copy_only=False), 2, 1)
        if pa.types.is_floating(score.type):
            nan = np.isnan(key)
            kind, key = np.where(nan, 0, kind), np.where(nan, 0, key)
        place = pc.fill_null(pos, pa.scalar(0, pos.type)).to_numpy(zero_copy_only=False)
        unplaced = pos.is_null().to_numpy(zero_copy_only=False)
        rows = np.arange(batch.num_rows)
        if kind.min() == kind.max():  # only rows at their run's highest score can be the first
            rows = np.flatnonzero(key == np.maximum.reduceat(key, starts)[run - 1])
        order = rows[np.lexsort((place[rows], unplaced[rows], -key[rows], kind[rows], run[rows]))]
        order = order[np.append(True, np.diff(run[order]) > 0)]
        columns = {name: batch.column(name).take(pa.array(starts)) for name in groups}
        top = pa.array(order)
        columns |= {name: batch.column(name).take(top) for name in ("_score", "pos", "peptide")}
        columns["_n"] = pa.array(np.diff(np.append(starts, batch.num_rows)))
        for name, how in kinds.items():
            values = batch.column(name)
            floating = pa.types.is_floating(values.type)
            none = 0 if how == "sum" else -np.inf if floating else np.iinfo(values.type.to_pandas_dtype()).min
            raw = pc.fill_null(values, pa.scalar(none, values.type)).to_numpy(zero_copy_only=False)
            known = np.add.reduceat(values.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), starts)
            out = np.add.reduceat(raw.astype(np.float64 if floating else np.int64), starts) if how == "sum" else np.maximum.reduceat(raw, starts)
            columns[name] = pa.array(out, mask=known == 0)
            columns[f"{name}_n"] = pa.array(known)
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fold(batch)

    return run


def fold_runs(peptides: DataFrame, groups: Sequence[str], score: Column, aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Neighbouring peptide rows that agree in ``groups`` become one row (two
    or more where an Arrow batch ends between them): ``_n`` rows, the ``pos``,
    ``peptide`` and ``_score`` of the highest ``score`` (the lowest ``pos``
    among equals), and for each ``name -> (sum | max, value)`` that value and
    ``name_n``, how many were not null. A digest gives the peptides of a group
    one after the other, so what is left to group is a few rows for each; rows
    in any other order only fold less."""
    from pyspark.sql.pandas.types import to_arrow_schema

    from amphora.operators.classifier import _ship_package_code

    _ship_package_code()
    rows = peptides.select(*groups, "pos", "peptide", score.alias("_score"), *[v.alias(n) for n, (_, v) in aggs.items()])
    kinds = {n: kind for n, (kind, _) in aggs.items()}
    fields = [T.StructField(n, rows.schema[n].dataType) for n in (*groups, "pos", "peptide", "_score")] + [T.StructField("_n", T.LongType())]
    for n, kind in kinds.items():
        own = rows.schema[n].dataType
        total = T.DoubleType() if isinstance(own, (T.DoubleType, T.FloatType)) else T.LongType()
        fields += [T.StructField(n, total if kind == "sum" else own), T.StructField(f"{n}_n", T.LongType())]
    made = T.StructType(fields)
    return rows.mapInArrow(_folded(list(groups), kinds, to_arrow_schema(made)), made)


def count_at_least(score: str | Column, t: int) -> Column:
    """A4: number of rows with ``score >= t``."""
    score = F.col(score) if isinstance(score, str) else score
    return F.count_if(score >= t)


def score_peptides(peptides: DataFrame, peptide_col: str = "peptide") -> DataFrame:
    """P6 on peptide rows: appends the feature columns."""
    return peptides.select("*", *peptide_features(peptide_col)[1:])


def screen(
    peptides: DataFrame,
    keys: Sequence[str] = ("protein", "accession_id"),
    group: str = "enzyme",
    min_length: int = fixed.DEFAULT_MIN_LENGTH,
    max_length: int = fixed.DEFAULT_MAX_LENGTH,
) -> DataFrame:
    """A1: rule-score summary per (keys, enzyme). Input: digest output
    ``(*keys, enzyme, pos, peptide)``. Pairs without peptides have no row."""
    score = upper_amp_score("peptide")  # digest output is upper-case
    scored = peptides.select(*keys, group, "pos", "peptide", score.alias("score"))
    at_least = lambda t: F.coalesce((F.col("score") >= t).cast("int"), F.lit(0))
    runs = fold_runs(scored, [*keys, group], F.col("score"), {
        "_sum": ("sum", F.col("score")), "_ge_3": ("sum", at_least(3)), "_ge_4": ("sum", at_least(4))})
    agg = runs.groupBy(*keys, group).agg(
        F.sum("_n").alias("num_peptides"),
        F.max("_score").alias("max_score"),
        first_at_max("peptide", "_score").alias("top_peptide"),
        F.sum("_ge_3").alias("num_score_ge_3"),
        F.sum("_ge_4").alias("num_score_ge_4"),
        F.try_divide(F.sum("_sum").cast("double"), F.sum("_sum_n")).alias("avg_score"),
    )
    return agg.select(
        *keys,
        group,
        F.lit(min_length).alias("min_length"),
        F.lit(max_length).alias("max_length"),
        "num_peptides",
        "max_score",
        "top_peptide",
        "num_score_ge_3",
        "num_score_ge_4",
        "avg_score",
    )


def screen_ml(
    scored: DataFrame,
    keys: Sequence[str] = ("protein", "accession_id"),
    group: str = "enzyme",
    prob_col: str = "amp_probability",
    min_length: int = fixed.DEFAULT_MIN_LENGTH,
    max_length: int = fixed.DEFAULT_MAX_LENGTH,
    threshold: float = fixed.PREDICT_THRESHOLD,
    order_col: str | None = None,
) -> DataFrame:
    """A2: classifier summary per (keys, enzyme) from peptide rows carrying
    a probability column (see ``classifier.score_peptides``). ``order_col``
    (e.g. the logit) picks the top peptide when given; it must be monotone
    in the probability."""
    p = F.col(prob_col)
    top_key = F.col(order_col) if order_col else p
    # With the logit at hand, p > t is decided as logit > log(t / (1 - t)):
    # the same test, without the last-bit noise of exp().
    predicted = F.col(order_col) > F.lit(math.log(threshold / (1 - threshold))) if order_col else p > threshold
    runs = fold_runs(scored, [*keys, group], top_key, {
        "_amp": ("sum", F.coalesce(predicted.cast("int"), F.lit(0))), "_sum": ("sum", p), "_most": ("max", p)})
    agg = runs.groupBy(*keys, group).agg(
        F.sum("_n").alias("num_peptides"),
        F.sum("_amp").alias("num_predicted_amp"),
        F.try_divide(F.sum("_sum"), F.sum("_sum_n")).alias("avg_probability"),
        F.max("_most").alias("top_probability"),
        first_at_max("peptide", "_score").alias("top_peptide"),
        F.max("_score").alias("_top_key"),
    )
    return agg.select(
        *keys,
        group,
        F.lit(min_length).alias("min_length"),
        F.lit(max_length).alias("max_length"),
        "num_peptides",
        "num_predicted_amp",
        "avg_probability",
        "top_probability",
        "top_peptide",
        *(["_top_key"] if order_col else []),
    )


def peptide_counts(peptides: DataFrame, rows: str = "protein", cols: str = "enzyme",
                   col_values: Sequence[str] | None = None) -> DataFrame:
    """A5: count table. With ``col_values`` it is pivoted (one column per
    enzyme, listed values only, so no extra job to find them)."""
    if col_values is None:
        return peptides.groupBy(rows, cols).agg(F.count(F.lit(1)).alias("num_peptides"))
    return (
        peptides.groupBy(rows)
        .pivot(cols, list(col_values))
        .agg(F.count(F.lit(1)))
        .na.fill(0, list(col_values))
    )


def _ranked_rows(rules: list[EnzymeRule], min_length: int, max_length: int, names: list[str]):
    """``mapInArrow`` function of ``rank_peptides``: (key, sequence) rows, those
    of a key next to each other. The last key of a batch waits for the next."""
    cut = peptide_cutter(rules, min_length, max_length)

    def ranked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, seqs = batch.column(0), batch.column(1)
        firsts = np.append(np.flatnonzero(_differs(keys, None)), len(keys))
        for a, b in slices_of(string_offsets(seqs)[firsts]):  # whole keys
            start, sizes = firsts[a], np.diff(firsts[a:b + 1])
            key_of = np.repeat(np.arange(b - a), sizes)
            for rule, (row, pos, lengths, peptides) in zip(rules, cut(seqs.slice(start, firsts[b] - start))):
                score, key = amp_scores(peptides, lengths), key_of[row]
                order = np.lexsort((pos, -score, key))
                n = np.bincount(key, minlength=b - a)
                rank = np.empty(len(order), dtype=np.int64)
                rank[order] = np.arange(1, len(order) + 1) - np.repeat(np.cumsum(n) - n, n)
                columns = [keys.take(pa.array(start + row)), pa.repeat(rule.name, len(row)), pa.array(pos), peptides, pa.array(score), pa.array(rank)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            last = int(np.flatnonzero(_differs(rows.column(0), None))[-1])
            if last:
                yield from ranked(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield from ranked(held)

    return run


def rank_peptides(sequences: DataFrame, key: str, seq_col: str = "sequence", enzymes: Sequence[EnzymeRule | str] | None = None,
                  min_length: int = fixed.DEFAULT_MIN_LENGTH, max_length: int = fixed.DEFAULT_MAX_LENGTH) -> DataFrame:
    """``(key, enzyme, pos, peptide, simple_amp_score, rank)``,
    the peptides of each key and enzyme ranked by score, the first ones among
    equals.

    The sequences of a key are brought together, not its peptides, which are
    several times larger: cut, scored and ranked in one stage after that
    shuffle, they become rows with their rank. A key with more peptides than
    ``spark.amphora.hotKeyRows`` (by ``peptide_bounds``) is ranked as rows by
    ``rank_within``, over many tasks. A null key is one key."""
    from amphora.operators.classifier import _ship_package_code

    if min_length < 1:
        raise ValueError("min_length must be >= 1")
    spark, rules = sequences.sparkSession, _rules(enzymes)
    # A shorter sequence has no peptide; each other one counts in the bounds.
    seqs = sequences.select(key, F.upper(seq_col).alias("_sequence")).where(F.length("_sequence") >= min_length)
    bounds = peptide_bounds(seqs, "_sequence", rules, min_length, [key])
    most = int(spark.conf.get("spark.amphora.hotKeyRows", str(HOT_KEY_ROWS)))
    hot = pin_table(bounds.where(F.col("n") > most).select(F.col(key).alias("_hot")).distinct(), "hot-keys")
    none_hot = hot.isEmpty()
    few = seqs if none_hot else seqs.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left_anti")
    made = [T.StructField("enzyme", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("peptide", T.StringType()),
            T.StructField("simple_amp_score", T.IntegerType()), T.StructField("rank", T.LongType())]
    schema = T.StructType([seqs.schema[key], *made])
    _ship_package_code()
    out = few.repartition(key).sortWithinPartitions(key).mapInArrow(_ranked_rows(rules, min_length, max_length, schema.names), schema)
    if none_hot:
        return out
    many = digest(seqs.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left_semi"), "_sequence", rules, min_length, max_length, [key])
    scored = many.withColumn("simple_amp_score", upper_amp_score("peptide"))
    order = [F.col("simple_amp_score").desc(), F.col("pos").asc()]
    return out.unionAll(rank_within(scored, [key, "enzyme"], order, key_rows=bounds).select(*schema.names))
