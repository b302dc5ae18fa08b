"""Running (cumulative) aggregates that never put a hot group in one task.

A window ``partitionBy(k).orderBy(t).rowsBetween(unboundedPreceding, 0)``
sends every row of a key to one task; with one key holding a third of the
data that task is the whole job. ``running`` first counts the rows of each key
(partial counts, so only keys are shuffled). Keys of ordinary size take the
plain window: one shuffle, nothing written. The rows of keys above
``spark.amphora.hotKeyRows`` (default 2**20), and all rows where there are no
keys, are put in order over many tasks (``in_order``):

1. a range sort by ``(keys, order)`` splits a hot key over many balanced
   partitions;
2. each sorted partition is walked once, batch by batch, and the last key and
   its values are carried from one batch to the next (a stateful
   ``mapInArrow`` in the stage of the sort, so no exchange follows it); the
   rows are written once with their values so far in the partition;
3. the last row of each partition tells what the key that it ends with has
   come to there; these few rows become the carry-in of the next partition;
4. the carry-in is added to the rows of that key: a partition has one at most,
   so the broadcast table has no more rows than the sort has partitions.

What lies between the input's last exchange and ``running`` is computed twice,
once for the counts. That is cheaper than writing rows that a generator
multiplies; pin an input that is dear to compute.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amphora.session import ensure_checkpoint_dir, pin_table

_KINDS = {"sum": F.sum, "max": F.max, "min": F.min, "xor": F.bit_xor}

#: A key with more rows is spread over tasks.
HOT_KEY_ROWS = 1 << 20


def _differs(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Whether each value differs from the one before it (``before`` for the
    first one; None: there is none). Nulls are equal to each other, and NaNs."""
    shifted = column.slice(0, len(column) - 1)
    if before is not None:
        shifted = pa.concat_arrays([pa.array([before.as_py()], type=column.type), shifted])
    now = column if before is not None else column.slice(1)
    if pa.types.is_nested(column.type):
        out = np.array([a != b for a, b in zip(now.to_pylist(), shifted.to_pylist())], dtype=bool)
    else:
        out = pc.fill_null(pc.not_equal(now, shifted), False).to_numpy(zero_copy_only=False)
        out |= (pc.is_null(now).to_numpy(zero_copy_only=False) != pc.is_null(shifted).to_numpy(zero_copy_only=False))
        if pa.types.is_floating(column.type):
            nan = [pc.fill_null(pc.is_nan(x), False).to_numpy(zero_copy_only=False) for x in (now, shifted)]
            out &= ~(nan[0] & nan[1])
    return out if before is not None else np.append(True, out)


def _numbers(values: pa.Array, slices: np.ndarray, kind: str) -> pa.Array:
    """Running sum, max, min or exclusive or of a column of integers or doubles inside slices."""
    empty = pc.is_null(values).to_numpy(zero_copy_only=False)
    if kind == "xor":
        whole = np.bitwise_xor.accumulate(pc.fill_null(values, pa.scalar(0, values.type)).to_numpy(zero_copy_only=False))
        firsts = np.flatnonzero(np.append(True, slices[1:] != slices[:-1]))
        before = np.append(np.zeros(1, dtype=whole.dtype), whole)[firsts]
        none_yet = pd.Series((~empty).astype(np.int8)).groupby(slices, sort=False).cummax().to_numpy() == 0 if empty.any() else None
        return pa.array(whole ^ np.repeat(before, np.diff(np.append(firsts, len(whole)))), type=values.type, mask=none_yet)
    floating = pa.types.is_floating(values.type)
    if floating:
        least, most = -np.inf, np.inf
    else:
        least, most = np.iinfo(values.type.to_pandas_dtype()).min, np.iinfo(values.type.to_pandas_dtype()).max
    neutral = {"sum": 0, "max": least, "min": most}[kind]
    raw = pc.fill_null(values, pa.scalar(neutral, values.type)).to_numpy(zero_copy_only=False)
    nan = np.isnan(raw) if floating else np.zeros(len(raw), dtype=bool)
    grouped = pd.Series(np.where(nan, neutral, raw) if nan.any() else raw).groupby(slices, sort=False)
    out = getattr(grouped, {"sum": "cumsum", "max": "cummax", "min": "cummin"}[kind])().to_numpy()
    if kind == "sum" and not floating:
        total = pd.Series(raw.astype(np.float64)).groupby(slices, sort=False).cumsum().abs().max()
        if total > 9.2e18:
            raise OverflowError("a running sum leaves the range of a long")
    if nan.any():  # NaN is larger than any number and makes a sum NaN
        if kind == "min":
            first = pd.Series((~nan & ~empty).astype(np.int8)).groupby(slices, sort=False).cummax().to_numpy() == 0
            seen = pd.Series(nan.astype(np.int8)).groupby(slices, sort=False).cummax().to_numpy() == 1
            out = np.where(first & seen, np.nan, out)
        else:
            out = np.where(pd.Series(nan.astype(np.int8)).groupby(slices, sort=False).cummax().to_numpy() == 1, np.nan, out)
    none_yet = pd.Series((~empty).astype(np.int8)).groupby(slices, sort=False).cummax().to_numpy() == 0 if empty.any() else None
    return pa.array(out, type=values.type, mask=none_yet)


def _combine(kind: str, a, b):
    if a is None or b is None:
        return b if a is None else a
    if kind == "xor":
        return a ^ b
    return a + b if kind == "sum" else max(a, b) if kind == "max" else min(a, b)


def _any_values(values: pa.Array, slices: np.ndarray, kind: str) -> pa.Array:
    """The same for any other type, value by value."""
    out, held, at = [], None, -1
    for value, number in zip(values.to_pylist(), slices.tolist()):
        held, at = (value if number != at else _combine(kind, held, value)), number
        out.append(held)
    return pa.array(out, type=values.type)


def _so_far(values: pa.Array, before: pa.Scalar | None, slices: np.ndarray, kind: str) -> pa.Array:
    """Running values; ``before`` is what the first slice's key has come to."""
    if before is not None and before.is_valid:
        values = pa.concat_arrays([pa.array([before.as_py()], type=values.type), values])
        slices = np.append(slices[0], slices)
    plain = pa.types.is_floating(values.type) or pa.types.is_signed_integer(values.type)
    out = (_numbers if plain else _any_values)(values, slices, kind)
    return out.slice(1) if before is not None and before.is_valid else out


def _carried(keys: list[str], kinds: dict[str, str]):
    """``mapInArrow`` function over a sorted partition: the columns of ``kinds``
    become their running values, ``_pid`` numbers the partition, ``_last``
    marks its last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        pending: pa.RecordBatch | None = None

        def marked(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
            flags = np.zeros(batch.num_rows, dtype=bool)
            flags[-1] = last
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, number, dtype=np.int32)), pa.array(flags)]
            return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_pid", "_last"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, dtype=bool)
            for key in keys:
                new |= _differs(batch.column(key), pending.column(key)[-1] if pending is not None else None)
            goes_on = pending is not None and not new[0]
            slices = np.cumsum(new)
            columns = [
                _so_far(batch.column(f.name), pending.column(f.name)[-1] if goes_on else None, slices, kinds[f.name]) if f.name in kinds else batch.column(f.name)
                for f in batch.schema
            ]
            if pending is not None:
                yield marked(pending, False)
            pending = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        if pending is not None:
            yield marked(pending, True)

    return run


def running(
    df: DataFrame,
    order: Sequence[Column],
    aggs: dict[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Add one column per ``aggs`` entry ``name -> (kind, value)`` with the
    inclusive running ``kind`` (sum/max/min/xor) of ``value`` over ``order``
    within ``keys``. ``order`` must be a total order inside a key for a
    deterministic result. Null keys are one key; null values add nothing, and
    the result is null until the key's first value, as with a plain window.
    ``key_rows``: the keys with the number of their rows, ``n`` (or no less),
    where that is known already; else it is counted."""
    ensure_checkpoint_dir(df.sparkSession)
    if not keys:
        return in_order(df, order, aggs)
    most = int(df.sparkSession.conf.get("spark.amphora.hotKeyRows", str(HOT_KEY_ROWS)))
    counted = key_rows if key_rows is not None else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = pin_table(counted.where(F.col("n") > most).select(*keys).distinct(), "hot-keys")
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    windowed = lambda rows: rows.select("*", *[_KINDS[k](v).over(so_far).alias(n) for n, (k, v) in aggs.items()])
    if hot.isEmpty():
        return windowed(df)
    same = F.lit(True)
    for i, k in enumerate(keys):
        hot = hot.withColumnRenamed(k, f"_hot{i}")
        same = same & df[k].eqNullSafe(hot[f"_hot{i}"])
    return windowed(df.join(hot, same, "left_anti")).unionAll(in_order(df.join(hot, same, "left_semi"), order, aggs, keys))


def in_order(df: DataFrame, order: Sequence[Column], aggs: dict[str, tuple[str, Column]], keys: Sequence[str] = ()) -> DataFrame:
    """``running`` for rows of hot keys: a range sort and a pass in order."""
    names = {f"_v{i}": n for i, n in enumerate(aggs)}
    kinds = {f"_v{i}": k for i, (k, _) in enumerate(aggs.values())}
    values = {f"_v{i}": v for i, (_, v) in enumerate(aggs.values())}
    made = df.select(*[_KINDS[kinds[n]](v).alias(n) for n, v in values.items()]).schema
    base = df.select("*", *[values[f.name].cast(f.dataType).alias(f.name) for f in made])
    written = T.StructType([T.StructField(f.name, f.dataType) for f in base.schema] + [T.StructField("_pid", T.IntegerType()), T.StructField("_last", T.BooleanType())])
    ordered = base.orderBy(*[F.col(k).asc() for k in keys], *order)
    pinned = pin_table(ordered.mapInArrow(_carried(list(keys), kinds), written), "running")

    # One row a partition: what the key that it ends with has come to there,
    # added up over the partitions that end with the same key, goes to the
    # next partition.
    so_far = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = pinned.where("_last").select(
        F.lead("_pid").over(Window.orderBy("_pid")).alias("_cpid"),
        *[F.col(k).alias(f"_ck{i}") for i, k in enumerate(keys)],
        *[_KINDS[kinds[n]](n).over(so_far).cast(made[n].dataType).alias(f"{n}_carry") for n in values],
    )
    same = F.col("_pid") == F.col("_cpid")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_ck{i}"))
    joined = pinned.join(F.broadcast(carry), same, "left")
    out = []
    for n in values:
        own, before = F.col(n), F.col(f"{n}_carry")
        if kinds[n] == "sum":
            # Null on either side: nothing to add from there yet.
            both = F.when(own.isNull(), before).otherwise(own + F.coalesce(before, F.lit(0))).cast(made[n].dataType)
        elif kinds[n] == "xor":
            both = F.when(own.isNull(), before).otherwise(own.bitwiseXOR(F.coalesce(before, F.lit(0))))
        else:
            both = (F.greatest if kinds[n] == "max" else F.least)(own, before)
        out.append(both.alias(names[n]))
    return joined.select(*[F.col(c) for c in df.columns], *out)
