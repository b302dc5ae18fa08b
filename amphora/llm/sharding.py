"""Shards of near-equal bytes by sampled splitters.

A size-weighted sample of keys is drawn, its quantiles are the boundaries of
many small ranges, and the records are counted exactly by range. A range that
came out too large, or inside which a shard should end, is subdivided by a
sample of its own. Shards are runs of
neighbouring ranges cut where the running size is nearest to each equal share.
Ranges are over (key, place of the row), so one key may be cut in two.

Nulls and edges: a null text has 0 bytes; a null key is the smallest; rows with
equal keys or texts are told apart by the place they were read from and may be
in different shards; a row that is larger than a share has its range for
itself; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amphora.llm.arrays import NULL_ID
from amphora.session import pin_table

N_SHARDS = 24

#: Ranges for each shard, and drawn keys for each range: what the driver holds
#: is bounded by their product and the number of shards.
RANGES, DRAWS = 128, 4

#: A range inside which a shard should end is cut into so many, until the end
#: is within this fraction of a share.
FINER, CLOSE = 16, 0.001


def _weighted_draws(rows: DataFrame, draws: float, salt: int) -> list[tuple[int, int, float]]:
    """(key, place, weight): a row is drawn with a probability in proportion to
    its size, decided by a hash of its place; weights add up to about all bytes."""
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return []
    chance = F.least(F.lit(1.0), F.col("size") * (draws / total))
    lot = F.pmod(F.xxhash64("place", F.lit(salt)), F.lit(1 << 52)) / float(1 << 52)
    drawn = rows.where(lot < chance).select("key", "place", (F.col("size") / chance).alias("weight"))
    return sorted((r["key"], r["place"], r["weight"]) for r in drawn.collect())


def _quantiles(drawn: list[tuple[int, int, float]], parts: int) -> list[tuple[int, int]]:
    """Boundaries (first key and place of each range but the first) of about equal weight."""
    if parts < 2 or not drawn:
        return []
    weights = np.array([w for _, _, w in drawn])
    begins = np.cumsum(weights) - weights
    at = np.searchsorted(begins, np.arange(1, parts) * (weights.sum() / parts))
    return sorted({drawn[i][:2] for i in at if i < len(drawn)})


def range_numbers(keys: np.ndarray, places: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """How many boundaries are at or before each (key, place)."""
    bound_keys = np.array([b[0] for b in bounds], dtype=np.int64)
    bound_places = np.array([b[1] for b in bounds], dtype=np.int64)
    low, high = (np.searchsorted(bound_keys, keys, side) for side in ("left", "right"))
    out = low.copy()
    for first in np.unique(low[high > low]):
        rows = np.flatnonzero((low == first) & (high > low))
        last = high[rows[0]]
        out[rows] = first + np.searchsorted(bound_places[first:last], places[rows], "right")
    return out


def _with_ranges(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "place"))
            yield batch.append_column("range", pa.array(range_numbers(keys, places, bounds), pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", range long"
    return rows.mapInArrow(run, schema)


def _totals(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    sizes, counts = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for r in rows.groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        sizes[r["range"]], counts[r["range"]] = r["size"], r["n"]
    return sizes, counts


def cuts_of(sizes: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each range: a shard ends where the running size is nearest to its share."""
    ends = np.append(0, np.cumsum(sizes))
    shares = ends[-1] * np.arange(1, n_shards) / n_shards
    after = np.clip(np.searchsorted(ends, shares), 1, max(1, len(ends) - 1))
    nearer = np.where(shares - ends[after - 1] <= ends[np.minimum(after, len(ends) - 1)] - shares, after - 1, after)
    return np.searchsorted(nearer, np.arange(len(sizes)), "right")


def _cut_ranges(sizes: np.ndarray, n_shards: int) -> np.ndarray:
    """Ranges inside which a share ends, unless it ends within ``CLOSE`` of a share of their bounds."""
    ends = np.append(0, np.cumsum(sizes))
    shares = ends[-1] * np.arange(1, n_shards) / n_shards
    at = np.clip(np.searchsorted(ends, shares), 1, max(1, len(sizes)))
    off = np.minimum(np.abs(ends[at] - shares), np.abs(shares - ends[at - 1]))
    return np.unique(at[off > CLOSE * ends[-1] / n_shards] - 1)


def shard_by_bytes(docs: DataFrame, n_shards: int = N_SHARDS, key_col: str = "doc_id", text_col: str = "text", extra: int = 8, ranges: int = RANGES, rounds: int = 5) -> DataFrame:
    """(``key_col``, size, text_crc32, shard, slot): size is the text's UTF-8
    bytes plus ``extra``; slots are gapless from 0 in key order."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = pin_table(docs.select(
        F.col(key_col).alias("own_key"), F.coalesce(F.col(key_col).cast("long"), F.lit(NULL_ID)).alias("key"), F.monotonically_increasing_id().alias("place"),
        (F.octet_length(text) + extra).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    ), "sizes")
    parts = n_shards * ranges
    bounds = _quantiles(_weighted_draws(rows, parts * DRAWS, 0), parts)
    for turn in range(1, rounds + 1):
        dealt = _with_ranges(rows, bounds)
        sizes, counts = _totals(dealt, len(bounds) + 1)
        most = max(1.0, 2 * sizes.sum() / parts)
        wanted = np.where(sizes > most, np.ceil(2 * sizes / most), 0)
        wanted[_cut_ranges(sizes, n_shards)] += FINER
        over = np.flatnonzero((wanted > 0) & (counts > 1))
        if not len(over):
            break
        drawn = _weighted_draws(dealt.where(F.col("range").isin([int(r) for r in over])), float(wanted[over].sum() * DRAWS * 2), turn)
        own = range_numbers(np.array([d[0] for d in drawn], dtype=np.int64), np.array([d[1] for d in drawn], dtype=np.int64), bounds)
        more = {b for r in over for b in _quantiles([d for d, k in zip(drawn, own) if k == r], int(wanted[r]))}
        if more <= set(bounds):
            break
        bounds = sorted(set(bounds) | more)
    else:
        dealt = _with_ranges(rows, bounds)
        sizes, counts = _totals(dealt, len(bounds) + 1)
    shards = cuts_of(sizes, n_shards)
    before = np.cumsum(counts) - counts
    first = before - before[np.searchsorted(shards, shards)]
    # One row a range: a table whose size the parameters bound.
    places = docs.sparkSession.createDataFrame([(int(r), int(s), int(f)) for r, (s, f) in enumerate(zip(shards, first))], "range long, shard int, first long")
    within = F.row_number().over(Window.partitionBy("range").orderBy("key", "place"))
    slotted = dealt.withColumn("within", within).join(F.broadcast(places), "range")
    return slotted.select(F.col("own_key").alias(key_col), "size", "text_crc32", "shard", (F.col("first") + F.col("within") - 1).cast("long").alias("slot"))
