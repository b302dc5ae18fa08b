"""Near-duplicate vectors by a pivot-permutation index.

A bounded sample of the vectors are pivots. A vector is described by its
nearest pivots in order of nearness; those pivots' inverted lists name it. Two
vectors are candidates if they share at least ``shared`` of their ``nearest``
pivots, and every candidate is verified by its cosine in double precision. A
pair that shares so many pivots shares one of its rarest ``nearest - shared +
1``, so only these lists hold the vector, and a pair is counted in the rarest
list that it has in common. A long list is cut into blocks, and pairs of
blocks are tasks of their own: no list, bucket or candidate is capped.

Equal vectors are one vector with a multiplicity. The index can miss links (it
never adds any): ``recall`` measures it against all pairs.

Nulls and edges: vectors that are null, empty, zero or that hold nulls or
non-finite numbers link with nothing and are components of their own; vectors
of unlike lengths never link, those of another length than the pivots' are
compared with all of their length; rows with equal ids keep a row each; a null
id is no component's smallest unless there is no other; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amphora.llm.components import components, smallest_reachable
from amphora.session import pin_table

COSINE, NEAREST, SHARED = 0.95, 12, 4

#: One pivot for so many distinct vectors, and at most so many pivots; they go
#: to every task, which at 64 numbers of 4 bytes is 4 MB at most.
VECTORS_PER_PIVOT, MOST_PIVOTS = 32, 16384

#: No two pivots are nearer than this: in a dense cluster, the order of pivots
#: of its own would say nothing.
PIVOT_COSINE = 0.8

#: Vectors of a list that are compared with each other in one block.
BLOCK = 1024


def linkable(vector: Column) -> Column:
    """Whether a vector can have a cosine."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def apart(drawn: np.ndarray, most: float = PIVOT_COSINE) -> np.ndarray:
    """The drawn unit vectors, without those too near to one before them."""
    kept = drawn[:0]
    for at in range(0, len(drawn), 256):
        some = drawn[at : at + 256]
        some = some[(some @ kept.T < most).all(axis=1)] if len(kept) else some
        near, own = some @ some.T >= most, np.ones(len(some), dtype=bool)
        for i in range(len(some)):
            if own[i]:
                own[i + 1 :] &= ~near[i, i + 1 :]
        kept = np.concatenate([kept, some[own]])
    return kept


def _describe(pivots: np.ndarray, nearest: int):
    """Numbers of the nearest pivots, the nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            vectors = batch.column("vector")
            lengths = np.diff(vectors.offsets.to_numpy())
            for at in range(0, batch.num_rows, 512):
                some = lengths[at : at + 512]
                out = np.empty((len(some), nearest), dtype=np.int64)
                out[:] = -1 - some[:, None]  # unlike lengths: a list of that length
                fits = np.flatnonzero(some == pivots.shape[1])
                if len(fits):
                    near = _unit(_matrix(vectors.take(pa.array(at + fits)), pivots.shape[1])) @ pivots.T
                    top = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
                    order = np.argsort(-np.take_along_axis(near, top, axis=1), axis=1, kind="stable")
                    out[fits] = np.take_along_axis(top, order, axis=1)
                found.append(out)
            flat = np.concatenate(found) if found else np.zeros((0, nearest), dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * nearest), pa.array(flat.ravel()))
            yield batch.append_column("pivots", lists)

    return run


def _postings(rank: np.ndarray, blocks: np.ndarray, kept: int, odd_blocks: dict[int, int]):
    """A row for each of a vector's lists and pair of blocks that it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivots = batch.column("pivots").flatten().to_numpy().reshape(batch.num_rows, -1)
            gid = batch.column("gid").to_numpy()
            odd = pivots[:, 0] < 0
            order = np.argsort(rank[np.where(pivots < 0, 0, pivots)], axis=1, kind="stable")[:, :kept]
            lists = np.take_along_axis(pivots, order, axis=1)
            rows, keys, lows, highs = [], [], [], []
            for column in range(lists.shape[1]):
                key = lists[:, column]
                n = np.where(key < 0, [odd_blocks.get(int(k), 1) if k < 0 else 1 for k in key], blocks[np.maximum(key, 0)])
                n = np.where(odd & (column > 0), 0, n)  # all lists of an odd length are one
                own = (gid.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % np.maximum(n, 1)
                row = np.repeat(np.arange(len(key)), n)
                other = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                rows.append(row)
                keys.append(key[row])
                lows.append(np.minimum(own[row], other))
                highs.append(np.maximum(own[row], other))
            rows, keys, lows, highs = (np.concatenate(x) for x in (rows, keys, lows, highs))
            block = (gid.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            step = 4096
            for at in range(0, len(rows), step):
                some = pa.array(rows[at : at + step])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[at : at + step]), pa.array(lows[at : at + step]), pa.array(highs[at : at + step]),
                    batch.column("gid").take(some), batch.column("copies").take(some), batch.column("vector").take(some), batch.column("pivots").take(some), pa.array(block[rows[at : at + step]]),
                ], names=["list", "low", "high", "gid", "copies", "vector", "pivots", "mixed"])

    return run


def _bits(places: np.ndarray, n: int) -> np.ndarray:
    """Sets of places below ``n`` as rows of 64-bit words; -1 is no place."""
    out = np.zeros((len(places), -(-n // 64)), dtype=np.uint64)
    rows, columns = np.nonzero(places >= 0)
    at = places[rows, columns]
    np.bitwise_or.at(out, (rows, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    return out


def _common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many places each set of the left has in common with each of the right."""
    out = np.zeros((len(left), len(right)), dtype=np.uint8)
    for word in range(left.shape[1]):
        out += np.bitwise_count(left[:, word, None] & right[None, :, word])
    return out


def _verify(rank: np.ndarray, blocks: np.ndarray, odd_blocks: dict[int, int], kept: int, shared: int, cosine: float):
    """Links of one pair of blocks: numbers of links and a forest."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number, low, high = (k.as_py() for k in key)
        table = table.combine_chunks()
        vectors = table.column("vector").chunk(0) if table.num_rows else None
        width = len(vectors[0]) if vectors is not None else 0
        gid, copies = table.column("gid").to_numpy(), table.column("copies").to_numpy()
        pivots = table.column("pivots").chunk(0).flatten().to_numpy().reshape(len(gid), -1)
        x = _unit(_matrix(vectors, width))
        n = int(blocks[number]) if number >= 0 else odd_blocks.get(number, 1)
        block = table.column("mixed").to_numpy() % n
        if number >= 0:
            used, local = np.unique(pivots, return_inverse=True)
            local = local.reshape(pivots.shape)
            has = _bits(local, len(used))
            # The lists that hold a vector and are rarer than this one.
            order = np.argsort(rank[pivots], axis=1)[:, :kept]
            lists = np.take_along_axis(local, order, axis=1)
            rarer = _bits(np.where(rank[used[lists]] < rank[number], lists, -1), len(used))
        degree = np.zeros(len(gid), dtype=np.int64)
        pairs = [np.zeros((0, 2), dtype=np.int64)]
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            if number >= 0:
                # Candidates: enough pivots in common, and no rarer list in
                # common that counts the pair. Only these are verified.
                met = (_common(has[rows], has[right]) >= shared) & (_common(rarer[rows], rarer[right]) == 0)
                if low == high:
                    met &= rows[:, None] < right[None, :]
                i, j = np.nonzero(met)
                met[i, j] = np.einsum("ij,ij->i", x[rows[i]], x[right[j]]) >= cosine
            else:
                met = x[rows] @ x[right].T >= cosine
                if low == high:
                    met &= rows[:, None] < right[None, :]
            degree[rows] += met @ copies[right]
            degree[right] += met.T @ copies[rows]
            i, j = np.nonzero(met)
            pairs.append(np.stack([rows[i], right[j]], axis=1))
        i, j = np.concatenate(pairs).T
        label = smallest_reachable(len(gid), i, j)
        linked, counted = np.flatnonzero(label != np.arange(len(gid))), np.flatnonzero(degree)
        return pa.table({
            "a": np.concatenate([gid[linked], gid[counted]]), "b": np.concatenate([gid[label[linked]], np.full(len(counted), -1)]),
            "n": np.concatenate([np.zeros(len(linked), dtype=np.int64), degree[counted]]),
        })

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED, per_pivot: int = VECTORS_PER_PIVOT, block: int = BLOCK,
) -> DataFrame:
    """(``id_col``, n_links, component_id, kept), one row for each of ``vectors``."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    own = own.withColumn("vector", F.when(linkable(F.col("vector")), F.transform("vector", lambda x: x + 0.0)))  # -0.0 is 0.0
    groups = pin_table(
        own.where("vector IS NOT NULL").groupBy("vector").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .withColumn("gid", F.monotonically_increasing_id()), "vectors")
    n = groups.count()
    wanted = min(MOST_PIVOTS, max(2 * nearest, -(-n // per_pivot)))
    # The pivots: rows of the smallest hashes, of the length that most of them have.
    drawn = [r[0] for r in groups.orderBy(F.xxhash64("vector"), "gid").select("vector").limit(wanted).collect()]
    lengths = [len(v) for v in drawn]
    width = max(set(lengths), key=lengths.count) if lengths else 1
    same = np.array([v for v in drawn if len(v) == width], dtype=np.float64).reshape(-1, width)
    pivots = apart(_unit(same)) if len(same) else same
    nearest = min(nearest, len(pivots))
    shared = min(shared, nearest)
    kept = nearest - shared + 1
    if nearest == 0:
        linked = own.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    else:
        described = pin_table(groups.select("gid", "copies", "vector").mapInArrow(_describe(pivots, nearest), "gid long, copies long, vector array<double>, pivots array<long>"), "pivot-order")
        held = {r[0]: r[1] for r in described.select(F.explode("pivots").alias("p")).groupBy("p").count().collect()}
        counts = np.array([held.get(p, 0) for p in range(len(pivots))], dtype=np.int64)
        rank = np.empty(len(pivots), dtype=np.int64)
        rank[np.lexsort((np.arange(len(pivots)), counts))] = np.arange(len(pivots))
        blocks = np.maximum(1, -(-counts // block))
        odd_blocks = {p: max(1, -(-c // (nearest * block))) for p, c in held.items() if p < 0}
        rows = described.mapInArrow(
            _postings(rank, blocks, kept, odd_blocks),
            "list long, low long, high long, gid long, copies long, vector array<double>, pivots array<long>, mixed long")
        found = pin_table(rows.groupBy("list", "low", "high").applyInArrow(_verify(rank, blocks, odd_blocks, kept, shared, cosine), "a long, b long, n long"), "vector-links")
        degrees = found.where("b = -1").groupBy("a").agg(F.sum("n").alias("n"))
        joined = components(found.where("b >= 0").select("a", "b"))
        roots = groups.join(degrees, groups.gid == degrees.a, "left").join(joined, groups.gid == joined.node, "left").select(
            "vector", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "gid").alias("root"))
        smallest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
        named = roots.join(smallest, "root").select("vector", "n_links", "component_id")
        alone = own.where("vector IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
        linked = own.where("vector IS NOT NULL").join(named, "vector").select("id", "n_links", "component_id").union(alone)
    return linked.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def recall(found: DataFrame, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, every: int = 50) -> float | None:
    """Share of the links between different vectors of every ``every``-th id,
    against all rows, that ``found`` has. Equal vectors are linked without the
    index, so their links are left out; None where there are no others. Queries
    and table are compared in blocks."""
    own = vectors.where(linkable(F.col(vector_col))).select(F.col(id_col).alias("id"), F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + 0.0).alias("vector"))
    groups = pin_table(own.groupBy("vector").agg(F.count("*").alias("copies")).withColumn("gid", F.monotonically_increasing_id()), "recall-vectors")
    queries = pin_table(own.where(F.col("id") % every == 0).join(groups, "vector").select("id", "gid", "copies"), "recall-queries")

    def blocks(df: DataFrame, *columns: str) -> DataFrame:
        rows = df.groupBy(F.size("vector").alias("width"), F.floor(F.col("gid") / BLOCK).alias("block"))
        return rows.agg(F.collect_list(F.struct(*columns)).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("left"), batch.column("right")):
                left, right = left.values, right.values
                width = len(left.field("vector")[0])
                near = _unit(_matrix(left.field("vector"), width)) @ _unit(_matrix(right.field("vector"), width)).T >= cosine
                other = left.field("gid").to_numpy()[:, None] != right.field("gid").to_numpy()[None, :]
                yield pa.RecordBatch.from_arrays([left.field("gid"), pa.array((near & other) @ right.field("copies").to_numpy())], names=["gid", "n"])

    sides = blocks(groups.join(queries, "gid", "left_semi"), "gid", "vector").select("width", F.col("rows").alias("left"))
    pairs = sides.join(blocks(groups, "gid", "copies", "vector").select("width", F.col("rows").alias("right")), "width")
    true = pairs.select("left", "right").mapInArrow(run, "gid long, n long").groupBy("gid").agg(F.sum("n").alias("n"))
    named = queries.join(true, "gid").groupBy("id").agg(F.sum("n").alias("n"), F.sum(F.col("copies") - 1).alias("equal"))
    got = found.select(F.col(id_col).alias("id"), "n_links").groupBy("id").agg(F.sum("n_links").alias("n_links"))
    both = named.join(got, "id").agg(F.sum("n"), F.sum(F.col("n_links") - F.col("equal"))).first()
    return both[1] / both[0] if both[0] else None
