"""Prefix trie of conversations from padded matrices of turn ids.

A node is a distinct sequence of first turns. Conversations are cut into
segments of ``SEGMENT`` turns, so that one that holds a large part of all
turns is many rows; a segment's group is all that came before it, told by the
exclusive or of hashes of its turns and their places (128 bits). Segments are
range-partitioned by group and turns into shards of a measured size, where
numpy

* pads the turns to a matrix of dense turn ids and sorts it (``lexsort``);
* marks where each row differs from the one before it, column by column, and
  accumulates the marks with a logical or: a mark at a column is the start of
  a node of that depth;
* sums over the rows of every node of a depth at once (``reduceat``).

Nodes that hold a shard's first or last row can go on in the next shard; they
and the nodes at the end of a segment are recombined by Spark. All other nodes
are whole.

Sums over subtrees take two passes. The first finds each node's smallest
member, which takes the node's own saving and, for a node without children, a
count of one; so each conversation has a total. The second adds the totals of
the members of each node: that is the sum over its subtree and over those of
its ancestors that have the same smallest member, and the latter are a running
sum along that member's own turns.

The list of conversations that end at a node is digested in order: whole nodes
in their shard, the others from the shards' parts of the list, which a task
reads one after the other without holding them.

Nulls and edges: rows without a conversation are left out; turns are ordered
by number, null first, and turns that share a number by the digest of role and
text; a null role or text is empty; repeated rows are turns of their own; very
long conversations are many segments, very long texts only a digest and a
length; further columns are not read, so their names cannot clash; a table
without conversations has no nodes. A conversation without turns is a member
of the root alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amphora.llm.arrays import tidy, to_batches
from amphora.operators.running import running
from amphora.session import pin_table

#: Turns of a segment: columns of a matrix.
SEGMENT = 64

#: Turns of a shard, about.
SHARD_TURNS = 1 << 19

#: Bytes of a part of a list of conversations.
PART_BYTES = 1 << 14

EMPTY = hashlib.sha256(b"").hexdigest()

TOTALS = T.StructType([T.StructField(n, T.LongType()) for n in ("conv_id", "saved", "leaves", "a", "b", "depth", "n_convs", "n_end", "chars")])

#: kind 0: a whole node; 1: part of a node; 2: children of a node of another
#: shard; 3: part of a list of conversations.
PARTS = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("kind", "shard", "a", "b", "depth", "up_a", "up_b", "up_conv", "conv_id", "n_convs", "n_end", "n_children", "saved", "leaves", "chars")],
    T.StructField("ends", T.StringType()),
])


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, pos`` (from 0), ``id`` (128 bits of the SHA-256 of role and
    text) and ``chars`` of every turn; texts are not moved."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(said.cast("binary"), 256), 1, 32)).alias("id"), F.length(text).cast("long").alias("chars"),
    ).where("conv_id IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), F.col("id").asc()]
    placed = running(turns, order, {"place": ("sum", F.lit(1).cast("long"))}, keys=["conv_id"])
    return pin_table(placed.select("conv_id", (F.col("place") - 1).alias("pos"), "id", "chars"), "turns")


def _segments(turns: DataFrame, segment: int) -> DataFrame:
    """One row for each segment: ``conv_id, seg, path``, the hashes of what
    came before it, whether it is the conversation's last."""
    hashed = turns.select(
        "conv_id", F.floor(F.col("pos") / segment).cast("long").alias("seg"), "pos", "chars",
        F.xxhash64(F.lit(1), "pos", "id").alias("za"), F.xxhash64(F.lit(2), "pos", "id", "pos").alias("zb"))
    segments = pin_table(hashed.groupBy("conv_id", "seg").agg(
        F.array_sort(F.collect_list(F.struct("pos", "za", "zb", "chars"))).alias("path"), F.bit_xor("za").alias("xa"), F.bit_xor("zb").alias("xb")), "segments")
    slim = segments.select("conv_id", "seg", "xa", "xb")
    through = running(slim, [F.col("seg").asc()], {"ta": ("xor", F.col("xa")), "tb": ("xor", F.col("xb"))}, keys=["conv_id"])
    before = through.select("conv_id", "seg", F.col("ta").bitwiseXOR(F.col("xa")).alias("pa"), F.col("tb").bitwiseXOR(F.col("xb")).alias("pb"))
    earlier = slim.where("seg > 0").select("conv_id", (F.col("seg") - 1).alias("seg"), F.lit(True).alias("goes_on"))
    return pin_table(segments.join(before, ["conv_id", "seg"]).join(earlier, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", "pa", "pb", F.col("goes_on").isNull().alias("last"), "path"), "segments")


class _Matrix:
    """The sorted segments of a shard and the nodes of every column."""

    def __init__(self, batch: pa.RecordBatch, segment: int, totals: bool):
        self.segment = segment
        col = lambda n: batch.column(n).to_numpy(zero_copy_only=False)
        path = batch.column("path")
        at = path.offsets.to_numpy().astype(np.int64)
        flat = path.flatten()
        za, zb, chars = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("za", "zb", "chars"))
        lengths, at = np.diff(at), at - at[0]
        heads = _dense(col("seg"), col("pa"), col("pb"))
        ids = _dense(za, zb)
        width = int(lengths.max())
        row_of = np.repeat(np.arange(len(lengths)), lengths)
        matrix = np.full((len(lengths), width), -1, dtype=np.int32)
        matrix[row_of, np.arange(len(ids)) - at[row_of]] = ids
        order = np.lexsort((col("conv_id"), *[matrix[:, j] for j in range(width - 1, -1, -1)], heads))
        self.matrix, self.heads, self.lengths, self.begin = matrix[order], heads[order], lengths[order], at[:-1][order]
        self.za, self.zb, self.chars, self.width = za, zb, chars, width
        self.conv, self.seg, self.last = col("conv_id")[order], col("seg")[order], col("last")[order]
        self.pa, self.pb = col("pa")[order].copy(), col("pb")[order].copy()
        if totals:
            self.saved, self.leaves = col("t_saved")[order], col("t_leaves")[order]

    def columns(self) -> Iterator[dict[str, np.ndarray]]:
        """For each column: the rows that reach it, where its nodes start in
        them, and the hashes of the nodes and of their parents."""
        n = len(self.conv)
        changed = np.append(True, self.heads[1:] != self.heads[:-1])
        a, b, rows = self.pa.copy(), self.pb.copy(), np.arange(n)
        for j in range(self.width):
            changed[1:] |= self.matrix[1:, j] != self.matrix[:-1, j]
            rows = rows[self.lengths[rows] > j]
            starts = np.flatnonzero(changed[rows])
            first = rows[starts]
            up_a, up_b = a[first], b[first]
            a[rows] ^= self.za[self.begin[rows] + j]
            b[rows] ^= self.zb[self.begin[rows] + j]
            n_convs = np.diff(np.append(starts, len(rows)))
            ended = (self.lengths[rows] == j + 1) & self.last[rows]
            node_of = np.repeat(np.arange(len(starts)), n_convs)
            open_ = np.zeros(len(starts), dtype=bool)
            for edge in (0, n - 1):
                at = np.searchsorted(rows, edge)
                if at < len(rows) and rows[at] == edge:
                    open_[node_of[at]] = True
            yield {
                "rows": rows, "starts": starts, "first": first, "node_of": node_of, "ended": ended, "open": open_, "a": a[first], "b": b[first], "up_a": up_a, "up_b": up_b,
                "depth": self.seg[first] * self.segment + j + 1, "conv_id": np.minimum.reduceat(self.conv[rows], starts), "n_convs": n_convs,
                "n_end": np.add.reduceat(ended.astype(np.int64), starts), "chars": self.chars[self.begin[first] + j],
            }


def _dense(*parts: np.ndarray) -> np.ndarray:
    """Dense numbers in the order of the parts."""
    order = np.lexsort(parts[::-1])
    new = np.zeros(len(order), dtype=np.int32)
    for p in parts:
        s = p[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), dtype=np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch | None:
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _totals(segment: int):
    schema = to_arrow_schema(TOTALS)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (batch := _whole(batches)) is None:
            return
        own = _Matrix(batch, segment, totals=False)
        convs, saved, leaves = [], [], []
        for c in own.columns():
            whole = ~c["open"]
            convs.append(c["conv_id"][whole])
            saved.append(((c["n_convs"] - 1) * c["chars"])[whole])
            leaves.append((c["n_end"] == c["n_convs"])[whole])
            part = c["open"]
            nothing = pa.nulls(int(part.sum()), pa.int64())
            yield from to_batches({n: c[n][part] for n in ("conv_id", "a", "b", "depth", "n_convs", "n_end", "chars")} | {"saved": nothing, "leaves": nothing}, schema)
        ids, at = np.unique(np.concatenate(convs), return_inverse=True)
        sums = [np.zeros(len(ids), dtype=np.int64) for _ in range(2)]
        for total, values in zip(sums, (saved, leaves)):
            np.add.at(total, at, np.concatenate(values).astype(np.int64))
        nothing = pa.nulls(len(ids), pa.int64())
        yield from to_batches({"conv_id": ids, "saved": sums[0], "leaves": sums[1]} | {n: nothing for n in ("a", "b", "depth", "n_convs", "n_end", "chars")}, schema)

    return run


def _lists(conv: np.ndarray) -> list[tuple[int, str]]:
    """Parts of a list of ascending ids: the first id, the ids joined."""
    step = PART_BYTES // 20
    return [(int(conv[i]), ",".join(map(str, conv[i : i + step].tolist()))) for i in range(0, len(conv), step)]


def _nodes(segment: int):
    schema = to_arrow_schema(PARTS)
    names = [f.name for f in schema]

    def rows_of(kind: int, shard: int, n: int, **columns) -> Iterator[pa.RecordBatch]:
        given = {"kind": np.full(n, kind), "shard": np.full(n, shard)} | columns
        return to_batches({name: given.get(name, pa.nulls(n, schema.field(name).type)) for name in names}, schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (batch := _whole(batches)) is None:
            return
        own, shard = _Matrix(batch, segment, totals=True), TaskContext.get().partitionId()
        held = None  # the column before, which waits for its children
        for j, c in enumerate(own.columns()):
            # A node at the end of a segment has its children elsewhere.
            c["part"] = c["open"] | (j == segment - 1)
            c["saved"] = np.add.reduceat(own.saved[c["rows"]], c["starts"])
            c["leaves"] = np.add.reduceat(own.leaves[c["rows"]], c["starts"])
            c["n_children"] = np.zeros(len(c["starts"]), dtype=np.int64)
            counted = ~c["open"] if j < segment - 1 else np.zeros(len(c["starts"]), dtype=bool)  # those that no other shard has
            if held is None:
                far = _dense(c["up_a"][counted], c["up_b"][counted]) if counted.any() else np.zeros(0, dtype=np.int32)
                _, first, n = np.unique(far, return_index=True, return_counts=True)
                yield from rows_of(2, shard, len(first), a=c["up_a"][counted][first], b=c["up_b"][counted][first], n_children=n)
                up_conv, up_part = np.zeros(len(c["starts"]), dtype=np.int64), np.ones(len(c["starts"]), dtype=bool)
            else:
                up = held["node_of"][np.searchsorted(held["rows"], c["first"])]
                # Children of whole nodes are whole; of parts, those that no other shard has.
                np.add.at(held["n_children"], up[counted | (~held["part"][up])], 1)
                up_conv, up_part = held["conv_id"][up], held["part"][up]
                yield from emit(held, own, shard)
            c["up_conv"], c["up_part"] = up_conv, up_part
            held = c
        yield from emit(held, own, shard)

    def emit(c: dict, own: _Matrix, shard: int) -> Iterator[pa.RecordBatch]:
        ended = c["rows"][c["ended"]]
        of = c["node_of"][c["ended"]]
        digests = [EMPTY] * len(c["starts"])
        cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, dtype=np.int64)
        lists: list[tuple[int, int, str]] = []
        for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(of)]):
            node = int(of[s])
            if c["part"][node]:
                lists += [(node, *part) for part in _lists(own.conv[ended[s:e]])]
            else:
                digests[node] = hashlib.sha256(",".join(map(str, own.conv[ended[s:e]].tolist())).encode()).hexdigest()
        for kind, which in ((0, ~c["part"]), (1, c["part"])):
            n = int(which.sum())
            columns = {name: c[name][which] for name in ("a", "b", "depth", "up_a", "up_b", "conv_id", "n_convs", "n_end", "n_children", "saved", "leaves", "chars")}
            up_conv = pa.array(c["up_conv"][which], pa.int64(), mask=c["up_part"][which])
            ends = pa.array([d for d, w in zip(digests, which.tolist()) if w], pa.string()) if kind == 0 else pa.nulls(n, pa.string())
            yield from rows_of(kind, shard, n, up_conv=up_conv, ends=ends, **columns)
        if lists:
            at = np.array([x[0] for x in lists])
            yield from rows_of(3, shard, len(lists), a=c["a"][at], b=c["b"][at], conv_id=np.array([x[1] for x in lists]), ends=pa.array([x[2] for x in lists]))

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list from its parts, which come in order."""
    node, digest, done = None, None, []

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.string())], names=["a", "b", "ends_sha256"])
        done.clear()
        return out

    for batch in batches:
        for a, b, text in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "ends"))):
            if (a, b) == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256()
            digest.update(text.encode())
        if done:
            yield flush()
    if node is not None:
        done.append((*node, digest.hexdigest()))
        yield flush()


def _member_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations without turns, as parts of the root's list."""
    for batch in batches:
        lists = _lists(batch.column(0).to_numpy())
        zero = np.zeros(len(lists), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(zero), pa.array(zero), pa.array([x[0] for x in lists], pa.int64()), pa.array([x[1] for x in lists], pa.string())], names=["a", "b", "conv_id", "ends"])


def trie(turns: DataFrame, members: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``members`` (column conv_id, one row each)
    with the turns ``turns`` (conv_id, pos from 0 without gaps, id, chars).

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``."""
    segments = _segments(turns, segment)
    told = members.join(segments.where("seg = 0").select("conv_id", F.lit(True).alias("has_turns")), "conv_id", "left")
    told = pin_table(told.select("conv_id", F.col("has_turns").isNull().alias("turnless")), "members")
    root = told.agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n"), F.count_if("turnless").alias("n_end")).first()
    n_turns = segments.agg(F.sum(F.size("path"))).first()[0] or 0
    shards = max(1, -(-int(n_turns) // shard_turns))
    # The whole path is in the key, so a hot group of equal ones is split by conversation.
    dealt = lambda df: df.repartitionByRange(shards, "seg", "pa", "pb", "path", "conv_id")

    first = pin_table(dealt(segments).mapInArrow(_totals(segment), TOTALS), "trie-totals")
    joined = first.where("a IS NOT NULL").groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_end").alias("n_end"), F.max("chars").alias("chars"))
    own = joined.select("conv_id", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), (F.col("n_end") == F.col("n_convs")).cast("long").alias("leaves"))
    totals = first.where("a IS NULL").select("conv_id", "saved", "leaves").unionAll(own).groupBy("conv_id").agg(
        F.sum("saved").alias("t_saved"), F.sum("leaves").alias("t_leaves"))
    totals = pin_table(totals, "trie-totals")

    zero = F.lit(0).cast("long")
    weighed = segments.join(totals, "conv_id", "left").withColumns({"t_saved": F.coalesce("t_saved", zero), "t_leaves": F.coalesce("t_leaves", zero)})
    parts = pin_table(dealt(weighed).mapInArrow(_nodes(segment), PARTS), "trie-parts")

    # Nodes in parts, and the root, whose conversations are all members.
    sums = totals.agg(F.coalesce(F.sum("t_saved"), zero).alias("saved"), F.coalesce(F.sum("t_leaves"), zero).alias("leaves"))
    of_root = sums.select(
        *[F.lit(v).cast("long").alias(n) for n, v in (("kind", 1), ("a", 0), ("b", 0), ("depth", 0), ("conv_id", root["conv"]), ("n_convs", root["n"]), ("n_end", root["n_end"]), ("n_children", 0), ("chars", 0))],
        "saved", "leaves").where(F.col("n_convs") > 0)
    some = parts.where("kind IN (1, 2)").drop("shard", "ends")
    merged = some.unionByName(of_root, allowMissingColumns=True).groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"), F.max("up_conv").alias("up_conv"),
        *[F.sum(n).alias(n) for n in ("n_convs", "n_end", "n_children", "saved", "leaves")], F.max("chars").alias("chars"))
    merged = pin_table(merged, "trie-merged")
    inner = merged.where("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("more"))
    turnless = told.where("turnless").select("conv_id")
    lists = parts.where("kind = 3").select("a", "b", "conv_id", "ends").unionAll(
        turnless.repartitionByRange("conv_id").sortWithinPartitions("conv_id").mapInArrow(_member_parts, "a long, b long, conv_id long, ends string"))
    digests = lists.repartition("a", "b").sortWithinPartitions("a", "b", "conv_id").mapInArrow(_digests, "a long, b long, ends_sha256 string")
    merged = merged.join(inner, ["a", "b"], "left").join(digests, ["a", "b"], "left").select(
        "a", "b", "conv_id", "depth", "up_a", "up_b", "up_conv", "n_convs", (F.col("n_children") + F.coalesce("more", zero)).alias("n_children"), "saved", "leaves", "chars",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    merged = pin_table(merged, "trie-merged")

    # Parents that are in parts: each shard's nodes ask for those of that
    # shard, so a parent of very many nodes is joined shard by shard. The
    # root needs no join.
    wanted = parts.where("kind IN (1, 2)").select("shard", "a", "b").distinct()
    parents = wanted.join(merged.select("a", "b", F.col("conv_id").alias("parent")), ["a", "b"]).select("shard", F.col("a").alias("up_a"), F.col("b").alias("up_b"), "parent")
    columns = ["conv_id", "depth", "n_convs", "n_children", "saved", "leaves", "chars", "ends_sha256"]
    whole = parts.where("kind = 0").withColumnRenamed("ends", "ends_sha256")
    from_here = whole.where("up_conv IS NOT NULL OR depth = 1").select(*columns, F.when(F.col("depth") == 1, F.lit(root["conv"])).otherwise(F.col("up_conv")).alias("parent_conv_id"))
    from_parts = whole.where("up_conv IS NULL AND depth > 1").join(parents, ["shard", "up_a", "up_b"]).select(*columns, F.col("parent").alias("parent_conv_id"))
    above = merged.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent"))
    of_merged = merged.join(above, ["up_a", "up_b"], "left").select(*columns, F.coalesce("up_conv", "parent"))
    nodes = from_here.unionAll(from_parts).unionAll(of_merged)

    nodes = nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("chars"))
    through = running(pin_table(nodes, "trie-nodes"), [F.col("depth").asc()], {"through": ("sum", F.col("own"))}, keys=["conv_id"])
    return through.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.greatest("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        (F.col("saved") - F.col("through") + F.col("own")).alias("saved_tokens"), "ends_sha256")
