"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has a bit set where over half of its shingles' hashes
have it. Two fingerprints differ in at most ``2 * half`` bits exactly if a
value exists that differs from either in at most ``half`` bits, so every
fingerprint emits all such variants and fingerprints that meet at one are a
pair. The variants are dealt by their leading bits: a fingerprint is sent once
to each bucket where it has variants, and the bucket's task writes them out
there, so that the shuffle carries a few dozen copies of a fingerprint instead
of thousands. Fingerprints that meet are linked in a star, verified by their
distance, and joined into components.

Nulls and edges: null and empty texts and texts without a word have the
fingerprint zero, linked like any other; rows with equal texts or ids keep a
row each; null ids are no component's smallest id unless it has no other; an
empty table gives no rows. No row, candidate or pair is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amphora.llm.arrays import as_bytes, by_group, squeeze, text_slices, tidy, tidy_group, to_batches, unsqueeze
from amphora.llm.components import components, smallest_reachable
from amphora.session import pin_table

SHINGLE, DISTANCE, SEED = 4, 4, 42

#: Variants that a task holds at once.
HELD = 1 << 21


def fingerprint(text: bytes, words: int = SHINGLE, seed: int = SEED) -> bytes:
    """Eight bytes, the highest bit first."""
    found = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not found:
        return bytes(8)
    joined = b" ".join(found)
    digest = xxhash.xxh64_digest
    if len(found) < words:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist())]
    bits = np.zeros(64, dtype=np.int64)
    rows = np.frombuffer(b"".join(hashes), dtype=np.uint8).reshape(-1, 8)
    for start in range(0, len(rows), 1 << 16):
        bits += np.unpackbits(rows[start : start + (1 << 16)], axis=1).sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * bits > len(rows)).tobytes()


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fingerprint as a long) of every row."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([own.schema["id"], T.StructField("fingerprint", T.LongType())])
    arrow = to_arrow_schema(schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "text"):
                prints = b"".join([fingerprint(t, words, seed) for t in as_bytes(piece.column("text"))])
                yield from to_batches({"id": piece.column("id"), "fingerprint": np.frombuffer(prints, dtype=">i8").astype(np.int64)}, arrow)

    return own.mapInArrow(run, schema)


def flips(low: int, high: int, most: int) -> list[np.ndarray]:
    """Masks of exactly 0, 1, ... ``most`` set bits among bits low to high - 1."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(low, high), k)], dtype=np.uint64) for k in range(most + 1)]


def _deal(prefix: int, half: int):
    """Send each fingerprint to the buckets (leading bits) of its variants."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.concatenate(flips(64 - prefix, 64, half))
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            buckets = ((prints[:, None] ^ masks[None, :]) >> np.uint64(64 - prefix)).astype(np.int64).ravel()
            order, groups, at = by_group(buckets)
            own = prints[order // len(masks)]
            yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array([squeeze(own[a:b]) for a, b in zip(at, at[1:])], pa.binary())], names=["bucket", "prints"])

    return run


def _meet(prefix: int, half: int):
    """Write out the variants that fall into one bucket and link what meets."""

    @tidy_group
    def run(key: tuple, table: pa.Table) -> pa.Table:
        prints = np.unique(np.concatenate([unsqueeze(x, "<u8") for x in table.column("prints").to_pylist()]))
        used = np.bitwise_count((prints >> np.uint64(64 - prefix)) ^ np.uint64(key[0].as_py()))
        masks = flips(0, 64 - prefix, half)
        allowed = [np.concatenate(masks[: half - k + 1]) for k in range(half + 1)]
        keep = np.uint64((1 << (64 - prefix)) - 1)
        parts = [(np.flatnonzero(used == k), m) for k, m in enumerate(allowed)]
        rounds = max(1, -(-sum(len(who) * len(m) for who, m in parts) // HELD))
        pairs = [np.zeros((0, 2), dtype=np.int64)]
        for turn in range(rounds):  # each variant belongs to one turn, so a turn holds a bounded share of them
            variants, owners = [], []
            for who, own_masks in parts:
                step = max(1, HELD // len(own_masks))
                for at in range(0, len(who), step):
                    some = who[at : at + step]
                    made = ((prints[some] & keep)[:, None] ^ own_masks[None, :]).ravel()
                    owner = np.repeat(some, len(own_masks))
                    if rounds > 1:
                        with np.errstate(over="ignore"):
                            mine = (made * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(rounds) == turn
                        made, owner = made[mine], owner[mine]
                    variants.append(made)
                    owners.append(owner)
            made, owner = np.concatenate(variants), np.concatenate(owners)
            order = np.argsort(made, kind="stable")
            made, owner = made[order], owner[order]
            first = np.append(True, made[1:] != made[:-1])
            star = owner[np.flatnonzero(first)][np.cumsum(first) - 1]
            met = np.flatnonzero(~first)
            pairs.append(np.unique(np.stack([star[met], owner[met]], axis=1), axis=0))
        a, b = np.unique(np.concatenate(pairs), axis=0).T
        near = np.bitwise_count(prints[a] ^ prints[b]) <= 2 * half
        label = smallest_reachable(len(prints), a[near], b[near])
        linked = np.flatnonzero(label != np.arange(len(prints)))
        return pa.table({"a": prints[linked].view(np.int64), "b": prints[label[linked]].view(np.int64)})

    return run


def ball_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints of one long column into
    the components of the relation "at most ``distance`` bits apart"."""
    if distance % 2:
        raise ValueError("the distance is twice the radius of a ball")
    half = distance // 2
    n = prints.count()
    emitted = sum(math.comb(64, k) for k in range(half + 1))
    prefix = min(40, max(4, math.ceil(math.log2(max(2, n * emitted / HELD)))))
    dealt = prints.mapInArrow(_deal(prefix, half), "bucket long, prints binary")
    return dealt.groupBy("bucket").applyInArrow(_meet(prefix, half), "a long, b long")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, fingerprint (16 hex digits) and
    component_id, the smallest id among the texts reachable over links."""
    found = pin_table(with_fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    distinct = pin_table(found.groupBy("fingerprint").agg(F.min("id").alias("first")), "distinct-fingerprints")
    joined = components(ball_links(distinct.select("fingerprint"), distance))
    roots = distinct.join(joined, distinct.fingerprint == joined.node, "left").select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(smallest, "root").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
