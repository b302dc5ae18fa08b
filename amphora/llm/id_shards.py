"""Token ids in shard files with a minimal perfect hash index.

Documents are range-partitioned and sorted by key, encoded, and written as
shards: one row of a Parquet table holds the raw little-endian ids of its
documents one after the other, and an index from key to place. The index is a
minimal perfect hash: every key sets a bit of its own in the first level where
no other key hits that bit, and the rank of the bit is the key's slot, told by
the bits set before its block and those before it in the block. A slot stores
a fingerprint of the key, so that keys which were never stored are told apart,
and where the ids begin and how many they are.

A look-up reads the index columns of the shards whose key range holds the key,
tests one bit a level and compares one slot's fingerprint, and then reads the
payload of the shards that have it: every row is a data page of its own, so
Parquet's page index leads to those pages, and only the document's own bytes
are cut out of them. Both reads are bounded by ``shard_ids`` (and by the
longest document), whatever the number of shards.

Nulls and edges: keys are integers (other types are cast, and what is none
raises); a null text is empty (its end id alone is stored); null keys come
first and are read with all others, not looked up; rows that share a key are
all stored, as occurrences 0, 1, ... of the key in a shard; a key that fills
more than one shard is in several; a text longer than a shard is a shard of its
own; an empty table gives a table without shards; other columns are not read,
so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from amphora.llm.arrays import offsets_of, text_slices, tidy, to_batches
from amphora.llm.encoders import EncoderSpec

#: A shard is closed when it holds this many ids.
SHARD_IDS = 1 << 20

#: Bytes of a block of bits, before which the bits set are stored.
BLOCK = 32

#: Ranges of keys, and shards, that are named in a predicate for the scan; more
#: are merged into wider ranges and told apart by the join.
NAMED = 256

#: Every row a data page of its own, found by the page index.
PARQUET = {
    "compression": "none", "parquet.enable.dictionary": "false",
    "parquet.page.row.count.limit": "1", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
}

SHARDS = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("base", T.LongType()),  # ids of the part before this shard
    T.StructField("first_key", T.LongType()),
    T.StructField("last_key", T.LongType()),
    T.StructField("n_docs", T.IntegerType()),
    T.StructField("n_null_keys", T.IntegerType()),
    T.StructField("n_ids", T.LongType()),
    T.StructField("id_bytes", T.IntegerType()),
    T.StructField("keys", T.BinaryType()),
    T.StructField("levels", T.ArrayType(T.BinaryType())),
    T.StructField("ranks", T.ArrayType(T.BinaryType())),  # of each level: bits set before each block, those of earlier levels too
    T.StructField("fingerprints", T.BinaryType()),
    T.StructField("starts", T.BinaryType()),
    T.StructField("lengths", T.BinaryType()),
    T.StructField("payload", T.BinaryType()),
])


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer: multiply and fold, three times."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93):
            x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
        return x ^ (x >> np.uint64(32))


def hash_keys(keys: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    return mix(keys.view(np.uint64), 1) ^ mix(occurrence.astype(np.uint64) * np.uint64(2) + nulls.astype(np.uint64), 2)


class PerfectHash:
    """Bits of each level, packed, with the bits set before each block of them."""

    def __init__(self, levels: list[bytes], ranks: list[bytes] | None = None):
        self.bits = [np.frombuffer(x, dtype=np.uint8) for x in levels]
        self.ranks = [np.frombuffer(x, dtype="<u4") for x in (self.count(levels) if ranks is None else ranks)]

    @staticmethod
    def count(levels: list[bytes]) -> list[bytes]:
        before, out = 0, []
        for level in levels:
            ones = np.bitwise_count(np.frombuffer(level, dtype=np.uint8)).astype(np.int64)
            blocks = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK))
            out.append((before + np.cumsum(blocks) - blocks).astype("<u4").tobytes())
            before += int(ones.sum())
        return out

    @staticmethod
    def build(hashes: np.ndarray, load: float = 2.0, most: int = 64) -> list[bytes]:
        """``hashes`` must be distinct."""
        levels, left = [], hashes
        while len(left):
            if len(levels) == most:
                raise ValueError("keys with equal 64-bit hashes")
            size = -(-int(load * len(left) + 1) // 8) * 8
            at = (mix(left, 3 + len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone).tobytes())
            left = left[~alone[at]]
        return levels

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 where no level has its bit. A key that was not
        stored can get a slot: compare the fingerprint."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for number, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            open_ = np.flatnonzero(out < 0)
            at = (mix(hashes[open_], 3 + number) % np.uint64(8 * len(bits))).astype(np.int64)
            hit = np.flatnonzero(bits[at >> 3] >> (7 - at & 7) & 1)
            for some in np.array_split(hit, len(hit) // 4096 + 1):
                byte, block = at[some] >> 3, (at[some] >> 3) // BLOCK
                # The block's bytes up to the key's own, of which only the bits before it count.
                near = block[:, None] * BLOCK + np.arange(BLOCK)
                held = bits[np.minimum(near, len(bits) - 1)] * (near <= byte[:, None])
                own = np.arange(len(some)), byte % BLOCK
                held[own] >>= (8 - (at[some] & 7)).astype(np.uint8)
                out[open_[some]] = ranks[block] + np.bitwise_count(held).sum(axis=1, dtype=np.int64)
        return out


def fingerprints_of(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes, 99) >> np.uint64(32)).astype("<u4")


def _occurrences(keys: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """How many equal keys come before each; equal keys are neighbours."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])
    firsts = np.flatnonzero(new)
    return np.arange(len(keys)) - np.repeat(firsts, np.diff(np.append(firsts, len(keys))))


def _shard(part: int, shard: int, base: int, keys: list, ids: list[np.ndarray], id_bytes: int) -> dict:
    nulls = np.array([k is None for k in keys], dtype=bool)
    values = np.array([k or 0 for k in keys], dtype=np.int64)
    hashes = hash_keys(values, nulls, _occurrences(values, nulls))
    levels = PerfectHash.build(hashes)
    ranks = PerfectHash.count(levels)
    slots = PerfectHash(levels, ranks).slots(hashes)
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    stored = {"fingerprints": fingerprints_of(hashes), "starts": offsets_of(lengths)[:-1].astype("<u4"), "lengths": lengths.astype("<u4")}
    for name, column in stored.items():
        by_slot = np.empty_like(column)
        by_slot[slots] = column
        stored[name] = by_slot.tobytes()
    known = [k for k in keys if k is not None]
    return stored | {
        "part": part, "shard": shard, "base": base, "n_docs": len(keys), "n_null_keys": int(nulls.sum()), "n_ids": int(lengths.sum()),
        "first_key": known[0] if known else None, "last_key": known[-1] if known else None, "id_bytes": id_bytes,
        "keys": values.astype("<i8").tobytes(), "levels": levels, "ranks": ranks,
        "payload": np.concatenate(ids).astype(f"<u{id_bytes}").tobytes(),
    }


def write_id_shards(
    docs: DataFrame, spec: EncoderSpec, path: str, key_col: str = "doc_id", text_col: str = "text", end_id: int = 1, shard_ids: int = SHARD_IDS,
) -> None:
    """Write the shards of ``docs`` in ascending key order as a Parquet table
    at ``path``. A hot key is spread over tasks by a hash of its text."""
    schema = to_arrow_schema(SHARDS)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = spec.load(), TaskContext.get().partitionId()
        id_bytes = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        keys: list = []
        ids: list[np.ndarray] = []
        shard = base = held = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal shard, base, held
            row = _shard(part, shard, base, keys, ids, id_bytes)
            yield from to_batches({k: [v] for k, v in row.items()}, schema)
            shard, base, held = shard + 1, base + row["n_ids"], 0
            keys.clear()
            ids.clear()

        for batch in batches:
            for piece in text_slices(batch, "text"):
                found, ends = encoder.encode(piece.column("text"))
                for row, key in enumerate(piece.column("key").to_pylist()):
                    keys.append(key)
                    ids.append(np.append(found[ends[row] : ends[row + 1]], np.uint32(end_id)))
                    held += len(ids[-1])
                    if held >= shard_ids:
                        yield from close()
        if keys:
            yield from close()

    own = docs.select(F.col(key_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    spread = F.xxhash64("text")
    dealt = own.repartitionByRange("key", spread).sortWithinPartitions("key", spread)
    dealt.mapInArrow(run, SHARDS).write.options(**PARQUET).parquet(path)


def _documents(row: dict, keys: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Look-up of keys in one shard: which are there, their starts and lengths."""
    hashes = hash_keys(keys, nulls, occurrence)
    slots = PerfectHash(row["levels"], row["ranks"]).slots(hashes)
    slots_of = np.maximum(slots, 0)
    there = (slots >= 0) & (np.frombuffer(row["fingerprints"], "<u4")[slots_of] == fingerprints_of(hashes))
    return there, np.frombuffer(row["starts"], "<u4")[slots_of].astype(np.int64), np.frombuffer(row["lengths"], "<u4")[slots_of].astype(np.int64)


def _read(schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys = np.frombuffer(row["keys"], "<i8")
                nulls = np.arange(len(keys)) < row["n_null_keys"]
                occurrence = _occurrences(keys, nulls)
                there, starts, lengths = _documents(row, keys, nulls, occurrence)
                if not there.all():
                    raise ValueError("a stored key is not in its index")
                ids = np.frombuffer(row["payload"], f"<u{row['id_bytes']}").astype("<u4")
                yield from to_batches({
                    "key": pa.array(keys, pa.int64(), mask=nulls), "occurrence": occurrence, "start": row["base"] + row["part_base"] + starts, "n_tokens": lengths,
                    "ids": [ids[s : s + n].tobytes() for s, n in zip(starts.tolist(), lengths.tolist())],
                }, schema)

    return run


def _find(wanted: np.ndarray, schema: pa.Schema):
    """Places of the wanted keys, by the index columns alone."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                asked, occ = wanted[np.searchsorted(wanted, row["first_key"]) : np.searchsorted(wanted, row["last_key"], side="right")], 0
                while len(asked):  # the next occurrence of the keys that had this one
                    there, starts, lengths = _documents(row, asked, np.zeros(len(asked), bool), np.full(len(asked), occ))
                    n = int(there.sum())
                    yield from to_batches({
                        "part": [row["part"]] * n, "shard": [row["shard"]] * n, "base": [row["base"]] * n, "id_bytes": [row["id_bytes"]] * n,
                        "key": asked[there], "occurrence": [occ] * n, "at": starts[there], "n_tokens": lengths[there],
                    }, schema)
                    asked, occ = asked[there], occ + 1

    return run


def _widen(schema: pa.Schema):
    """Ids of 32 bits from the stored ones."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("id_bytes").to_pylist()
            ids = [np.frombuffer(raw, f"<u{n}").astype("<u4").tobytes() for raw, n in zip(batch.column("raw").to_pylist(), sizes)]
            yield from to_batches({c: batch.column(c) for c in ("key", "occurrence", "start", "n_tokens")} | {"ids": ids}, schema)

    return run


READ = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("occurrence", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])

FOUND = T.StructType([
    *(SHARDS[c] for c in ("part", "shard", "base", "id_bytes")),
    *(READ[c] for c in ("key", "occurrence", "n_tokens")),
    T.StructField("at", T.LongType()),  # ids of the shard before it
])


def _part_bases(shards: DataFrame) -> DataFrame:
    """Ids of all parts before each: one row for each task that wrote."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))


def find_keys(spark: SparkSession, path: str, keys: Sequence[int]) -> DataFrame:
    """Places of ``keys``: part, shard, base, id_bytes, key, occurrence,
    n_tokens, at. No payload is read."""
    wanted = np.unique(np.array(list(keys), dtype=np.int64))
    in_range = F.lit(False)
    for some in np.array_split(wanted, min(len(wanted), NAMED)) if len(wanted) else ():
        in_range = in_range | ((F.col("first_key") <= int(some[-1])) & (F.col("last_key") >= int(some[0])))
    index = spark.read.schema(SHARDS).parquet(path).where(in_range)
    columns = ["part", "shard", "base", "id_bytes", "first_key", "last_key", "levels", "ranks", "fingerprints", "starts", "lengths"]
    return index.select(*columns).mapInArrow(_find(wanted, to_arrow_schema(FOUND)), FOUND)


def payloads(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """part, shard and payload of the shards that ``found`` names. Up to
    ``NAMED`` shards are named to the scan, whose page index leads to them."""
    shards = spark.read.schema(SHARDS).parquet(path).select("part", "shard", "payload")
    named = found.select("part", "shard").distinct().limit(NAMED + 1).collect()
    if len(named) > NAMED:
        return shards
    either = F.lit(False)
    for part in sorted({r["part"] for r in named}):
        either = either | ((F.col("part") == part) & F.col("shard").isin(sorted(r["shard"] for r in named if r["part"] == part)))
    return shards.where(either)


def read_id_shards(spark: SparkSession, path: str, keys: Sequence[int] | None = None) -> DataFrame:
    """Every stored document (or those of ``keys``), found through the index of
    its shard: key, occurrence, start (ids stored before it), n_tokens, ids
    (little-endian unsigned 32-bit). For ``keys`` the index of the shards whose
    key range holds one is read first, then the payload of those that have one."""
    shards = spark.read.schema(SHARDS).parquet(path)
    bases = F.broadcast(_part_bases(shards))
    if keys is None:
        return shards.join(bases, "part").mapInArrow(_read(to_arrow_schema(READ)), READ)
    found = find_keys(spark, path, keys)
    raw = F.substring("payload", (F.col("at") * F.col("id_bytes") + 1).cast("int"), (F.col("n_tokens") * F.col("id_bytes")).cast("int"))
    cut = found.join(bases, "part").join(payloads(spark, path, found), ["part", "shard"])
    cut = cut.select("key", "occurrence", (F.col("part_base") + F.col("base") + F.col("at")).alias("start"), "n_tokens", "id_bytes", raw.alias("raw"))
    return cut.mapInArrow(_widen(to_arrow_schema(READ)), READ)
