"""Removal of word passages that occur earlier in the corpus.

Every window of ``window`` consecutive words of a document has a Rabin-Karp
hash: the polynomial of its words' hashes, taken from running sums. A task
sorts its documents and marks the windows that it has met before; of the rest
it sends hash and place, packed, to the bucket that the hash's leading bits
name. There equal windows of all tasks meet and all but the first are marked.
Marks go to the documents' blocks, overlapping marked windows merge into
maximal intervals, and the documents drop the words in them.

A window is removed if its words also start earlier: at a smaller id, or
earlier in the same document. Windows are judged on the input. A hash has
``64 + 24`` bits: with 10**13 windows, two different ones meet with a
probability of about one half; with 10**11, of one in ten thousand.

Nulls and edges: a null text has no words and stays null; texts without words
or with fewer than a window stay as they are; a null id counts as the smallest;
rows with the same id and text are each judged as the only one, rows with the
same id and other texts are told apart by the hash of their text, the smaller
first; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amphora.llm.arrays import NULL_ID, as_bytes, by_group, doc_keys, filled, squeeze, text_slices, tidy, tidy_group, to_batches, unsqueeze, words_of
from amphora.session import pin_table

WINDOW = 20

#: Odd bases of the two polynomials, and what undoes them modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

#: Bits of the second hash that are kept beside the 64 of the first.
EXTRA_BITS = 24

#: A side of this many bytes at most, as Parquet, is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 16 << 20

#: Text bytes of a slice whose windows are hashed and sorted at once; a worker
#: holds several numbers of eight bytes for each of its words.
SLICE = 3 << 20

PARCELS = T.StructType([
    T.StructField("goes_to", T.LongType()),
    T.StructField("block", T.LongType()),
    T.StructField("parts", T.ArrayType(T.BinaryType())),
])


def word_hashes(words: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each word."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(w) for w in words.tolist()]), dtype="<u8").reshape(-1, 2)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def rolling(hashes: np.ndarray, window: int, base: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of every window of consecutive words."""
    n = len(hashes) - window + 1
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum(hashes * _powers(base, len(hashes) - 1)[: len(hashes)], dtype=np.uint64))
        return (sums[window:] - sums[:n]) * _powers(pow(base, -1, 1 << 64), n - 1)[:n]


def windows_of(column: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of all windows, their documents and starts, and the documents' numbers of words."""
    words, codes, starts = words_of(column)
    counts = np.diff(starts)
    per_doc = np.maximum(counts - window + 1, 0)
    doc = np.repeat(np.arange(len(counts)), per_doc)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    if not len(doc):
        none = np.zeros(0, dtype=np.uint64)
        return none, none, doc, start, counts
    table = word_hashes(words)
    at = starts[:-1][doc] + start
    both = [rolling(table[:, k][codes], window, base)[at] for k, base in enumerate(BASES)]
    return both[0], both[1] >> np.uint64(64 - EXTRA_BITS), doc, start, counts


def _block_of(docs: np.ndarray, blocks: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = docs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def _mark_parcels(docs: np.ndarray, tags: np.ndarray, starts: np.ndarray, blocks: int) -> Iterator[tuple[int, list[bytes]]]:
    """Marked windows by the block of their document."""
    order, groups, at = by_group(_block_of(docs, blocks))
    for group, a, b in zip(groups.tolist(), at, at[1:]):
        some = order[a:b]
        some = some[np.lexsort((starts[some], tags[some], docs[some]))]
        yield group, [squeeze(np.diff(docs[some], prepend=0)), squeeze(tags[some]), squeeze(starts[some].astype("<i8"))]


def _scan(window: int, prefix: int, blocks: int, schema: pa.Schema):
    """Windows of each slice: marks for repeats inside it, the rest to the buckets."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE):
                keys, tags = doc_keys(piece.column("id")), piece.column("tag").to_numpy(zero_copy_only=False)
                rank = np.lexsort((tags, keys))
                piece, keys, tags = piece.take(pa.array(rank)), keys[rank], tags[rank]
                h, extra, doc, start, _ = windows_of(filled(piece.column("text")), window)
                order = np.argsort(h, kind="stable")  # documents and starts stay in order
                hs, xs = h[order], extra[order]
                same = np.append(False, (hs[1:] == hs[:-1]) & (xs[1:] == xs[:-1]))
                lead = order[np.flatnonzero(~same)][np.cumsum(~same) - 1] if len(order) else order
                later = same & ((keys[doc[order]] != keys[doc[lead]]) | (tags[doc[order]] != tags[doc[lead]]) | (start[order] != start[lead]))
                marked = order[later]
                out = [(block % (1 << prefix), block, parts) for block, parts in _mark_parcels(keys[doc[marked]], tags[doc[marked]], start[marked], blocks)]
                sent = np.sort(order[~same])
                buckets = (h[sent] >> np.uint64(64 - prefix)).astype(np.int64)
                # As many whole bytes of the first hash as the bucket does not tell, then the second's.
                told = prefix // 8
                raw = np.empty((len(sent), 8 - told + EXTRA_BITS // 8), dtype=np.uint8)
                raw[:, : 8 - told] = h[sent].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - told]
                raw[:, 8 - told :] = extra[sent].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : EXTRA_BITS // 8]
                at_order, groups, at = by_group(buckets)
                for bucket, a, b in zip(groups.tolist(), at, at[1:]):
                    some = at_order[a:b]
                    who, own = np.unique(doc[sent[some]], return_inverse=True)
                    begin = start[sent[some]]
                    out.append((bucket, -1, [
                        raw[some].tobytes(), squeeze(np.diff(keys[who], prepend=0)), squeeze(tags[who]),
                        squeeze(np.diff(own, prepend=0).astype("<u4")), squeeze(_steps(begin, own)),
                    ]))
                yield from _parcels(out, schema)

    return run


def _steps(begin: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Starts as steps from the one before in the same document."""
    out = np.diff(begin, prepend=0)
    new = np.append(True, own[1:] != own[:-1])
    out[new] = begin[new]
    return out.astype("<u4")


def _unsteps(steps: np.ndarray, own: np.ndarray) -> np.ndarray:
    sums = np.cumsum(steps.astype(np.int64))
    new = np.append(True, own[1:] != own[:-1])
    firsts = np.flatnonzero(new)
    base = sums[firsts] - steps[firsts]
    return sums - base[np.cumsum(new) - 1]


def _parcels(rows: list[tuple[int, int, list[bytes]]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        to, block, parts = zip(*rows)
        yield from to_batches({"goes_to": list(to), "block": list(block), "parts": list(parts)}, schema)


def _meet(prefix: int, blocks: int, schema: pa.Schema):
    """Mark all but the first of equal windows in one bucket; marks pass through."""

    @tidy_group
    def run(key: tuple, table: pa.Table) -> pa.Table:
        told, rows, out = prefix // 8, [], []
        for block, parts in zip(table.column("block").to_pylist(), table.column("parts").to_pylist()):
            if block >= 0:
                out.append((block, block, parts))
                continue
            raw = np.frombuffer(parts[0], dtype=np.uint8).reshape(-1, 8 - told + EXTRA_BITS // 8)
            hashes = np.zeros((len(raw), 16), dtype=np.uint8)
            hashes[:, : 8 - told] = raw[:, : 8 - told]
            hashes[:, 8 : 8 + EXTRA_BITS // 8] = raw[:, 8 - told :]
            own = np.cumsum(unsqueeze(parts[3], "<u4"), dtype=np.int64)
            rows.append((hashes.view("<u8"), np.cumsum(unsqueeze(parts[1], "<i8"))[own], unsqueeze(parts[2], "<i8")[own], _unsteps(unsqueeze(parts[4], "<u4"), own)))
        if rows:
            hashes, docs, tags, starts = (np.concatenate(x) for x in zip(*rows))
            order = np.argsort(hashes[:, 0], kind="stable")
            own = hashes[order, 0]
            equal = own[1:] == own[:-1]
            order = order[np.append(False, equal) | np.append(equal, False)]  # only what has an equal neighbour
            order = order[np.lexsort((starts[order], tags[order], docs[order], hashes[order, 1], hashes[order, 0]))]
            first = np.append(True, (hashes[order[1:]] != hashes[order[:-1]]).any(axis=1)) if len(order) else np.zeros(0, bool)
            lead = order[np.flatnonzero(first)][np.cumsum(first) - 1] if len(order) else order
            later = order[(docs[order] != docs[lead]) | (tags[order] != tags[lead]) | (starts[order] != starts[lead])]
            out += [(block, block, parts) for block, parts in _mark_parcels(docs[later], tags[later], starts[later], blocks)]
        return pa.Table.from_batches(_parcels(out, schema), schema)

    return run


def merged_intervals(docs: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals covered by ``length`` words from each start; rows are sorted by document and start."""
    new = np.append(True, (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + length))
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(docs)) - 1
    return docs[firsts], starts[firsts], starts[lasts] + length


SPANS = "id long, tag long, begins array<long>, ends array<long>"


def _spans(window: int):
    @tidy_group
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = table.column("parts").to_pylist()
        docs, tags, starts = (np.concatenate([x(unsqueeze(p[k], "<i8")) for p in parts]) for k, x in enumerate((np.cumsum, np.asarray, np.asarray)))
        order = np.lexsort((starts, tags, docs))
        docs, tags, starts = docs[order], tags[order], starts[order]
        new = np.append(True, (docs[1:] != docs[:-1]) | (tags[1:] != tags[:-1]))
        number = np.cumsum(new) - 1
        whose, begins, ends = merged_intervals(number, starts, window)
        at = pa.array(np.searchsorted(whose, np.arange(number[-1] + 2)).astype(np.int32))
        ids = docs[new]
        return pa.table({
            "id": pa.array(ids, mask=ids == NULL_ID), "tag": tags[new],
            "begins": pa.ListArray.from_arrays(at, pa.array(begins)), "ends": pa.ListArray.from_arrays(at, pa.array(ends)),
        })

    return run


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _apply(columns: list[str], schema: pa.Schema):
    """Cut the intervals' words out of the texts."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "text"):
                texts = as_bytes(piece.column("text"))
                _, _, starts = words_of(filled(piece.column("text")))
                n_words, n_removed = np.diff(starts), np.zeros(len(texts), dtype=np.int64)
                changed: dict[int, bytes] = {}
                for row, (begins, ends) in enumerate(zip(piece.column("begins").to_pylist(), piece.column("ends").to_pylist())):
                    if begins:
                        places = [m.span() for m in WORD.finditer(texts[row])]
                        out, at = [], 0
                        for a, b in zip(begins, ends):
                            out.append(texts[row][at : places[a][0]])
                            at = places[b][0] if b < len(places) else len(texts[row])
                            n_removed[row] += b - a
                        changed[row] = b"".join([*out, texts[row][at:]])
                kept = piece.column("text")
                if changed:
                    whole = kept.to_pylist()
                    for row, text in changed.items():
                        whole[row] = text.decode()
                    kept = pa.array(whole, pa.string())
                yield from to_batches({c: piece.column(c) for c in columns} | {"text": kept, "n_words": n_words, "n_removed": n_removed, "begins": piece.column("begins"), "ends": piece.column("ends")}, schema)

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs``: id (long), tag (long), text. The word intervals to remove:
    (id, tag, begins, ends), one row per document that loses words."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Four buckets a shuffle partition: a bucket is a fraction of what a task is meant to hold.
    prefix, blocks = max(8, (4 * partitions - 1).bit_length()), max(1, partitions)
    schema = to_arrow_schema(PARCELS)
    sent = docs.select("id", "tag", "text").mapInArrow(_scan(window, prefix, blocks, schema), PARCELS)
    met = sent.groupBy("goes_to").applyInArrow(_meet(prefix, blocks, schema), PARCELS)
    return met.groupBy("block").applyInArrow(_spans(window), SPANS)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` but for ``text_col``, which is without the words
    of repeated windows, and n_words, n_removed (words) and begins, ends (the
    removed word intervals; null: none). Columns with those names are replaced."""
    made = ["n_words", "n_removed", "begins", "ends"]
    others = [c for c in docs.columns if c.lower() not in (*made, id_col.lower(), text_col.lower())]
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*others).alias("others") if others else F.lit(None).cast("struct<x:int>").alias("others"))
    own = own.withColumn("id", F.col("id").cast("long"))
    twice = own.groupBy("id").count().where("count > 1").select("id")
    if twice.isEmpty():
        tagged = own.withColumn("tag", F.lit(0).cast("long"))
    else:
        marked = twice.withColumn("twice", F.lit(True)).withColumnRenamed("id", "twice_id")
        tagged = own.join(marked, F.col("id").eqNullSafe(F.col("twice_id")), "left").withColumn("tag", F.when(F.col("twice"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))).drop("twice", "twice_id")
    spans = pin_table(repeated_spans(tagged, window), "spans").withColumnsRenamed({"id": "span_id", "tag": "span_tag"})
    size = spans.agg(F.coalesce(F.sum(16 * (6 + F.size("begins"))), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        spans = F.broadcast(spans)
    joined = tagged.join(spans, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("tag") == F.col("span_tag")), "left").select("id", "others", "text", "begins", "ends")
    schema = T.StructType([
        *(joined.schema[c] for c in ("id", "others", "text")), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        joined.schema["begins"], joined.schema["ends"],
    ])
    cut = joined.mapInArrow(_apply(["id", "others"], to_arrow_schema(schema)), schema)
    named = {id_col: F.col("id").cast(docs.schema[id_col].dataType), text_col: F.col("text")} | {c: F.col("others").getField(c) for c in others}
    order = [c for c in docs.columns if c in named]
    return cut.select(*(named[c].alias(c) for c in order), *made)
