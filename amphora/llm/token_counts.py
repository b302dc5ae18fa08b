"""Token counts of whole texts from the counts of distinct pre-tokens.

Each task turns a slice of documents into its distinct pre-tokens and, for
each document, how often it has them. Both are packed and sent to the bucket
of the pre-token's hash. There every distinct pre-token of the corpus is
encoded once, and its number of tokens is multiplied with the frequencies of
each document; the sums per document of a slice go back to the slice's header
and are added up. No ids are kept, and of the texts only each slice's distinct
pre-tokens are shuffled. Text that is not plain Latin is split by the library's
own normalizer and pre-tokenizer; a chunk between two spaces that holds the
string of a special token is one pre-token as a whole.

Nulls and edges: a null or empty text has 0 bytes and 0 tokens; a very long text
is a slice of its own; each row is counted by itself, so rows with equal ids or
texts keep a row each; a null id is carried; an empty table gives no rows; other
columns are not read; an ``id_col`` named n_bytes or n_tokens raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amphora.llm.arrays import by_group, offsets_of, ragged_take, squeeze, text_slices, tidy, tidy_group, to_batches, unsqueeze
from amphora.llm.encoders import ChunkEncoder, EncoderSpec

#: Text bytes of a slice; a larger one repeats fewer pre-tokens.
SLICE = 12 << 20

PARCELS = T.StructType([
    T.StructField("bucket", T.LongType()),
    T.StructField("part", T.LongType()),  # task and slice
    T.StructField("pieces", T.BinaryType()),  # null: a header of the slice
    T.StructField("parts", T.ArrayType(T.BinaryType())),
])


def piece_table(encoder: ChunkEncoder, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of the chunks, and those of each chunk as a ragged
    array. A chunk that holds the string of a special token counts as one."""
    number: dict[str, int] = {}
    flat, lengths = [], np.zeros(len(chunks), dtype=np.int64)
    for i, chunk in enumerate(chunks):
        found = encoder.every_pre_token(chunk)
        if found is None:
            found = [chunk]
        lengths[i] = len(found)
        for piece in found:
            flat.append(number.setdefault(piece, len(number)))
    return list(number), np.array(flat, dtype=np.int64), offsets_of(lengths)


def frequencies(encoder: ChunkEncoder, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pre-tokens; then document, pre-token and how often, by document."""
    chunks, codes, starts = encoder.chunks(column)
    pieces, flat, at = piece_table(encoder, chunks)
    if not len(codes) or not len(pieces):
        none = np.zeros(0, dtype=np.int64)
        return [], none, none, none
    used, ends = ragged_take(flat, at, codes)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(ends[starts]))
    both = np.sort(doc * len(pieces) + used)
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else both
    return pieces, both[first] // len(pieces), both[first] % len(pieces), np.diff(np.append(first, len(both)))


def _scan(spec: EncoderSpec, buckets: int, schema: pa.Schema, id_schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = spec.load(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in text_slices(batch, "text", SLICE):
                pieces, doc, used, often = frequencies(encoder, piece.column("text"))
                ids = pa.RecordBatch.from_arrays([piece.column("id")], schema=id_schema)
                sizes = pc.fill_null(pc.binary_length(piece.column("text")), 0).to_numpy(zero_copy_only=False).astype("<i8")
                rows = [(part % buckets, part, None, [ids.serialize().to_pybytes(), squeeze(sizes)])]
                digest = xxhash.xxh32_intdigest
                to = np.array([digest(p) % buckets for p in pieces], dtype=np.int64)
                order, groups, at = by_group(to)
                local = np.empty(len(order), dtype=np.int64)  # number of a pre-token among those of its bucket
                local[order] = np.arange(len(order)) - np.repeat(at[:-1], np.diff(at))
                by, places, cuts = by_group(to[used])
                spans = dict(zip(places.tolist(), zip(cuts, cuts[1:])))
                for bucket, a, b in zip(groups.tolist(), at, at[1:]):
                    if bucket not in spans:  # only forms that no text has
                        continue
                    own = by[slice(*spans[bucket])]
                    texts = pa.array([pieces[i] for i in order[a:b]], pa.string())
                    rows.append((bucket, part, _pack_strings(texts), [
                        squeeze(np.diff(doc[own], prepend=0).astype("<u4")), squeeze(local[used[own]].astype("<u4")), squeeze(often[own].astype("<u4")),
                    ]))
                to_, part_, pieces_, parts_ = zip(*rows)
                yield from to_batches({"bucket": list(to_), "part": list(part_), "pieces": list(pieces_), "parts": list(parts_)}, schema)
                part += 1

    return run


def _pack_strings(texts: pa.Array) -> bytes:
    lengths = pc.binary_length(texts).to_numpy().astype("<u4")
    raw = b"".join(texts.cast(pa.binary()).to_pylist())
    return len(lengths).to_bytes(8, "little") + squeeze(np.frombuffer(lengths.tobytes() + raw, dtype=np.uint8))


def _unpack_strings(data: bytes) -> pa.Array:
    n, raw = int.from_bytes(data[:8], "little"), unsqueeze(data[8:], np.uint8)
    at = offsets_of(raw[: 4 * n].view("<u4").astype(np.int64))
    return pa.StringArray.from_buffers(n, pa.py_buffer(at.astype("<i4").tobytes()), pa.py_buffer(raw[4 * n :].tobytes()))


def _count(spec: EncoderSpec, schema: pa.Schema):
    """Encode each distinct pre-token of a bucket once; sums per document of every slice."""

    @tidy_group
    def run(key: tuple, table: pa.Table) -> pa.Table:
        held = table.to_pylist()
        out, rows = [r for r in held if r["pieces"] is None], [r for r in held if r["pieces"] is not None]
        if rows:
            encoder = spec.load()
            found = pa.chunked_array([_unpack_strings(r["pieces"]) for r in rows]).combine_chunks().dictionary_encode()
            tokens = np.array([encoder.tokens_of(p) for p in found.dictionary.to_pylist()], dtype=np.int64)
            counts, at = tokens[found.indices.to_numpy()], 0
            for r in rows:
                doc, local, often = (unsqueeze(x, "<u4").astype(np.int64) for x in r["parts"])
                doc = np.cumsum(doc)
                sums = np.bincount(doc, weights=counts[at + local] * often).astype("<i8")
                at += int.from_bytes(r["pieces"][:8], "little")
                out.append({"bucket": -1, "part": r["part"], "pieces": b"", "parts": [squeeze(sums)]})
        return pa.Table.from_pylist(out, schema=schema)

    return run


def _add_up(id_schema: pa.Schema, schema: pa.Schema):
    @tidy_group
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        ids, sizes = next(r["parts"] for r in rows if r["pieces"] is None)
        n_bytes = unsqueeze(sizes, "<i8")
        n_tokens = np.zeros(len(n_bytes), dtype=np.int64)
        for r in rows:
            if r["pieces"] is not None:
                sums = unsqueeze(r["parts"][0], "<i8")
                n_tokens[: len(sums)] += sums
        own = pa.ipc.read_record_batch(pa.py_buffer(ids), id_schema).column(0)
        return pa.table([own, pa.array(n_bytes), pa.array(n_tokens)], schema=schema)

    return run


def count_tokens(docs: DataFrame, spec: EncoderSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_bytes, n_tokens), one row for each of ``docs``."""
    if id_col.lower() in ("n_bytes", "n_tokens"):
        raise ValueError(f"{id_col} is a column of the result")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, own.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    id_schema = to_arrow_schema(T.StructType([own.schema["id"]]))
    arrow = to_arrow_schema(PARCELS)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = own.mapInArrow(_scan(spec, buckets, arrow, id_schema), PARCELS)
    sums = sent.groupBy("bucket").applyInArrow(_count(spec, arrow), PARCELS)
    return sums.groupBy("part").applyInArrow(_add_up(id_schema, to_arrow_schema(schema)), schema)
