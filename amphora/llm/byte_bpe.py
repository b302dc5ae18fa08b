"""Byte-level BPE over Arrow batches: encoding with offsets, and decoding.

Texts are encoded by the tokenizers library with a vocabulary of byte ranks;
the library writes bytes as printable characters, and decoding turns ids back
into bytes by the same table reversed. A token may hold part of a character:
the bytes of a whole document are joined before they are read as UTF-8, and
bytes that are no character become U+FFFD only in ``text`` (cut ids).

Nulls and edges: a null text is an empty one, or gives null ids that decode to
null (``null_as_empty`` off); rows are handled one by one, so repeated rows and
other columns stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amphora.llm.arrays import as_bytes, filled, offsets_of, process_cache, ragged_take, text_slices, tidy, to_batches
from amphora.llm.encoders import EncoderSpec, read_ranks


#: Ids that are decoded at once inside a task.
SLICE_IDS = 1 << 20


def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every token by id, as a ragged array; ids without a token are empty."""
    cache = process_cache()
    if ("bytes", path) not in cache:
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        lengths = np.fromiter(map(len, table), dtype=np.int64, count=len(table))
        cache["bytes", path] = np.frombuffer(b"".join(table), dtype=np.uint8), offsets_of(lengths)
    return cache["bytes", path]


def character_offsets(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-last character of each byte span of a UTF-8 text; a
    character that the span only has a part of counts. Third: whether the span
    ends inside a character."""
    leads = np.append((text & 0xC0) != 0x80, True)
    before = np.cumsum(leads, dtype=np.int32)  # characters begun at or before a byte
    return before[starts] - 1, np.where(leads[ends], before[ends] - 1, before[ends]), ~leads[ends]


def encode(docs: DataFrame, spec: EncoderSpec, text_col: str = "text", with_offsets: bool = False, null_as_empty: bool = True, offsets_digest: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_split`` (tokens that end
    inside a character); ``with_offsets`` adds ``starts`` and ``ends``, the
    tokens' characters (an end is past the last), ``offsets_digest`` adds
    ``offsets_crc32``, the unsigned CRC-32 of all starts and then all ends as
    little-endian unsigned 32-bit numbers. Columns of ``docs`` with such names
    are replaced."""
    own = [c for c in docs.columns if c.lower() not in ("ids", "n_split", "starts", "ends", "offsets_crc32")]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_split", T.LongType())]
    if offsets_digest:
        added.append(T.StructField("offsets_crc32", T.LongType()))
    if with_offsets:
        added += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("starts", "ends")]
    schema = T.StructType([docs.schema[c] for c in own] + added)
    arrow = to_arrow_schema(schema)

    def work(piece: pa.RecordBatch) -> dict:
        texts = piece.column(text_col)
        ids, ends = spec.load().encode(texts)
        flat, at = token_bytes(spec.path)
        stops = np.cumsum(np.diff(at)[ids])  # bytes of the slice up to each token
        raw = np.frombuffer(b"".join(as_bytes(texts)), dtype=np.uint8)
        firsts = np.append(0, stops)[:-1]
        # Documents begin at characters, so spans of the slice are spans of its documents.
        start, stop, split = character_offsets(raw, firsts, stops) if len(raw) else (firsts, stops, np.zeros(0, bool))
        marks = np.append(0, np.cumsum(split))
        mask = None if null_as_empty else pc.is_null(texts)
        lists = lambda values: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)), mask=mask)
        out = {"ids": lists(ids), "n_split": marks[ends[1:]] - marks[ends[:-1]]}
        if with_offsets or offsets_digest:
            chars = pc.utf8_length(filled(texts)).to_numpy()
            begin = np.repeat(offsets_of(chars)[:-1], np.diff(ends))
            start, stop = start - begin, stop - begin
        if with_offsets:
            out |= {"starts": lists(start), "ends": lists(stop)}
        if offsets_digest:
            packed, bounds = [memoryview(x.astype("<u4")).cast("B") for x in (start, stop)], (4 * ends).tolist()
            digests = [zlib.crc32(packed[1][a:b], zlib.crc32(packed[0][a:b])) for a, b in zip(bounds, bounds[1:])]
            out["offsets_crc32"] = pa.array(np.array(digests, dtype=np.int64), mask=mask and mask.to_numpy(zero_copy_only=False))
        return out | {c: piece.column(c) for c in own}

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, text_col):
                yield from to_batches(work(piece), arrow)

    return docs.select(*own).mapInArrow(run, schema)


def _id_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of about ``SLICE_IDS`` ids."""
    ends, start = batch.column(column).offsets.to_numpy()[1:].astype(np.int64), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else batch.column(column).offsets[0].as_py()
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_IDS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def decode(df: DataFrame, path: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but ``decoded``) and ``decoded``: the bytes of the
    ids, null where the ids are null. An id without a token is an error."""
    own = [c for c in (keep if keep is not None else df.columns) if c.lower() != "decoded"]
    schema = T.StructType([df.schema[c] for c in own] + [T.StructField("decoded", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, at = token_bytes(path)
        for whole in batches:
            for batch in _id_slices(whole, ids_col):
                lists = batch.column(ids_col)
                places = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.slice(places[0], places[-1] - places[0]).to_numpy(zero_copy_only=False).astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(at) - 1):
                    raise ValueError("an id that the vocabulary does not have")
                raw, ends = ragged_take(flat, at, ids)
                bounds, text = ends[places - places[0]].tolist(), raw.tobytes()
                decoded = pa.array([text[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary(), mask=lists.is_null().to_numpy(zero_copy_only=False))
                yield from to_batches({c: batch.column(c) for c in own} | {"decoded": decoded}, arrow)

    return df.select(*dict.fromkeys([*own, ids_col])).mapInArrow(run, schema)


def decoded_text(column: str) -> Column:
    """The decoded bytes as text; bytes of split characters become U+FFFD."""
    return F.make_valid_utf8(F.col(column).cast("string"))
