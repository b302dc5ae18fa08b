"""Rows dealt to buckets by a string column (the key), a bucket's rows of a
chunk packed into one compressed value, so that a shuffle of many short rows
takes a few bytes a row.

Rows keep their order. A bucket's distinct keys are held once, in the order in
which they come up, so a row's key is a small number; other strings are numbers
too, and whole numbers are held as the steps between them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from amphora.functions.cleavage import string_offsets


def _squeezed(raw: bytes) -> tuple[int, bytes]:
    return len(raw), pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _loose(held: tuple[int, bytes]) -> bytes:
    return pa.Codec("zstd").decompress(held[1], decompressed_size=held[0], asbytes=True) if held[0] else b""


def pack_numbers(values: np.ndarray) -> tuple[str, tuple[int, bytes]]:
    """Whole numbers in as few bytes as the largest needs, the low bytes of all first."""
    least, most = int(values.min(initial=0)), int(values.max(initial=0))
    kind = next(k for k in ("i1", "i2", "i4", "i8") if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
    values = np.ascontiguousarray(values, dtype=f"<{kind}")
    return kind, _squeezed(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpack_numbers(held: tuple[str, tuple[int, bytes]]) -> np.ndarray:
    kind, raw = f"<{held[0]}", np.frombuffer(_loose(held[1]), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel().astype(np.int64)


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _pack_strings(strings: pa.Array) -> tuple:
    ends, held = string_offsets(strings), strings.buffers()[2]
    raw = memoryview(held)[ends[0]:ends[-1]].tobytes() if held else b""
    return strings.type, pack_numbers(np.diff(ends)), _squeezed(raw)


def _unpack_strings(held: tuple) -> pa.Array:
    kind, lengths, raw = held
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    ends = np.append(0, np.cumsum(unpack_numbers(lengths))).astype(np.int64 if wide else np.int32)
    return pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(_loose(raw))])


def _is_text(kind: pa.DataType) -> bool:
    return any(is_(kind) for is_ in (pa.types.is_string, pa.types.is_large_string, pa.types.is_binary, pa.types.is_large_binary))


def _named(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each row's string (-1 for null) and the strings."""
    held = column.dictionary_encode()
    return held.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), held.dictionary


def _column_packer(column: pa.Array, order: np.ndarray):
    """A function that packs the rows from one place to another of ``column`` in this order."""
    if pa.types.is_integer(column.type) and not column.null_count:
        values = column.to_numpy(zero_copy_only=False).astype(np.int64)[order]
        return lambda a, b: ("number", column.type, pack_numbers(_steps(values[a:b])))
    if _is_text(column.type):
        codes, strings = _named(column)
        codes = codes[order]

        def named(a, b):
            some = codes[a:b]
            if len(strings) <= 4 * len(some):
                seen = np.zeros(len(strings) + 1, dtype=bool)  # the last is the nulls'
                seen[some] = True
                own, place = np.flatnonzero(seen[:-1]), np.cumsum(seen[:-1]) - 1
                local = np.where(some < 0, -1, place[some]) if len(own) else some
            else:
                own, local = np.unique(some, return_inverse=True)
                if len(own) and own[0] < 0:
                    own, local = own[1:], local - 1
            return "named", pack_numbers(_steps(local)), _pack_strings(strings.take(pa.array(own)))

        return named

    def plain(a, b):
        batch, sink = pa.RecordBatch.from_arrays([column.take(pa.array(order[a:b]))], names=["c"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return "plain", _squeezed(sink.getvalue().to_pybytes())

    return plain


def _unpack_column(held: tuple) -> pa.Array:
    if held[0] == "number":
        return pa.array(np.cumsum(unpack_numbers(held[2])), type=pa.int64()).cast(held[1])
    if held[0] == "named":
        codes = np.cumsum(unpack_numbers(held[1]))
        return _unpack_strings(held[2]).take(pa.array(codes, mask=codes < 0))
    table = pa.ipc.open_stream(_loose(held[1])).read_all()
    return table.column(0).combine_chunks() if table.column(0).num_chunks != 1 else table.column(0).chunk(0)


def pack_rows(rows: pa.RecordBatch, key: str, bucket: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Each bucket of ``rows`` and its rows, packed. Equal keys have the same
    ``bucket``; a row without a key can be in any."""
    order = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket, kind="stable")
    dealt = bucket[order]
    at = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1])) if len(dealt) else np.zeros(0, dtype=np.int64)
    codes, keys = _named(rows.column(key))
    of_key = np.zeros(len(keys) + 1, dtype=np.int64)  # the last is the nulls'
    of_key[codes] = bucket
    of_key = of_key[:-1]
    by = np.argsort(of_key, kind="stable")
    keys, of_key = keys.take(pa.array(by)), of_key[by]
    place = np.empty(len(by) + 1, dtype=np.int64)
    place[by] = np.arange(len(by)) - np.searchsorted(of_key, of_key)
    place[-1] = -1
    local = place[codes][order]
    others = [_column_packer(rows.column(i), order) for i, name in enumerate(rows.schema.names) if name != key]
    for a, b in zip(at, np.append(at[1:], len(dealt))):
        first, last = np.searchsorted(of_key, [dealt[a], dealt[a] + 1])
        # A key that is new is 0, any other is told by how many have come up since its own first row.
        some = local[a:b]
        seen = np.maximum.accumulate(np.append(-1, some))[:-1] + 1
        told = np.where(some == seen, 0, seen - some)
        yield int(dealt[a]), pickle.dumps((_pack_strings(keys.slice(first, last - first)), pack_numbers(told), [pack(a, b) for pack in others]))


def unpack_keys(held: bytes) -> pa.Array:
    """The distinct keys of packed rows."""
    return _unpack_strings(pickle.loads(held)[0])


def unpack_rows(held: bytes) -> tuple[np.ndarray, list[pa.Array]]:
    """The number of each row's key (-1 for null) among ``unpack_keys``, and the other columns."""
    _, told, others = pickle.loads(held)
    told = unpack_numbers(told)
    new = told == 0
    before = np.cumsum(new) - new
    return np.where(new, before, before - told), [_unpack_column(x) for x in others]
