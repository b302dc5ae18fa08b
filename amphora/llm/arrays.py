"""Helpers for Arrow batches inside tasks: bounded slices, ragged arrays, output."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once inside a task; a longer document is a slice of its own.
SLICE_BYTES = 6 << 20


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker, so that tokenizers
    are loaded once a process and not once a task."""
    import pyspark

    return pyspark.__dict__.setdefault("_amphora_llm_cache", {})


def release() -> None:
    """Give memory back at the end of a task or group: Python workers are used
    again, and what one holds on to is missing elsewhere on its executor."""
    for held in process_cache().values():
        if hasattr(held, "forget"):
            held.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A ``mapInArrow`` function that gives memory back when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def tidy_group(run: Callable[[tuple, pa.Table], pa.Table]):
    """An ``applyInArrow`` function that gives memory back after each group."""

    def wrapped(key: tuple, table: pa.Table) -> pa.Table:
        try:
            return run(key, table)
        finally:
            release()

    return wrapped


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` whose ``column`` holds about ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def filled(column: pa.Array) -> pa.Array:
    """The column as plain strings, null as the empty text."""
    return pc.fill_null(column.cast(pa.string()), "")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ragged_take(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ragged array one after the other, and the offsets of the result."""
    lengths = (offsets[1:] - offsets[:-1])[rows]
    out = offsets_of(lengths)
    kind = np.int32 if max(out[-1], offsets[-1]) < 1 << 31 else np.int64
    at = np.repeat((offsets[:-1][rows] - out[:-1]).astype(kind), lengths)
    at += np.arange(out[-1], dtype=kind)
    return flat[at], out


def to_batches(columns: dict[str, object], schema: pa.Schema, most: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of ``columns`` in the order and types of ``schema``, cut
    so that none is much over ``most`` bytes."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for f in schema for c in [columns[f.name]]]
    batch = pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)
    if not batch.num_rows:
        return
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of anything but ASCII white space) of the texts: the
    distinct ones, the number of each word of all texts, where each text's begin."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    coded = flat.dictionary_encode()
    words, codes = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy().astype(np.int64)
    empty = np.flatnonzero(words == "")
    if len(empty):  # an empty text is split into one empty word
        real = codes != empty[0]
        starts = np.append(0, np.cumsum(real))[starts]
        codes = codes[real]
    return words, codes, starts


def squeeze(values: np.ndarray) -> bytes:
    """The array as compressed bytes; ``unsqueeze`` reads it back."""
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(memoryview(data)[8:], decompressed_size=int.from_bytes(data[:8], "little"))
    return np.frombuffer(raw, dtype=kind)


def by_group(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order that brings equal groups together, the groups, and where each begins."""
    order = np.argsort(groups, kind="stable")
    sorted_ = groups[order]
    firsts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, dtype=np.int64)
    return order, sorted_[firsts], np.append(firsts, len(sorted_))


def doc_keys(column: pa.Array) -> np.ndarray:
    """Integer ids in an order where null is the smallest."""
    return pc.fill_null(column.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


#: Stands for a null id inside tasks.
NULL_ID = -(1 << 63)
