"""Packing documents into fixed token windows, in bounded space.

Every task keeps at most ``open_windows`` windows open. A document's ids are
cut into full windows and a rest; the rest goes to the open window that it
fills best; if none has room, the fullest window is emitted and a new one is
opened. What is still open at the end of each task is packed once more, over
the leftovers of ``fan_in`` tasks together, longest piece first.

Nulls and edges: a null text is an empty one (its end id alone is packed); a
null id column is carried; equal rows are packed each on its own; a document
longer than a window is cut into several pieces; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amphora.llm.arrays import text_slices, tidy, tidy_group, to_batches
from amphora.llm.encoders import EncoderSpec
from amphora.session import pin_table

WINDOW, OPEN_WINDOWS, FAN_IN, END_ID = 2048, 128, 16, 1

#: Sequences of the merge are numbered from here on.
MERGED = 1 << 62


class OpenWindows:
    """At most ``limit`` open windows; ``put`` says which window a piece got and
    where, and hands back the window that had to be emitted."""

    def __init__(self, window: int, limit: int):
        self.window, self.limit = window, limit
        self.free: list[tuple[int, int]] = []  # (room left, window), ascending
        self.opened = 0

    def put(self, length: int) -> tuple[int, int, int | None]:
        at, emitted = bisect_left(self.free, (length, -1)), None
        if at == len(self.free):
            if len(self.free) >= self.limit:
                emitted = self.free.pop(0)[1]
            room, number = self.window, self.opened
            self.opened += 1
        else:
            room, number = self.free.pop(at)
        insort(self.free, (room - length, number))
        return number, self.window - room, emitted


def _schema(id_type: T.DataType, id_col: str) -> T.StructType:
    return T.StructType([
        T.StructField(id_col, id_type),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("open", T.BooleanType()),
        T.StructField("merge_group", T.IntegerType()),
    ])


def _place(spec: EncoderSpec, id_col: str, window: int, limit: int, fan_in: int, end_id: int, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = spec.load(), TaskContext.get().partitionId()
        windows, held = OpenWindows(window, limit), {}
        numbered = part << 32

        def rows(pieces: list[tuple], is_open: bool) -> Iterator[pa.RecordBatch]:
            if pieces:
                doc, start, length, total, ids, seq, offset = zip(*pieces)
                yield from to_batches({
                    id_col: list(doc), "start": list(start), "length": list(length), "doc_tokens": list(total), "ids": list(ids),
                    "sequence_id": [numbered + s for s in seq], "offset": list(offset),
                    "open": [is_open] * len(doc), "merge_group": [part // fan_in] * len(doc),
                }, schema)

        for batch in batches:
            for piece in text_slices(batch, "text"):
                ids, ends = encoder.encode(piece.column("text"))
                done: list[tuple] = []
                for row, doc in enumerate(piece.column(id_col).to_pylist()):
                    own = np.append(ids[ends[row] : ends[row + 1]], np.uint32(end_id)).astype("<u4")
                    full = len(own) - len(own) % window
                    for start in range(0, full, window):
                        done.append((doc, start, window, len(own), own[start : start + window].tobytes(), windows.opened, 0))
                        windows.opened += 1
                    if rest := len(own) - full:
                        number, offset, emitted = windows.put(rest)
                        held.setdefault(number, []).append((doc, full, rest, len(own), own[full:].tobytes(), number, offset))
                        if emitted is not None:
                            done += held.pop(emitted)
                yield from rows(done, False)
        left = {number: room for room, number in windows.free}
        yield from rows([p for n in held if left[n] == 0 for p in held[n]], False)
        yield from rows([p for n in held if left[n] for p in held[n]], True)

    return run


def _merge(window: int, limit: int):
    """Best fit over the leftover pieces of one merge group, longest first."""

    @tidy_group
    def run(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        order = np.lexsort((table.column("offset").to_numpy(), table.column("sequence_id").to_numpy(), -lengths))
        windows = OpenWindows(window, max(limit, len(lengths)))
        placed = [windows.put(int(lengths[i])) for i in order]
        first = MERGED + (key[0].as_py() << 32)
        out = table.take(pa.array(order))
        for name, values in (("sequence_id", [first + p[0] for p in placed]), ("offset", [p[1] for p in placed])):
            out = out.set_column(out.schema.get_field_index(name), out.schema.field(name), pa.array(values, pa.int64()))
        return out

    return run


def pack(
    docs: DataFrame,
    spec: EncoderSpec,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    fan_in: int = FAN_IN,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``id_col``, start (the document's ids before it),
    length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id and
    offset (in the sequence, gapless from 0).

    A merge group holds the leftovers of ``fan_in`` tasks, so at most
    ``fan_in * open_windows`` windows, whatever the size of the table.
    """
    own = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))
    schema = _schema(own.schema[id_col].dataType, id_col)
    placed = pin_table(own.mapInArrow(_place(spec, id_col, window, open_windows, fan_in, end_id, to_arrow_schema(schema)), schema), "packing")
    merged = placed.where("open").groupBy("merge_group").applyInArrow(_merge(window, open_windows), schema)
    return placed.where("not open").unionByName(merged).drop("open", "merge_group")
