"""WARC archives written and read as a table of payload chunks.

Writing. Every row becomes one record, laid out by Spark's expressions and
written by Spark's own text writer (gzip files in any store Spark reaches, and
its commit protocol for lost tasks). A payload goes out as HTTP chunks
(``Transfer-Encoding: chunked``), each a row of its own: the number of bytes
of a record is known from the length of its payload, so no record is ever put
together as a whole. Of rows with equal payloads the one with the largest id
is a ``response``, the others are ``revisit`` records that refer to it and
carry the digest and length of their payload, not the payload.

Reading. Archives (ours or others', ``.warc.gz`` too) come through Spark's
text reader as lines; a task puts the lines of an archive together to a stream
again and parses it record by record. What leaves is the chunk table: one row
for each ``chunk_bytes`` of payload with the record's id, the chunk's number,
and the SHA-1 and length of the payload up to the end of that chunk, which the
task carries on from chunk to chunk. The row marked ``last`` holds digest and
length of the whole payload, so no payload has to be gathered to know them,
and memory is bounded by the chunk, not by the record. Equality of
payloads is decided by SHA-256 and length.

Nulls and edges: a null payload is empty, and an empty payload is a record of
one empty chunk; a null id is smaller than any other and a group of null ids
only are all responses; rows that share the largest id of their group are all
responses, as they cannot refer to themselves; a null address is left out; line
ends in an address are written as percent codes; a very long payload is many
chunks; an empty table gives no records; further columns are not written, so
their names cannot clash. Ids are integers. An archive that is not compressed
and that Spark would cut into splits raises (raise
``spark.sql.files.maxPartitionBytes`` or compress it), as does one that ends
inside a record.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amphora.llm.arrays import tidy
from amphora.session import pin_table

#: Payload bytes of a chunk.
CHUNK_BYTES = 1 << 16

#: Bytes of a record's header fields, or of one line of a chunked body, at most.
HEADER_BYTES = 1 << 20

RECORD_URI = "urn:record:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = (
    "record_id string, record_type string, target_uri string, refers_to string, declared_digest string, "
    "chunk_no long, last boolean, payload_bytes long, payload_digest string, data binary"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hex digits are four base32 digits."""
    hex_ = F.sha1(payload)
    digits = F.concat(*[F.lpad(F.conv(F.substring(hex_, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _hex_size(n: Column) -> Column:
    return F.lower(F.hex(n))


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url",
    min_revisit_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one record for each row of ``pages`` under ``path``. Payloads of
    fewer than ``min_revisit_bytes`` bytes are all responses."""
    uri = F.col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    own = pages.select(F.col(id_col).cast("long").alias("id"), uri.alias("uri"), payload.alias("payload"))
    own = own.withColumns({"size": F.octet_length("payload").cast("long"), "same": F.unhex(F.sha2("payload", 256))})

    # Only payloads that come more than once are joined, without their bytes;
    # Spark broadcasts that pinned table if it is small. (Counting and joining
    # read the input twice; a table of all payloads would be shuffled.)
    groups = own.where(F.col("size") >= min_revisit_bytes).groupBy("same", "size").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("first_id"))
    repeated = pin_table(groups.where("n > 1 AND first_id IS NOT NULL").select("same", "size", "first_id"), "warc-repeated")
    rows = own.join(repeated, ["same", "size"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    rows = rows.select("id", "uri", "payload", "size", revisit.alias("revisit"), "first_id", base32_sha1(F.col("payload")).alias("digest"))

    name = lambda c: F.concat(F.lit(f"<{RECORD_URI}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda field, value: F.concat(F.lit(f"{field}: "), value, F.lit("\r\n"))
    safe_uri = F.replace(F.replace(F.col("uri"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(F.col("revisit"), line("Content-Length", F.col("size").cast("string"))).otherwise(F.lit("Transfer-Encoding: chunked\r\n")),
        F.lit("\r\n"))
    full, rest = F.floor(F.col("size") / chunk_bytes).cast("long"), F.col("size") % chunk_bytes
    body = full * (len(f"{chunk_bytes:x}") + 4 + chunk_bytes) + F.when(rest > 0, F.length(_hex_size(rest)) + 4 + rest).otherwise(0) + 5
    length = F.octet_length("http") + F.when(F.col("revisit"), F.lit(0)).otherwise(body)
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", safe_uri), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("first_id"))))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http;msgtype=response\r\n"), line("Content-Length", length.cast("string")), F.lit("\r\n"))
    laid = rows.withColumn("http", http).withColumn("head", F.concat(header, F.col("http"))).drop("http", "uri", "digest", "first_id")

    # A text row for each chunk; the writer ends every row with CR LF. The
    # first one begins with the header, the last one ends body and record.
    n_chunks = F.when(F.col("revisit"), F.lit(1)).otherwise(F.greatest(F.ceil(F.col("size") / chunk_bytes), F.lit(1)))
    chunked = laid.select("*", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks.cast("long") - 1)).alias("chunk"), n_chunks.alias("n_chunks"))
    # ``substring`` takes 32-bit places, and a value of a row is shorter than that.
    data = F.substring("payload", (F.col("chunk") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes))
    framed = F.concat(_hex_size(F.octet_length(data).cast("long")).cast("binary"), F.lit(b"\r\n"), data, F.lit(b"\r\n"))
    content = F.when(F.col("revisit") | (F.col("size") == 0), F.lit(b"")).otherwise(framed)
    # The frame's CR LF is the writer's, but for the last row, which has more to say.
    not_last = F.col("chunk") < F.col("n_chunks") - 1
    content = F.when(not_last, F.substring(content, F.lit(1), F.octet_length(content) - 2)).otherwise(content)
    end = F.when(not_last, F.lit(b"")).when(F.col("revisit"), F.lit(b"\r\n")).otherwise(F.lit(b"0\r\n\r\n\r\n"))
    text = F.concat(F.when(F.col("chunk") == 0, F.col("head").cast("binary")).otherwise(F.lit(b"")), content, end)
    out = chunked.select(text.cast("string").alias("value"))
    out.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class _Stream:
    """The bytes of an archive: what was put in and not yet taken out."""

    def __init__(self):
        self.data, self.at = bytearray(), 0

    def __len__(self) -> int:
        return len(self.data) - self.at

    def put(self, more: bytes) -> None:
        if self.at:
            del self.data[: self.at]
            self.at = 0
        self.data += more

    def take(self, n: int) -> bytes:
        out = bytes(memoryview(self.data)[self.at : self.at + n])
        self.at += len(out)
        return out

    def until(self, mark: bytes) -> bytes | None:
        """What comes up to ``mark``, which is dropped; None: not there yet."""
        end = self.data.find(mark, self.at)
        if end < 0:
            if len(self) > HEADER_BYTES:
                raise ValueError("no end of a header within its largest size")
            return None
        out = bytes(memoryview(self.data)[self.at : end])
        self.at = end + len(mark)
        return out


def _fields(lines: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return out


class ArchiveParser:
    """Chunk rows of one archive, fed with its bytes piece by piece."""

    def __init__(self, chunk_bytes: int, with_data: bool):
        self.chunk_bytes, self.with_data = chunk_bytes, with_data
        self.stream, self.rows = _Stream(), []
        self.steps = self._archive()
        next(self.steps)

    def feed(self, data: bytes) -> list[tuple]:
        self.stream.put(data)
        self.steps.send(False)
        rows, self.rows = self.rows, []
        return rows

    def end(self) -> list[tuple]:
        try:
            self.steps.send(True)
        except StopIteration:
            pass
        rows, self.rows = self.rows, []
        return rows

    # The parser is a generator that yields where it needs more bytes and is
    # told whether the archive has ended.
    def _need(self, mark: bytes):
        while (found := self.stream.until(mark)) is None:
            if (yield):
                raise ValueError("the archive ends inside a record")
        return found

    def _pass(self, n: int, use):
        """Hand the next ``n`` bytes on in pieces."""
        while n:
            piece = self.stream.take(min(n, self.chunk_bytes))
            if not piece:
                if (yield):
                    raise ValueError("the archive ends inside a record")
                continue
            n -= len(piece)
            use(piece)

    def _archive(self):
        ended = yield
        while True:
            # Line ends between records.
            while True:
                lead = self.stream.take(1)
                if not lead:
                    if ended:
                        return
                    ended = yield
                elif lead not in b"\r\n":
                    self.stream.at -= 1
                    break
            header = yield from self._need(b"\r\n\r\n")
            if not header.startswith(b"WARC/"):
                raise ValueError("a record does not begin with its version")
            yield from self._record(_fields(header))

    def _record(self, fields: dict[str, str]):
        left = int(fields["content-length"])
        kind = fields.get("warc-type", "")
        self.open(fields, kind)
        http: dict[str, str] = {}
        if left and fields.get("content-type", "").replace(" ", "").startswith("application/http"):
            begin = yield from self._need(b"\r\n\r\n")
            http = _fields(begin)
            left -= len(begin) + 4
        if http.get("transfer-encoding", "").lower() == "chunked" and left:
            while True:
                size_line = yield from self._need(b"\r\n")
                size = int(size_line.split(b";")[0], 16)
                left -= len(size_line) + 2
                if not size:
                    break
                yield from self._pass(size, self.add)
                yield from self._need(b"\r\n")
                left -= size + 2
            yield from self._pass(left, lambda piece: None)  # trailers
        else:
            yield from self._pass(left, self.add)
        self.close(int(http["content-length"]) if kind == "revisit" and "content-length" in http else None)

    def open(self, fields: dict[str, str], kind: str) -> None:
        clean = lambda name: fields[name].strip("<>") if name in fields else None
        declared = fields.get("warc-payload-digest")
        self.told = (clean("warc-record-id"), kind, fields.get("warc-target-uri"), clean("warc-refers-to"), declared and declared.rpartition(":")[2])
        self.digest, self.total, self.number, self.held, self.n_held = hashlib.sha1(), 0, 0, [], 0

    def add(self, piece: bytes) -> None:
        self.digest.update(piece)
        self.total += len(piece)
        if self.n_held + len(piece) > self.chunk_bytes:
            # The digest is already past this chunk: rows are cut where pieces end.
            self._row(False, self.total - len(piece), self.before)
        if self.with_data:
            self.held.append(piece)
        self.n_held += len(piece)
        self.before = self.digest.copy()

    def _row(self, last: bool, total: int, digest) -> None:
        data = b"".join(self.held) if self.with_data else None
        self.rows.append((*self.told, self.number, last, total, base64.b32encode(digest.digest()).decode(), data))
        self.number, self.held, self.n_held = self.number + 1, [], 0

    def close(self, told_bytes: int | None) -> None:
        self._row(True, self.total, self.digest)
        if self.told[1] == "revisit" and self.told[4] is not None:  # length and digest of what it refers to
            row = self.rows[-1]
            self.rows[-1] = (*row[:7], row[7] if told_bytes is None else told_bytes, self.told[4], row[9])


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives under ``path``: ``record_id``,
    ``record_type``, ``target_uri``, ``refers_to``, ``declared_digest`` (as the
    header says), ``chunk_no`` from 0, ``last``, ``payload_bytes`` and
    ``payload_digest`` through the end of this chunk, ``data`` (null unless
    ``with_data``). Of a revisit record there is one row, with the length and
    digest of the payload it refers to."""
    names = [c.strip().split(" ")[0] for c in CHUNKS.split(",")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(n, kinds[c.strip().split(" ")[1]]) for n, c in zip(names, CHUNKS.split(","))])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, archive = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if not all(batch.column("whole").to_pylist()):
                raise ValueError("an archive without compression was cut into splits")
            files = batch.column("file").to_numpy()
            cuts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                if files[start] != archive:
                    if parser is not None and (rows := parser.end()):
                        yield batch_of(rows)
                    parser, archive = ArchiveParser(chunk_bytes, with_data), files[start]
                lines = batch.column("line").slice(start, stop - start).to_pylist()
                lines.append(b"")
                if rows := parser.feed(b"\n".join(lines)):
                    yield batch_of(rows)
        if parser is not None and (rows := parser.end()):
            yield batch_of(rows)

    # ``_metadata`` tells where a line is from, and whether Spark reads the file as one split.
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(meta["file_path"]).alias("file"),
        ((meta["file_block_start"] == 0) & (meta["file_block_length"] >= meta["file_size"])).alias("whole"),
        F.col("value").cast("binary").alias("line"))
    return lines.mapInArrow(run, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row for each record of a chunk table, from the row that ends it."""
    number = lambda c: F.regexp_extract(c, f"^{RECORD_URI}(-?[0-9]+)$", 1).try_cast("long")
    return chunks.where("last").select(
        number("record_id").alias("id"), "record_id", "record_type", "target_uri", "payload_bytes", "payload_digest",
        number("refers_to").alias("refers_to"), (F.col("chunk_no") + 1).alias("n_chunks"),
        F.col("declared_digest").eqNullSafe(F.col("payload_digest")).alias("digest_holds"))
