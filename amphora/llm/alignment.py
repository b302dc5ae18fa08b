"""Alignment of two tokenizers' tokens over the same bytes.

Equal texts are brought together by a shuffle on the whole text (copies are
counted before they are shuffled), so each distinct text is tokenised and
aligned once; the counts of linked id pairs are weighted by how many rows have
the text, and the measures go back to the rows by a join on the text's digest.

A tokenizes a space and the text with byte-level BPE, B the text with a
sentencepiece model that puts a space in front. Offsets where tokens of both
end cut the tokens into groups, and the two tokens that end there are linked.
Neither tokenizer has tokens that go on over a single space between two
non-spaces, so such spaces cut a text into chunks that both encode and that
align on their own: a task finds the distinct chunks of a slice of texts,
encodes them and aligns all of them at once with numpy (checked: a model with
a piece beyond such a space takes whole texts as chunks).

The pinned result is a table of blocks: a row for each slice of distinct texts
with their chunk numbers, the links of the chunks, and the id pairs of the
block with their weights. Counts of the corpus are a sum over the blocks'
pairs. For the measures, every block asks for the counts of its own pairs: a
pair that is in nearly every text is asked for once a block, so no hot pair
gathers rows, and a group of the join is one block and its pairs.

Nulls and edges: null and empty texts, and texts whose tokens' bytes are not
the space and the text (a text with U+2581, say), have no tokens and zeros in
every measure; a null id is a row like any other; rows that share an id or a
text each get their row; ties of the highest count are all best; a very long
text is a block of its own; further columns are not read, so their names
cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amphora.llm.arrays import offsets_of, process_cache, ragged_take, squeeze, text_slices, tidy, tidy_group, to_batches, unsqueeze
from amphora.llm.encoders import CHUNK_ENTRIES, EncoderSpec
from amphora.session import pin_table

#: Text bytes of a block.
BLOCK_BYTES = 6 << 20

#: The B id of a pair's code; the A id is the rest.
B_SHIFT = 32

BLOCKS = T.StructType([
    T.StructField("block", T.LongType()),
    T.StructField("n_texts", T.IntegerType()),
    T.StructField("keys", T.BinaryType()),  # 16 bytes a text
    T.StructField("hashes", T.BinaryType()),  # 32 bytes a text; zero: no tokens
    T.StructField("codes", T.BinaryType()),  # chunk numbers of the texts, squeezed
    T.StructField("n_codes", T.BinaryType()),  # chunks of each text, squeezed
    T.StructField("counts", T.BinaryType()),  # A tokens, B tokens, links of each chunk, squeezed
    T.StructField("links", T.BinaryType()),  # places in ``pairs`` of the chunks' links, squeezed
    T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("weights", T.ArrayType(T.LongType())),
])

MEASURES = "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def text_key(text: Column) -> Column:
    """128 bits of the SHA-256 of a text."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


class PieceEncoder:
    """Ids of a sentencepiece model for chunks that begin with a space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        #: Whether a piece goes on over a space after another character.
        self.over_spaces = any(re.search("[^▁]▁", p) for i, p in enumerate(pieces) if not self.model.is_control(i))
        self.known: dict[str, bytes] = {}

    def forget(self) -> None:
        self.known.clear()

    def table(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each chunk (its leading space is the one the model adds) as a ragged array."""
        known = self.known
        new = [c for c in chunks if c not in known]
        found = dict(zip(new, (np.array(ids, dtype="<u4").tobytes() for ids in self.model.encode([c[1:] for c in new], num_threads=1)))) if new else {}
        out = [found[c] if c in found else known[c] for c in chunks]
        if len(known) + len(found) > CHUNK_ENTRIES:
            known.clear()
        known.update((c, ids) for c, ids in found.items() if len(c) < 64)
        return np.frombuffer(b"".join(out), dtype="<u4"), offsets_of(np.fromiter(map(len, out), dtype=np.int64, count=len(out)) // 4)


class Aligner:
    def __init__(self, a: EncoderSpec, b_path: str):
        self.a, self.b = a.load(), PieceEncoder(b_path)
        back = {c: i for i, c in enumerate(self.a.chars)}
        vocab = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes([back[c] for c in token]) if all(c in back for c in token) else token.encode()
        self.a_lengths = np.array([len(b) for b in self.a_bytes], dtype=np.int64)

    def forget(self) -> None:
        self.b.forget()

    def chunks(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct chunks, each with the space before it, the numbers of all texts' chunks, where each text's begin."""
        if self.b.over_spaces:
            own = texts.dictionary_encode()
            return [" " + t for t in own.dictionary.to_pylist()], own.indices.to_numpy().astype(np.int64), np.arange(len(texts) + 1)
        words, codes, starts = self.a.chunks(texts)
        for i in np.unique(codes[starts[:-1]]).tolist():
            words[i] = " " + words[i]
        return words, codes, starts

    def align(self, chunks: list[str]) -> dict[str, np.ndarray | list]:
        """For each chunk: numbers of A tokens, B tokens and links (0 where
        the bytes do not fit), the text of its groups; the links' pair codes."""
        a, a_at = self.a.table(chunks)
        b, b_at = self.b.table(chunks)
        sizes = np.fromiter((len(c.encode()) for c in chunks), dtype=np.int64, count=len(chunks))
        fits = np.ones(len(chunks), dtype=bool)
        whole = "".join(chunks).encode()
        for ids, at, spell in ((a, a_at, self.a_bytes), (b, b_at, self.b.bytes)):
            if b"".join([spell[i] for i in ids.tolist()]) != whole:
                spelt = [b"".join([spell[i] for i in ids[s:e].tolist()]) for s, e in zip(at.tolist(), at[1:].tolist())]
                fits &= np.fromiter((x == c.encode() for x, c in zip(spelt, chunks)), dtype=bool, count=len(chunks))
        if not fits.all():
            rows = np.flatnonzero(fits)
            (a, a_own), (b, b_own) = ragged_take(a, a_at, rows), ragged_take(b, b_at, rows)
            a_at, b_at = (offsets_of(np.where(fits, np.diff(x), 0)) for x in (a_at, b_at))
            sizes = np.where(fits, sizes, 0)
        # Ends in the bytes of all chunks that fit: a chunk's end is one of both.
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b.lengths[b])
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        n_links = np.diff(np.searchsorted(ends, offsets_of(sizes), side="right"))
        spelt_a, spelt_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, i, j = [], 0, 0
        for k, m in zip(of_a.tolist(), of_b.tolist()):
            groups.append(",".join(spelt_a[i : k + 1]) + "|" + ",".join(spelt_b[j : m + 1]))
            i, j = k + 1, m + 1
        at = offsets_of(n_links).tolist()
        return {
            "n_a": np.diff(a_at), "n_b": np.diff(b_at), "n_links": n_links, "fits": fits,
            "groups": [";".join(groups[s:e]) for s, e in zip(at, at[1:])],
            "pairs": b[of_b].astype(np.int64) << B_SHIFT | a[of_a].astype(np.int64),
        }

    def block(self, number: int, keys: list[bytes], texts: pa.Array, copies: np.ndarray) -> dict:
        chunks, codes, starts = self.chunks(texts)
        told = self.align(chunks)
        fits = np.logical_and.reduceat(told["fits"][codes], starts[:-1])
        n_codes = np.diff(starts)
        if not fits.all():  # such texts have no chunks
            codes = codes[np.repeat(fits, n_codes)]
            n_codes = np.where(fits, n_codes, 0)
        at, groups, hashes = offsets_of(n_codes).tolist(), told["groups"], []
        numbers = codes.tolist()
        for s, e in zip(at, at[1:]):
            hashes.append(hashlib.sha256(";".join([groups[i] for i in numbers[s:e]]).encode()).digest() if e > s else bytes(32))
        pairs, links = np.unique(told["pairs"], return_inverse=True)
        # Weights are whole numbers of rows; doubles hold them exactly far beyond any table.
        of_chunk = np.bincount(codes, weights=np.repeat(copies, n_codes), minlength=len(chunks))
        weights = np.bincount(links, weights=np.repeat(of_chunk, told["n_links"]), minlength=len(pairs)).astype(np.int64)
        counts = np.stack([told["n_a"], told["n_b"], told["n_links"]]).astype("<i8")
        return {
            "block": number, "n_texts": len(keys), "keys": b"".join(keys), "hashes": b"".join(hashes), "codes": squeeze(codes.astype("<u4")), "n_codes": squeeze(n_codes.astype("<i8")),
            "counts": squeeze(counts), "links": squeeze(links.astype("<u4")), "pairs": pairs, "weights": weights,
        }


def aligner(a: EncoderSpec, b_path: str) -> Aligner:
    cache = process_cache()
    if (a, b_path) not in cache:
        cache[a, b_path] = Aligner(a, b_path)
    return cache[a, b_path]


def align_texts(docs: DataFrame, a: EncoderSpec, b_path: str, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The pinned table of blocks of the distinct texts of ``docs``."""
    schema = to_arrow_schema(BLOCKS)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = aligner(a, b_path), TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            table = pa.Table.from_batches(held).combine_chunks()
            texts = table.column("text").combine_chunks().cast(pa.string())
            row = own.block(part << 32 | number, table.column("key").to_pylist(), texts, table.column("copies").to_numpy())
            yield from to_batches({f.name: [row[f.name]] for f in schema}, schema)
            number, size = number + 1, 0
            held.clear()

        for batch in batches:
            for piece in text_slices(batch, "text", block_bytes):
                if held and size + piece.column("text").nbytes > block_bytes:
                    yield from close()
                held.append(piece)
                size += piece.column("text").nbytes
        if held:
            yield from close()

    texts = docs.select(F.col(text_col).alias("text")).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return pin_table(texts.select(text_key(F.col("text")).alias("key"), "copies", "text").mapInArrow(run, BLOCKS), "alignment")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``a_id, b_id, n`` (links that hold the pair, over all rows) and ``best``
    (no A id is linked with this B id more often)."""
    asked = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).select("p.pairs", "p.weights")
    counts = asked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("n")).where("n > 0")
    # Pairs of one B id are as many as A has ids at most.
    counts = pin_table(counts.select(
        "pair", F.col("pair").bitwiseAND(F.lit((1 << B_SHIFT) - 1)).cast("int").alias("a_id"), F.shiftright("pair", B_SHIFT).cast("int").alias("b_id"), "n"), "pair-counts")
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return counts.join(most, "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def _measured(left: pa.Table, right: pa.Table) -> pa.Table:
    """Measures of the texts of one block from the counts of its pairs."""
    out = []
    asked = right.column("pair").to_numpy()
    order = np.argsort(asked)
    for row in left.to_pylist():
        pairs = np.array(row["pairs"], dtype=np.int64)
        n, best = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
        at = np.searchsorted(asked[order], pairs) if len(asked) else np.zeros(len(pairs), dtype=np.int64)
        hit = (at < len(asked)) & (asked[order[np.minimum(at, len(asked) - 1)]] == pairs) if len(asked) else np.zeros(len(pairs), dtype=bool)
        n[hit] = right.column("n").to_numpy()[order[at[hit]]]
        best[hit] = right.column("best").to_numpy(zero_copy_only=False)[order[at[hit]]]
        links = unsqueeze(row["links"], "<u4")
        n_a, n_b, n_links = unsqueeze(row["counts"], "<i8").reshape(3, -1)
        per_link = offsets_of(n_links)
        of_chunk = {"n_a": n_a, "n_b": n_b, "n_links": n_links}
        of_chunk |= {name: np.diff(np.append(0, np.cumsum(x[links]))[per_link]) for name, x in (("n_best", best), ("count_sum", n))}
        codes, ends = unsqueeze(row["codes"], "<u4"), offsets_of(unsqueeze(row["n_codes"], "<i8"))
        text = {name: np.diff(np.append(0, np.cumsum(x[codes]))[ends]) for name, x in of_chunk.items()}
        keys, hashes = row["keys"], row["hashes"]
        out.append(pa.table({
            "key": [keys[16 * i : 16 * i + 16] for i in range(row["n_texts"])], "n_a": text["n_a"], "n_b": text["n_b"], "n_groups": text["n_links"], "n_links": text["n_links"],
            "n_best": text["n_best"], "count_sum": text["count_sum"],
            "groups_sha256": [hashes[32 * i : 32 * i + 32].hex() if text["n_a"][i] else "" for i in range(row["n_texts"])],
        }))
    return pa.concat_tables(out) if out else pa.table({"key": pa.array([], pa.binary())} | {c: pa.array([], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")} | {"groups_sha256": pa.array([], pa.string())})


def text_measures(blocks: DataFrame) -> DataFrame:
    """One row for each distinct text: its key and measures."""
    counts = pair_counts(blocks).select("pair", "n", "best")
    asked = blocks.select(F.col("block").alias("asking"), F.explode("pairs").alias("pair"))
    told = asked.join(counts, "pair").select("asking", "pair", "n", "best")
    rest = blocks.drop("weights")
    return rest.groupBy("block").cogroup(told.groupBy("asking")).applyInArrow(tidy_cogroup(_measured), MEASURES)


def tidy_cogroup(run):
    def wrapped(left: pa.Table, right: pa.Table) -> pa.Table:
        return tidy_group(lambda _, __: run(left, right))((), left)

    return wrapped


def align(docs: DataFrame, a: EncoderSpec, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs``: its id and the measures of its text."""
    found = text_measures(align_texts(docs, a, b_path, text_col, block_bytes))
    rows = docs.select(id_col, F.when(F.col(text_col) != "", text_key(F.col(text_col))).alias("key"))
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return rows.join(found, "key", "left").select(
        id_col, *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
