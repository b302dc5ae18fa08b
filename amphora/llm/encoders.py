"""Token ids of whole texts from the tokenizers library, one call per distinct chunk.

A text is cut at single spaces where the tokenizer's own pre-tokenizer always
cuts too, the distinct chunks of a slice are found by Arrow, each is encoded
once by the library, and the ids of the texts are gathered from that table
with numpy. The ids equal those of encoding each whole text (tested).
"""

from __future__ import annotations

import json
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from amphora.llm.arrays import filled, process_cache, ragged_take

#: Chunks of these characters only (printable ASCII, Latin letters of one code
#: point that NFC leaves alone, line feed) skip the library's normalizer and
#: go straight to its BPE model; any other chunk takes the library's full path.
PLAIN = "[\n!-~À-ÖØ-öø-ÿ ]*"

#: A space beside another white-space character or at an end of the text.
LOOSE_SPACE = r"(?:\A|[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]) | (?:\z|[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}])"

#: A chunk that is one run of such letters and at most one mark is two pre-tokens.
WORD = "( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]?)"

#: Entries of a worker's tables of known chunks and pieces; a full table starts anew.
CHUNK_ENTRIES, PIECE_ENTRIES = 100_000, 350_000


def byte_characters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte:
    printable Latin-1 bytes stand for themselves, the others follow from 256 up."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in own}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(own))
    return [out[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and number on each line)."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair that makes each token of two bytes or more, by rank: what the
    merges of lower rank leave of the token's own bytes."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) < 2:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def tokenizer_from_ranks(path: str, pattern: str):
    """A byte-level tokenizer of the tokenizers library with the vocabulary of a rank file."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    ranks, chars = read_ranks(path), byte_characters()
    spell = lambda token: "".join(chars[b] for b in token)
    out = Tokenizer(models.BPE({spell(t): r for t, r in ranks.items()}, [(spell(a), spell(b)) for a, b in merges_of(ranks)], ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    out.decoder = decoders.ByteLevel()
    return out


@dataclass(frozen=True)
class EncoderSpec:
    """path: a tokenizer file of the tokenizers library, or a rank file (then
    ``pattern`` is what splits texts before the merges). special_as_text: the
    strings of special tokens inside texts are ordinary text."""

    path: str
    pattern: str | None = None
    special_as_text: bool = False

    def load(self) -> ChunkEncoder:
        cache = process_cache()
        if self not in cache:
            cache[self] = ChunkEncoder(self)
        return cache[self]


class ChunkEncoder:
    def __init__(self, spec: EncoderSpec):
        import regex
        from tokenizers import Tokenizer

        self.lower = False
        self.specials: list[str] = []
        if spec.pattern:
            self.tokenizer, pattern = tokenizer_from_ranks(spec.path, spec.pattern), spec.pattern
        else:
            self.tokenizer = Tokenizer.from_file(spec.path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            told = json.loads(self.tokenizer.to_str())
            self.tokenizer.encode_special_tokens = spec.special_as_text
            self.specials = [] if spec.special_as_text else [t["content"] for t in told["added_tokens"]]
            self.lower = "Lowercase" in json.dumps(told["normalizer"])
            pattern = _pattern(told["pre_tokenizer"])
        #: White space is dropped by the pre-tokenizer, so any space or line feed is a cut.
        self.drops_space = self.lower
        self.model = self.tokenizer.model
        self.find = regex.compile(pattern).findall
        self.plain = re.compile(PLAIN).fullmatch
        self.word = re.compile(WORD).fullmatch
        self.chars = byte_characters()
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop the tables, not the tokenizer."""
        self.known.clear()
        self.pieces.clear()

    def pre_tokens(self, chunk: str) -> list[str] | None:
        """The pre-tokens of a plain chunk; None: only the library itself can tell."""
        if self.lower:
            chunk = chunk.lower()
        if word := self.word(chunk):
            return [p for p in word.groups() if p]
        if not self.plain(chunk) or any(s in chunk for s in self.specials):
            return None
        return self.find(chunk)

    def every_pre_token(self, chunk: str) -> list[str] | None:
        """The pre-tokens of any chunk: where it is not plain, by the library's
        own normalizer and pre-tokenizer; None: it holds a special token's string."""
        found = self.pre_tokens(chunk)
        if found is not None:
            return found
        normalizer = self.tokenizer.normalizer
        text = normalizer.normalize_str(chunk) if normalizer else chunk
        if any(s in chunk or s in text for s in self.specials):
            return None
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def tokens_of(self, piece: str) -> int:
        """Tokens of one of ``every_pre_token``, or of a chunk for which that is None."""
        if any(s in piece for s in self.specials):
            return len(self.encode_chunk(piece)) // 4
        return len(self.model.tokenize("".join([self.chars[b] for b in piece.encode()])))

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token by the library's BPE model."""
        if piece.isascii() and "\n" not in piece:
            spelt = piece.replace(" ", self.chars[32])
        else:
            spelt = "".join([self.chars[b] for b in piece.encode()])
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        found = self.pre_tokens(chunk)
        if found is None:
            return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        pieces, out = self.pieces, []
        for piece in found:
            ids = pieces.get(piece)
            if ids is None:
                if len(pieces) >= PIECE_ENTRIES:
                    pieces.clear()
                ids = pieces[piece] = self._piece(piece)
            out.append(ids)
        return b"".join(out)

    def table(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each chunk as a ragged array."""
        known, out = self.known, []
        for chunk in chunks:
            ids = known.get(chunk)
            if ids is None:
                ids = self.encode_chunk(chunk)
                if len(chunk) < 64:
                    if len(known) >= CHUNK_ENTRIES:
                        known.clear()
                    known[chunk] = ids
            out.append(ids)
        offsets = np.zeros(len(out) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, out), dtype=np.int64, count=len(out)) // 4, out=offsets[1:])
        return np.frombuffer(b"".join(out), dtype="<u4"), offsets

    def chunks(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct chunks, the chunk numbers of all texts, and where each text's begin."""
        texts = filled(column)
        if self.drops_space:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        else:
            lists = pc.split_pattern(texts, " ")
            loose = np.flatnonzero(pc.match_substring_regex(texts, LOOSE_SPACE).to_numpy(zero_copy_only=False))
            if len(loose):
                own = pa.array([re.split(r"(?<=\S) (?=\S)", texts[int(i)].as_py()) for i in loose], type=pa.list_(pa.string()))
                order = np.arange(len(texts))
                order[loose] = len(texts) + np.arange(len(loose))
                lists = pa.concat_arrays([lists, own]).take(pa.array(order))
        starts = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        starts = starts - starts[0]
        codes = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not self.drops_space:  # every chunk but a text's first keeps the space before it
            first = starts[:-1]
            lead, own = np.unique(codes[first], return_inverse=True)
            codes[first] = len(words) + own
            words = [" " + w for w in words] + [words[i] for i in lead.tolist()]
        return words, codes, starts

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) one after the other, and their offsets."""
        words, codes, starts = self.chunks(column)
        if len(codes) == 0:
            return np.zeros(0, dtype="<u4"), np.zeros(len(column) + 1, dtype=np.int64)
        ids, ends = ragged_take(*self.table(words), codes)
        return ids, ends[starts]


def _pattern(told: dict) -> str:
    """The splitting pattern of a pre-tokenizer; byte-level without its own has the public default."""
    for step in told.get("pretokenizers", [told]):
        if "Regex" in (step.get("pattern") or {}):
            return step["pattern"]["Regex"]
    import public_tokenizers

    return public_tokenizers.PATTERN
