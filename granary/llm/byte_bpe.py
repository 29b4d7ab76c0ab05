"""Byte-level BPE by way of a sentencepiece model built from a rank file.

No tokenizer is trained: the vocabulary's tokens become the pieces of a serialised sentencepiece BPE
model. Every byte is written as one visible character, a piece scores minus its rank and the
normaliser is the identity, so sentencepiece merges exactly the pairs that the rank file would merge
first. A text is cut by the splitting pattern and each match is encoded by itself; ids are turned
back into bytes by the inverse table.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache
from itertools import chain
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm.batches import lists_of, slices
from granary.llm.shipping import ship

# Words remembered per Python worker; beyond that the memory is emptied and filled anew.
REMEMBERED_WORDS = 150_000

# Field numbers and enum values of the published sentencepiece model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
BPE = 2


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file: base64 token, blank, rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


@lru_cache(maxsize=1)
def visible() -> str:
    """256 distinct characters, one per byte: printable Latin-1 bytes stand for themselves, the rest
    for the characters from U+0100 on. None is white space."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    later = iter(range(0x100, 0x200))
    return "".join(chr(byte) if byte in plain else chr(next(later)) for byte in range(256))


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a rank file. Piece 0 is the unknown piece, piece i + 1 the i-th token by rank."""
    letters = visible()
    unknown = "⁇unknown"  # holds a character that no byte is written as
    out = [_block(PIECES, _block(1, unknown.encode()) + _number(3, UNKNOWN))]
    for token in sorted(ranks, key=ranks.__getitem__):
        shown = "".join(letters[b] for b in token).encode()
        out.append(_block(PIECES, _block(1, shown) + _varint(2 << 3 | 5) + struct.pack("<f", -ranks[token]) + _number(3, NORMAL)))
    trainer = _number(3, BPE) + _number(4, len(ranks) + 1) + _number(40, 0) + b"".join(_number(f, -1) for f in (41, 42, 43))
    normalizer = _block(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))
    return b"".join(out) + _block(TRAINER, trainer + _block(45, unknown.encode())) + _block(NORMALIZER, normalizer)


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded memory of words already encoded."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path} has no token for {len(missing)} single bytes")
        if max(self.ranks.values()) >= 1 << 24:
            raise ValueError(f"{path} has ranks that a single-precision score can't tell apart")
        self.words_of = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.rank_of_piece = np.array([-1, *sorted(self.ranks.values())], dtype="<i4")
        self.letters = visible()
        self.known: dict[str, bytes] = {}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}

    def _learn(self, words: Sequence[str]) -> None:
        shown, later = [], []
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.known[word] = struct.pack("<i", rank)
            else:
                later.append(word)
                shown.append(raw.decode("latin-1").translate(self.letters))
        for word, pieces in zip(later, self.model.encode(shown, num_threads=1)):
            self.known[word] = self.rank_of_piece[pieces].tobytes()

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers; a NULL text has none."""
        cut = [self.words_of(text) if text else [] for text in texts]
        words = set(chain.from_iterable(cut))
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self.known.clear()
            new = words
        if new:
            self._learn(list(new))
        return [b"".join(map(self.known.__getitem__, row)) for row in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds ``ids``: array<int> of the whole text, each match of ``pattern`` encoded separately.

    A NULL or empty text has no ids. Other columns, row order and repeated rows stay as they are; a
    column already called ``ids`` is replaced. No special tokens: their strings are ordinary text.
    The file at ``path`` must be there on every executor. Memory follows the largest text.
    With ``decoded`` the ids are decoded again in the same pass, into a binary column of that name.
    """
    ship(df.sparkSession)
    new = [ids] if decoded is None else [ids, decoded]
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in new}]
    kinds = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), *[T.StructField(n, T.BinaryType()) for n in new[1:]]]
    shape = T.StructType([*[f for f in df.schema.fields if f.name in kept], *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, text):
                coded = own.encode(part.column(text).to_pylist())
                made = [lists_of(coded, pa.int32())]
                if decoded is not None:
                    made.append(pa.array([own.decode(np.frombuffer(row, "<i4")) for row in coded], pa.binary()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *made], [*kept, *new])

    return df.mapInArrow(run, shape)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``: the bytes that ``ids`` stand for (binary, as single ids need not be whole
    characters). NULL ids give NULL, no ids give no bytes; an id outside the vocabulary is an error."""
    ship(df.sparkSession)
    kept = [c for c in df.columns if c.lower() != decoded.lower()]
    shape = T.StructType([*[f for f in df.schema.fields if f.name in kept], T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            column = batch.column(ids)
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            rows = [own.decode(values[a:b]) if here else None
                    for a, b, here in zip(ends[:-1], ends[1:], column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(rows, pa.binary())], [*kept, decoded])

    return df.mapInArrow(run, shape)


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, sha-256 of the ids in decimal, sha-256 of the decoded bytes."""
    coded = encode(documents.select("doc_id", "text"), path, pattern, decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
