"""Token ids in shard files of compressed bit or byte planes.

A shard holds consecutive documents in ascending ``doc_id`` order. Its ids are cut into blocks of a
fixed size; a block is transposed into planes (all lowest bytes, then all second bytes, ..., or the
same by bits), because the high planes of ids are nearly constant, and every plane is compressed with
zstandard by itself. A chunk index at the end of the file says where each block lies, so that any
range of ids can be read without the rest.

Layout: magic, planes of all blocks, compressed document table (doc_id, valid, ids per document),
JSON footer with the chunk index, footer length as 8 bytes, magic.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from functools import lru_cache
from itertools import chain
from typing import Iterator, NamedTuple, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.batches import slices
from granary.llm.shipping import ship

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
REMEMBERED_WORDS = 900_000
SENT_BYTES = 4 << 20


class Planes(NamedTuple):
    """How a block is laid out: ids per block, planes by ``byte`` or ``bit``, zstandard level."""

    block: int = BLOCK
    unit: str = "byte"
    level: int = 3


# ---- blocks ----------------------------------------------------------------------------------

def pack(ids: np.ndarray, planes: Planes) -> list[bytes]:
    """Compressed planes of one block of unsigned 32-bit ids, lowest plane first; a plane of zeros is empty."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=planes.level, write_content_size=True).compress
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(len(ids), 4)
    if planes.unit == "bit":
        rows = np.unpackbits(rows, axis=1, bitorder="little")
    turned = np.ascontiguousarray(rows.T)
    if planes.unit == "bit":
        turned = np.packbits(turned, axis=1, bitorder="little")
    return [squeeze(plane.tobytes()) if plane.any() else b"" for plane in turned]


def unpack(parts: Sequence[bytes], n: int, unit: str) -> np.ndarray:
    """Inverse of ``pack``."""
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    width = n if unit == "byte" else -(-n // 8)
    turned = np.zeros((len(parts), width), np.uint8)
    for plane, part in enumerate(parts):
        if part:
            turned[plane] = np.frombuffer(expand(part), np.uint8)
    if unit == "bit":
        turned = np.packbits(np.unpackbits(turned, axis=1, count=n, bitorder="little"), axis=0, bitorder="little")
    return np.ascontiguousarray(turned.T).view("<u4").reshape(n)


# ---- files -----------------------------------------------------------------------------------

def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else "file://" + uri.removeprefix("file:"))


class ShardWriter:
    """Writes one shard under a name of its own; ``close`` gives it its final name in one step, so
    that a task that runs twice leaves one whole file."""

    def __init__(self, uri: str, planes: Planes) -> None:
        self.store, self.path = _store(uri)
        self.store.create_dir(os.path.dirname(self.path), recursive=True)
        self.hidden = f"{os.path.dirname(self.path)}/.{os.path.basename(self.path)}-{uuid4().hex}"
        self.out = self.store.open_output_stream(self.hidden)
        self.planes, self.waiting, self.held = planes, [], 0
        self.at, self.chunks, self.names, self.lengths = len(MAGIC), [], [], []
        self.out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.names.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.planes.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        whole = len(ids) if last else len(ids) - len(ids) % self.planes.block
        for a in range(0, whole, self.planes.block):
            block = ids[a:min(a + self.planes.block, whole)]
            parts = pack(block, self.planes)
            for part in parts:
                self.out.write(part)
            self.chunks.append([self.at, len(block), [len(p) for p in parts]])
            self.at += sum(map(len, parts))
        self.waiting, self.held = [ids[whole:].copy()], len(ids) - whole

    def close(self) -> tuple[int, int]:
        """Documents and ids written."""
        self._flush(True)
        table = zlib.compress(
            np.array([n or 0 for n in self.names], "<i8").tobytes() + np.array([n is not None for n in self.names], "u1").tobytes()
            + np.array(self.lengths, "<i8").tobytes()
        )
        self.out.write(table)
        footer = json.dumps({
            "unit": self.planes.unit, "block": self.planes.block, "documents": len(self.names),
            "ids": int(sum(self.lengths)), "table": [self.at, len(table)], "chunks": self.chunks,
        }).encode()
        self.out.write(footer + struct.pack("<q", len(footer)) + MAGIC)
        self.out.close()
        self.store.move(self.hidden, self.path)
        return len(self.names), int(sum(self.lengths))


class ShardReader:
    """Random access to one shard."""

    def __init__(self, uri: str) -> None:
        store, path = _store(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        length, magic = struct.unpack("<q8s", self.file.read_at(16, size - 16))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a whole shard")
        self.footer = json.loads(self.file.read_at(length, size - 16 - length))
        n, raw = self.footer["documents"], zlib.decompress(self.file.read_at(*self.footer["table"][::-1]))
        valid = np.frombuffer(raw, "u1", n, 8 * n)
        self.doc_ids = [int(d) if v else None for d, v in zip(np.frombuffer(raw, "<i8", n), valid)]
        self.lengths = np.frombuffer(raw, "<i8", n, 9 * n)

    def block(self, number: int) -> np.ndarray:
        at, n, sizes = self.footer["chunks"][number]
        raw, parts = self.file.read_at(sum(sizes), at), []
        for size in sizes:
            parts.append(raw[:size])
            raw = raw[size:]
        return unpack(parts, n, self.footer["unit"])

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the shard, from the blocks that hold them."""
        size, out = self.footer["block"], []
        for number in range(start // size, -(-(start + n) // size) if n else 0):
            out.append(self.block(number)[max(0, start - number * size):start + n - number * size])
        return np.concatenate(out) if out else np.empty(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, place of its first id in the shard, its ids; reads every block once."""
        blocks = (self.block(i) for i in range(len(self.footer["chunks"])))
        rest, start = np.empty(0, "<u4"), 0
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist()):
            have, held = [rest], len(rest)
            while held < n:
                have.append(next(blocks))
                held += len(have[-1])
            joined = np.concatenate(have) if len(have) > 1 else rest
            rest = joined[n:]
            yield doc_id, start, joined[:n]
            start += n


# ---- tokens ----------------------------------------------------------------------------------

class WordEncoder:
    """Ids of whole texts by a ``tokenizers`` file that lower-cases and never joins across white space
    or between a letter and a following punctuation mark, with a BPE model that marks word ends.

    The library encodes each distinct word once; a text's ids are those of its words in order, which
    equals encoding the text in one go. Words are kept as lower-cased bytes, and closing marks after
    a letter or digit are encoded apart from the word, so fewer words have to be encoded.

    Strings of the file's added tokens, such as <|endoftext|>, become those tokens, as in the library by itself;
    with ``added_as_text`` they are split like other text. The library looks for them before it lower-cases, so a
    word that holds one in any case is encoded as it is.
    """

    def __init__(self, path: str, added_as_text: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.quick = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = self.quick.encode_special_tokens = added_as_text
        added = [] if added_as_text else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(a.split() != [a] for a in added):
            raise ValueError(f"{path} has added tokens with white space")
        self.holds_added = re.compile(b"|".join(re.escape(a.lower()) for a in added)).search if added else lambda raw: None
        # Lower-case ASCII letters are what the normaliser and the splitter leave as they are.
        self.quick.normalizer, self.quick.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        ending = self.tokenizer.model.end_of_word_suffix
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for token, i in self.tokenizer.get_vocab().items() if ending and token.endswith(ending)]] = True
        self.known: dict[bytes, bytes] = {}
        self.tail = re.compile(rb"(?<=[^!-/:-@\[-`{-~])[!-&(-/:-@\[-`{-~]+$").search  # closing marks but the apostrophe
        # Latin letters that composing and lower-casing turn into one letter each.
        self.letter = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+").fullmatch
        # A capital before what may be a combining mark must not be lower-cased before it is composed.
        self.composed = re.compile("[A-Z][^\x00-\u02ff]").search

    def words(self, text: str | None) -> list[bytes]:
        raw = (text or "").encode()
        low = raw.lower()
        used = low if len(raw) == len(text or "") or not self.composed(text) else raw
        if self.holds_added(low):
            return [whole if self.holds_added(whole.lower()) else word for whole, word in zip(raw.split(), used.split())]
        return used.split()

    def _ask_together(self, words: Sequence[bytes], tokenizer) -> None:
        """Words of letters only: each is one piece for the splitter, so its ids end at the first token
        that ends a word, and many words can be encoded as one text."""
        for a in range(0, len(words), 2_000):
            part = words[a:a + 2_000]
            ids = np.array(tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part):
                self._ask(part)
                continue
            raw, last = ids.tobytes(), 0
            for word, end in zip(part, (4 * ends).tolist()):
                self.known[word] = raw[last:end]
                last = end

    def _ask(self, words: Sequence[bytes]) -> None:
        for a in range(0, len(words), 5_000):
            part = words[a:a + 5_000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                self.known[word] = array("I", found.ids).tobytes()

    def _learn(self, words: set[bytes]) -> None:
        parts, tails = set(), []
        for word in words:
            cut = not self.holds_added(word.lower()) and self.tail(word)
            if cut and (stem := word[:cut.start()]) and (stem[-1:].isalnum() or self.letter(stem.decode()[-1])):
                tails.append((word, stem, cut[0]))
                parts.update((stem, cut[0]))
            else:
                parts.add(word)
        plain, letters, rest = [], [], []
        for word in parts.difference(self.known):
            (plain if word.islower() and word.isalpha() else letters if self.letter(word.decode()) else rest).append(word)
        self._ask_together(plain, self.quick)
        self._ask_together(letters, self.tokenizer)
        self._ask(rest)
        for word, stem, mark in tails:
            self.known[word] = self.known[stem] + self.known[mark]

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        cut = [self.words(t) for t in texts]
        words = set(chain.from_iterable(cut))
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self.known.clear()
            new = words
        if new:
            self._learn(new)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, row)), "<u4") for row in cut]


@lru_cache(maxsize=2)
def word_encoder(path: str, added_as_text: bool = True) -> WordEncoder:
    return WordEncoder(path, added_as_text)


# ---- datasets --------------------------------------------------------------------------------

def write(documents: DataFrame, folder: str, tokenizer: str, end_id: int, planes: Planes = Planes(), added_as_text: bool = True) -> DataFrame:
    """Encode whole texts and write them as shards below ``folder``; returns the manifest.

    Documents are sorted by (doc_id, hash of the text), so ties and repeated rows have one order; a NULL doc_id
    comes first, a NULL text counts as empty. ``end_id`` ends each document, so an empty one has one
    id. Partitions of the sort are the shards, written by the tasks that hold them; a repeated task
    writes the same file again. The manifest (shard, path, documents, ids, first_id) is a Parquet table
    in the folder. Empty input gives an empty manifest. ``folder`` must be reachable from all executors.
    ``added_as_text`` splits strings of added tokens as words; the library by itself, and the query, don't.
    """
    spark = documents.sparkSession
    ship(spark)
    base = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out, end = word_encoder(tokenizer, added_as_text), None, np.array([end_id], "<u4")
        shard = TaskContext.get().partitionId()
        path = f"{base}/shard-{shard:06d}.idp"
        for batch in batches:
            for part in slices(batch, "text"):
                out = out or ShardWriter(path, planes)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), own.encode(part.column("text").to_pylist())):
                    out.add(doc_id, np.concatenate([ids, end]))
        if out:
            n_documents, n_ids = out.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "documents": n_documents, "ids": n_ids}])

    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").orderBy("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, "shard long, path string, documents long, ids long").write.mode("overwrite").parquet(f"{base}/manifest")
    return manifest(spark, base)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard with the place of its first id in the whole output."""
    shards = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return shards.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents back from the files: doc_id, start (ids before it), ids_le (its ids, little-endian
    unsigned 32-bit, binary). One task per few shards; a task holds one block and one document."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "ids_le"]
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist()):
                rows, held = ([], [], []), 0
                for doc_id, start, ids in ShardReader(path).documents():
                    for column, value in zip(rows, (doc_id, first + start, ids.tobytes())):
                        column.append(value)
                    held += 4 * len(ids) + 32
                    if held > SENT_BYTES:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, rows, kinds)), names)
                        rows, held = ([], [], []), 0
                if rows[0]:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, rows, kinds)), names)

    shards = manifest(spark, folder).select("shard", "path", "first_id")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(width, "shard").select("path", "first_id").mapInArrow(run, "doc_id long, start long, ids_le binary")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: start, number of ids, crc32 of its ids."""
    return read(spark, folder).select(
        "doc_id", "start", F.expr("cast(octet_length(ids_le) div 4 as long)").alias("n_tokens"), F.crc32("ids_le").alias("ids_crc32"),
    )
