import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import crowded, documents, empty
from tokenizers import Tokenizer

from granary.llm import bitplane_ids, byte_bpe
from granary.llm.queries import scratch

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.text(st.one_of(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), st.sampled_from(" .,'\n!Aaé")), max_size=80)


@pytest.fixture(scope="module")
def plain():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(WORDS)
    made.encode_special_tokens = True
    return made


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_bpe_equals_the_library_and_decodes(plain, text):
    own = byte_bpe.codec(RANKS, PATTERN)
    ids = np.frombuffer(own.encode([text])[0], "<i4")
    assert ids.tolist() == plain.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_equal_the_library(library, text):
    own = bitplane_ids.word_encoder(WORDS)
    assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_of_odd_rows(spark, plain):
    rows = crowded(documents(spark), "IDS", "_row")
    coded = byte_bpe.encode(rows, RANKS, PATTERN)
    assert [c for c in coded.columns if c.lower() == "ids"] == ["ids"] and "_row" in coded.columns
    found = byte_bpe.decode(coded, RANKS, PATTERN).collect()
    assert len(found) == rows.count()
    for row in found:
        assert row["ids"] == plain.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert byte_bpe.encode(empty(spark), RANKS, PATTERN).count() == 0


def test_bpe_digests(spark, plain):
    for row in byte_bpe.digests(documents(spark).where("doc_id = 8"), RANKS, PATTERN).collect():
        text = documents(spark).where("doc_id = 8").first()["text"]
        ids = plain.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(unit, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    planes = bitplane_ids.Planes(unit=unit)
    assert (bitplane_ids.unpack(bitplane_ids.pack(ids, planes), n, unit) == ids).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_shard_gives_any_range(tmp_path, unit):
    path = str(tmp_path / "one.idp")
    writer = bitplane_ids.ShardWriter(path, bitplane_ids.Planes(block=64, unit=unit))
    parts = [np.arange(n, dtype=np.uint32) * 7 for n in (0, 1, 63, 64, 65, 500, 2)]
    for i, ids in enumerate(parts):
        writer.add(i if i else None, ids)
    writer.close()
    reader, whole = bitplane_ids.ShardReader(path), np.concatenate(parts)
    assert [(d, len(i)) for d, _, i in reader.documents()] == [(i if i else None, len(p)) for i, p in enumerate(parts)]
    assert all((ids == whole[start:start + len(ids)]).all() for _, start, ids in reader.documents())
    for start, n in ((0, 10), (60, 10), (100, 300), (694, 1), (5, 0)):
        assert (reader.read(start, n) == whole[start:start + n]).all()
    assert [p.name for p in tmp_path.iterdir()] == ["one.idp"]
    (tmp_path / "broken.idp").write_bytes(b"x" * 40)
    with pytest.raises(ValueError):
        bitplane_ids.ShardReader(str(tmp_path / "broken.idp"))


def test_token_files_of_odd_rows(spark, library):
    place = scratch(spark, "test-ids")
    bitplane_ids.write(crowded(documents(spark), "start", "Path"), place, WORDS, 2, bitplane_ids.Planes(block=1000))
    found = {(r["start"], r["doc_id"]): r for r in bitplane_ids.digests(spark, place).collect()}
    rows = sorted(documents(spark).collect(), key=lambda r: -1 if r["doc_id"] is None else r["doc_id"])
    start = 0
    for row in rows:
        ids = np.array(library.encode(row["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        got = found[start, row["doc_id"]]
        assert (got["n_tokens"], got["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(found) == len(rows)


def test_no_documents_no_files(spark):
    place = scratch(spark, "test-ids")
    assert bitplane_ids.write(empty(spark), place, WORDS, 2).count() == 0
    assert bitplane_ids.digests(spark, place).count() == 0


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y.", "Don<|endoftext|>'t!?", "<|ENDOFTEXT|> <|EndOfText|>, <|endoftext|>,", "E<|startoftext|>\u0301 É<|endoftext|>",
         "<|endoftext|><|startoftext|>", "<|endoftext|", "end.<|startoftext|>Start", "H\u0331 <|endoftext|> ABC\u0331", "İ<|endoftext|>\u3000<|endoftext|>\x1cX"]


@pytest.fixture(scope="module")
def unaltered():
    return Tokenizer.from_file(WORDS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.sampled_from(ADDED)), max_size=5).map("".join))
def test_added_tokens_equal_the_unaltered_library(unaltered, text):
    own = bitplane_ids.word_encoder(WORDS, False)
    for t in (text, *ADDED):
        assert own.encode([t])[0].tolist() == unaltered.encode(t, add_special_tokens=False).ids
    assert own.encode([ADDED[0]])[0].tolist() == [320, 49407, 321]


def test_query_equals_the_unaltered_library(spark, unaltered, tmp_path):
    from granary.llm.queries import QUERIES

    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    for row in QUERIES["op10_bitplane_ids"](spark, str(tmp_path)).collect():
        ids = np.array(unaltered.encode(texts[row["doc_id"]], add_special_tokens=False).ids + [2], "<u4")
        assert (row["n_tokens"], row["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
