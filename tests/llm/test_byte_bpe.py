"""Byte-level BPE: ids of the library on whole texts, safe stretches, exact bytes back."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rollcall.llm import byte_bpe
from rollcall.llm.queries import QUERIES, RANKS

SIGNS = ["a", "B", "é", "中", "9", "٣", "'", "'s", "'ll", " ", "  ", "\n", "\t", " ", "　", "\x1c", ".", "--", "🙂", "́", "word"]


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.Ranks(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return ranks.library()


def test_stretches_keep_the_ids(library):
    dice = random.Random(5)
    for round_ in range(400):
        picked = dice.sample(SIGNS, dice.randint(1, 6)) if round_ % 2 else SIGNS
        text = "".join(dice.choices(picked, k=dice.randint(0, 120)))
        limit = dice.randint(1, 12)
        parts = list(byte_bpe.stretches(text, limit))
        assert "".join(parts) == text
        assert byte_bpe.encode(text, library, limit).tolist() == library.encode_ordinary(text)


def test_long_texts_are_cut_and_long_matches_are_not(library):
    prose = "It's the 3rd text, isn't it?  Yes.\n" * 20_000
    parts = list(byte_bpe.stretches(prose))
    assert len(parts) > 3 and max(map(len, parts)) <= byte_bpe.LONG + 1
    assert byte_bpe.encode(prose, library).tolist() == library.encode_ordinary(prose)
    assert len(list(byte_bpe.stretches("中" * 500_000))) == 1
    mixed = "中文字符，" * 100_000
    assert max(map(len, byte_bpe.stretches(mixed))) <= byte_bpe.LONG + 5
    blank = " " * 600_000 + "end"
    assert b"".join(library.decode_single_token_bytes(i) for i in byte_bpe.encode(blank, library).tolist()) == blank.encode()


def test_columns(spark, ranks, library):
    texts = ["", None, " it's", "a\x00b\r\n", "<|endoftext|>", "same", "same", "x" * 30_000, "日本語 🙂"]
    docs = spark.createDataFrame([(i, t, "ids") for i, t in enumerate(texts)], "doc_id int, text string, ids string")
    rows = byte_bpe.encoded(docs, ranks)
    assert rows.columns == ["_row", "ids"]
    got = rows.select("_row.doc_id", "ids", byte_bpe.decoder(ranks)("ids").alias("raw"), byte_bpe.little_endian("ids").alias("le")).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.ids == library.encode_ordinary(text)
        assert bytes(r.raw) == text.encode() and bytes(r.le) == struct.pack(f"<{len(r.ids)}I", *r.ids)
    assert byte_bpe.encoded(docs.limit(0), ranks).count() == 0
    odd = spark.createDataFrame([([11, 220],), (None,), ([],)], "ids array<int>")
    back = odd.select(byte_bpe.decoder(ranks)("ids").alias("raw"), byte_bpe.little_endian("ids").alias("le")).collect()
    assert [r.raw and bytes(r.raw) for r in back] == [b", ", None, b""] and back[1].le is None and bytes(back[2].le) == b""


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op12_byte_bpe"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text)
        row = got[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
