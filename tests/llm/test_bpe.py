import os
import random
from functools import cache
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from llm_helpers import awkward, documents
from txrisk.llm import bpe
from txrisk.llm.bpe import decode, encode
from txrisk.llm.queries import op11_byte_bpe

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ODD = "ab c'sSé\n\t  1²Ⅷ中文.,!\x1c\x85​　😀́\x00"


@cache
def plain():
    """The library whose ids are to be matched."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.vocabulary_file()), special_tokens={}
    )


@pytest.fixture(scope="module")
def library():
    return plain()


def own_ids(text):
    encoder = bpe.encoder_of(bpe.vocabulary_file(), bpe.own_pattern())
    return np.frombuffer(encoder.of_text(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(ODD, max_size=80))
def test_ids_are_the_library_s(text):
    assert own_ids(text) == plain().encode_ordinary(text)


@pytest.mark.parametrize("part", [
    "x" * 5000, "ab" * 3000, "".join(random.Random(1).choices("abcde", k=20_000)), " " * 3000, "é" * 2000, "a" * 64, "a" * 65,
])
def test_long_parts(library, part):
    assert own_ids(part) == library.encode_ordinary(part)


def test_both_forms_of_the_tree_agree():
    ranks = bpe.read_ranks(bpe.vocabulary_file())
    pairs, byte_ids = bpe.Pairs(ranks), np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    draw = random.Random(2)
    parts = ["".join(draw.choices("etaoins hrdlu\x00é", k=draw.randint(1, 40))).encode()[:64] for _ in range(500)]
    together = bpe.merged_together(parts, 64, pairs, byte_ids)
    assert [np.frombuffer(p, "<u4").tolist() for p in together] == [bpe.merged(p, ranks) for p in parts]


def test_blocks_do_not_change_ids(library, monkeypatch):
    draw = random.Random(3)
    text = "".join(draw.choices(ODD + "     abcdefgh", k=30_000))
    monkeypatch.setattr(bpe, "BLOCK", 50)
    assert "".join(bpe.blocks(text)) == text and sum(1 for _ in bpe.blocks(text)) > 20
    assert own_ids(text) == library.encode_ordinary(text)


def test_forgetting_does_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for text in ("one two three four five sixxx sevenn", "one two two two niine", "x" * 100 + " one"):
        assert own_ids(text) == library.encode_ordinary(text)


def test_awkward_texts_and_columns(spark, library):
    texts = awkward()
    docs = documents(spark, texts).withColumnsRenamed({"h": "token_ids", "kept": "Decoded"})
    rows, name = decode(encode(docs).withColumnRenamed("doc_id", "DECODED"))
    assert name == "decoded_"
    found = {r["DECODED"]: r for r in rows.collect()}
    assert len(found) == len(texts)
    for number, text in enumerate(texts, 1):
        assert np.frombuffer(found[number]["token_ids"], "<u4").tolist() == library.encode_ordinary(text or "")
        assert bytes(found[number]["decoded_"]) == (text or "").encode()


def test_a_text_of_megabytes(spark):
    text = "Some words of a long text, 12345 of them. " * 100_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows, name = decode(encode(docs))
    row = rows.collect()[0]
    assert bytes(row[name]) == text.encode()


def test_repeated_ids_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    found = encode(docs).collect()
    assert sorted((r.doc_id or 0, len(r.token_ids) // 4) for r in found) == [(0, 0), (0, 1), (1, 2), (1, 2)]
    assert decode(encode(docs.limit(0)))[0].count() == 0
    rows, name = decode(spark.createDataFrame([(None,)], "token_ids binary"))
    assert [bytes(r[name]) for r in rows.collect()] == [b""]


def test_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op11_byte_bpe(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = np.array(library.encode_ordinary(texts[r.doc_id] or ""), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == sha256((texts[r.doc_id] or "").encode()).hexdigest()
