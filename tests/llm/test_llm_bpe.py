import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from lanekit.llm import bpe
from lanekit.llm.queries import QUERIES
from llm_helpers import edge_docs, empty_docs

TRICKY = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>c", "日本語 テスト 한국어", "don't I'LL we've he's",
          "x\x1c\x1dy \x85\xa0 z  \n\n\t q", "²³ ½ 12a", "👩‍👩‍👧 é é​‍", "a" * 5000, "ab" * 3000 + "!!!" * 999, " " * 1000 + "x",
          "　 a", "ﬁ ʼn ŉ İ", "﻿x", "͸", "word\n" * 50]


@pytest.fixture(scope="module")
def own():
    with open(bpe.default_path(), "rb") as f:
        return bpe.Bpe(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def random_texts():
    rng = random.Random(1)
    out = ["".join(rng.choices("abcdeéß ñ'’\n\t12²ÀÖ×÷øɏɐƀ日한́\xad!?#*<|>", k=rng.randint(1, 40))) for _ in range(1500)]
    for _ in range(800):
        out.append("".join(chr(rng.choice([rng.randint(0, 0x24F), rng.randint(0, 0x2FFF), rng.randint(0x1F300, 0x1F9FF)]))
                           for _ in range(rng.randint(1, 30))))
    return out


def test_ids_and_texts_match_the_library(spark, own, library):
    texts = TRICKY + random_texts() + [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    found = own.encode(texts)
    wanted = library.encode_batch(texts, add_special_tokens=False)
    for text, ids, ref in zip(texts, found, wanted):
        assert np.frombuffer(ids, "<u4").tolist() == ref.ids, text[:50]
        assert own.decode(ids) == library.decode(ref.ids, skip_special_tokens=False)


def test_cut_sequences_decode_like_the_library(own, library):
    ids = library.encode("日本語 👩‍👩‍👧", add_special_tokens=False).ids
    for i in range(len(ids)):
        part = np.array(ids[i:], "<u4").tobytes()
        assert own.decode(part) == library.decode(ids[i:], skip_special_tokens=False)


def test_only_words_that_fail_are_merged(own, library):
    words = ["the", "hello", "tokenization", "thblewhst", "zzzqqqxx"]
    flat, count = own.proposed([w.encode() for w in words])
    at = 0
    for w, n in zip(words, count):
        ids = flat[at:at + n].tolist()
        at += n
        assert b"".join(own.token[i] for i in ids) == w.encode()
        pairs = [a * len(own.token) + b for a, b in zip(ids, ids[1:])] or [-1 - ids[0]]
        verified = bool(own.compatible(np.unique(np.array(pairs))).all())
        assert verified == (ids == library.encode(w, add_special_tokens=False).ids)


def test_long_words_merge_alike(own):
    rng = random.Random(2)
    for n in (3, 20, 48):
        word = bytes(rng.choices(b"theandionr", k=n))
        assert own.merged([word])[0] == own._merged_long(word)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 100)
    monkeypatch.setattr(bpe, "BATCH_CHARS", 300)
    with open(bpe.default_path(), "rb") as f:
        own = bpe.Bpe(f.read())
    texts = random_texts()[:600]
    assert [np.frombuffer(i, "<u4").tolist() for i in own.encode(texts)] == [
        r.ids for r in library.encode_batch(texts, add_special_tokens=False)]


def test_query_and_edge_rows(spark, library):
    for rows, got in ((spark.read.parquet(f"{SF_SMALL}/documents.parquet"), QUERIES["op7_bpe_round_trip"](spark, SF_SMALL)),
                      (edge_docs(spark), bpe.round_trip(edge_docs(spark)))):
        wanted = []
        for r in rows.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            wanted.append((r.doc_id is None, r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                           hashlib.sha256(text.encode()).hexdigest()))
        assert sorted((r.doc_id is None, *r) for r in got.collect()) == sorted(wanted)
    assert bpe.round_trip(empty_docs(spark)).count() == 0


def test_columns_stay(spark):
    docs = edge_docs(spark)
    rows = bpe.decoded(bpe.encoded(docs, "ids"), "ids", "back")
    assert rows.columns == docs.columns + ["ids", "back"]
    assert all(r.back == (r.text or "") for r in rows.collect())
