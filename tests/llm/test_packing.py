"""Packing against the tokenizer on whole texts."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spark_triples.llm import packing
from tests.llm.helpers import documents, words

LETTERS = " \n\t\x0b\x1c\x85\xa0 　​﻿\x00aAzZ19'!?.,<|>éÉßĳŉİſœŒκΣς中ﬁ̧́ᅡᄀ²"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))


@pytest.fixture(scope="module")
def word_tokens():
    return packing.WordTokens(packing.TOKENIZER)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*LETTERS, "'ll", "<|endoftext|>", "the", "The"]), max_size=25))
def test_word_tokens_equal_the_tokenizer(tokenizer, word_tokens, parts):
    text = "".join(parts)
    plain = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(word_tokens([text])[0], "<u2").tolist() == plain


def check(spark, tokenizer, frame, texts, length):
    """Every id lies in one piece; pieces are gapless; sequences need no padding."""
    found = packing.pack(frame, length=length, with_ids=True).collect()
    expected = []
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        expected.append((doc_id, tuple(ids)))
    by_document = {}
    for r in found:
        by_document.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    got = []
    for (doc_id, n), pieces in by_document.items():
        copies = {}
        for r in sorted(pieces, key=lambda r: (r["start"], r["sequence_id"], r["offset"])):
            copies.setdefault(r["start"], []).append(r)
        total = b"".join(b"".join(r["ids"] for r in copies[s][:1]) for s in sorted(copies))
        if len(copies[0]) == 1:
            got.append((doc_id, tuple(np.frombuffer(total, "<u4").tolist())))
        else:  # repeated rows may be cut at different places
            assert sum(len(r["ids"]) for r in pieces) == 4 * n * len(copies[0])
            got += [(doc_id, None)] * len(copies[0])
    wanted = [(d, None if (d, None) in got else ids) for d, ids in expected]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length and at & (at - 1) == 0
    assert sorted(sequences) == list(range(len(sequences)))


def test_pack(spark, tokenizer):
    rng = random.Random(1)
    texts = [" ".join(words(rng, rng.randrange(1, 90))) for _ in range(60)]
    pairs = [*enumerate(texts), (60, None), (61, ""), (None, "no id"), (62, "x " * 3000)]
    check(spark, tokenizer, documents(spark, pairs), pairs, 64)


def test_repeated_rows_and_one_key(spark, tokenizer):
    pairs = [(7, "same text here")] * 40 + [(None, None)] * 20 + [(8, "other")]
    check(spark, tokenizer, documents(spark, pairs), pairs, 16)


def test_empty_table_and_clashing_columns(spark, tokenizer):
    from pyspark.sql import functions as F

    empty = documents(spark, [])
    assert packing.pack(empty).count() == 0
    clash = documents(spark, ["a b", "c"]).withColumns(
        {c: F.lit(9) for c in ("ids", "n", "key", "row", "part", "before", "base", "begin")}
    )
    check(spark, tokenizer, clash, [(0, "a b"), (1, "c")], 16)


def test_hilbert_curve_steps_to_neighbours():
    side = np.arange(16)
    points = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    keys = packing.hilbert_key(points, 4)
    assert sorted(keys.tolist()) == list(range(16**3))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours(spark):
    rng = random.Random(2)
    a, b = ([f"{x}{i}" for i in range(50)] for x in ("red", "blue"))
    texts = [" ".join(rng.choices(v, k=40)) for _ in range(30) for v in (a, b)]
    found = packing.pack(documents(spark, texts)).filter("start = 0")
    order = [r[0] % 2 for r in found.orderBy("sequence_id", "offset").collect()]
    changes = sum(x != y for x, y in zip(order, order[1:], strict=False))
    assert changes < 15  # at random it would be about 30


def test_cuts():
    assert packing.cuts(4096 * 2 + 5, 4096) == (8192, [8192, 8196])
    assert packing.cuts(0, 4096) == (0, [])
