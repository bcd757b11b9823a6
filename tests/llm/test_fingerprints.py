"""Winnowing against plain hashing of every window."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spark_triples.llm import fingerprints as fp
from tests.llm.helpers import documents, rows


def plain(text, gram=fp.GRAM, window=fp.WINDOW):
    """[(hash, place)] by the definition: one gram and one window at a time."""
    gram = min(gram, len(text))
    if not gram:
        return []
    hashes = []
    for k in range(len(text) - gram + 1):
        h = 0
        for c in text[k : k + gram]:
            h = (h * fp.BASE + ord(c) + 1) % fp.PRIME
        hashes.append(h)
    window = min(window, len(hashes))
    chosen = []
    for k in range(len(hashes) - window + 1):
        least = min(hashes[k : k + window])
        at = max(i for i in range(k, k + window) if hashes[i] == least)
        if not chosen or chosen[-1][1] != at:
            chosen.append((least, at))
    return chosen


def likeness(a, b):
    a, b = {h for h, _ in plain(a)}, {h for h, _ in plain(b)}
    return len(a & b) / len(a | b) if a | b else 1.0


def pairs(fingerprint):
    hashes, places = fp.parse(fingerprint)
    return list(zip(hashes.tolist(), places.tolist(), strict=True))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\U0001f600\n\x00", max_size=150), st.integers(1, 25), st.integers(1, 40))
def test_winnow(text, gram, window):
    hashes, places = fp.winnow(text, gram, window)
    assert list(zip(hashes.tolist(), places.tolist(), strict=True)) == plain(text, gram, window)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abc ", min_size=50, max_size=60), st.text(max_size=90), st.text(max_size=90))
def test_shared_passages_are_seen(shared, before, after):
    one, other = before + shared + after, after + shared + before
    marks = pairs(fp.written(*fp.winnow(one))), pairs(fp.written(*fp.winnow(other)))
    inside = [
        {h for h, at in m if len(first) <= at <= len(first) + len(shared) - fp.GRAM}
        for m, first in zip(marks, (before, after), strict=True)
    ]
    assert inside[0] & inside[1]


def test_long_texts_in_parts(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abcde ") for _ in range(5000)) + "a" * 3000
    whole = fp.winnow(text)
    assert list(zip(*map(np.ndarray.tolist, whole), strict=True)) == plain(text)
    monkeypatch.setattr(fp, "PART", 97)
    parts = fp.winnow(text)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def expected(pairs_):
    texts = [(i, t or "") for i, t in pairs_]
    texts.sort(key=lambda p: (p[0] is None, -(p[0] or 0)))
    out = []
    for k, (i, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append(
            (
                i,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                plain(text),
                plain(edited),
                likeness(text, edited),
                likeness(text, following),
            )
        )
    return sorted(out, key=repr)


def got(docs):
    found = fp.next_likeness(docs).collect()
    return sorted(
        ((r[0], r[1], r[2], pairs(r[3]), pairs(r[4]), r[5], r[6]) for r in found), key=repr
    )


def test_neighbours(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ü") for _ in range(rng.randrange(300))) for _ in range(60)]
    texts += [None, "", "x", "short", texts[0], texts[0], "é" * 400, "long " * 9000]
    ids = rng.sample(range(-1000, 1000), len(texts) - 1) + [None]
    ids[3], ids[4] = (1 << 63) - 1, -(1 << 63)
    cases = list(zip(ids, texts, strict=True))
    docs = documents(spark, cases).repartition(5)
    # a shuffle may order rows otherwise when it is read again: files do not
    from spark_triples.session import stage

    assert got(stage(docs, "documents")) == expected(cases)


@pytest.mark.parametrize("cases", [[], [(7, "alone " * 30)], [(7, None)], [(1, ""), (2, None)]])
def test_few(spark, cases):
    assert got(documents(spark, cases)) == expected(cases)


def test_repeated_rows_and_ids(spark):
    same = [(5, "the same text, longer than a gram " * 5)] * 400
    others = [(5, f"other text {k} of this id, also longer than a gram") for k in range(20)]
    docs = documents(spark, same + others + [(1, "last " * 20)])
    found = fp.next_likeness(docs).collect()
    assert len(found) == 421
    alike = [r["near_next"] for r in found if r["fingerprint"] == fp.written(*fp.winnow(same[0][1]))]
    assert len(alike) == 400 and sum(x == 1.0 for x in alike) == 399  # all but the last of them


def test_fingerprints_alone(spark):
    texts = ["a passage that is long enough to be marked somewhere " * 3, None, ""]
    found = rows(fp.fingerprints(documents(spark, texts).withColumnRenamed("extra", "fingerprint")))
    assert [(i, n, pairs(f)) for i, n, f in found] == [(k, len(t or ""), plain(t or "")) for k, t in enumerate(texts)]
