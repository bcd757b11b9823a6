"""Importance resampling against plain counting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_triples.llm import resampling
from tests.llm.helpers import documents, words


def features(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(w), [" ".join(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(docs, target, percent=5):
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in s
    }
    scores = []
    for i, text in docs:
        n, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scores.append((i, n, len(found), weight, score))
    enough = sorted((r for r in scores if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = enough[: percent * len(enough) // 100]
    ranks = {id(r): k + 1 for k, r in enumerate(drawn)}
    return [(r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in scores]


def ordered(found):
    return sorted(map(tuple, found), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 é-\x00中_", max_size=40), max_size=4))
def test_buckets(texts):
    n, found, owner = resampling.buckets_of([t.encode() for t in texts])
    assert n.tolist() == [features(t)[0] for t in texts]
    for k, text in enumerate(texts):
        assert Counter(found[owner == k].tolist()) == Counter(map(bucket, features(text)[1]))


def test_long_words():
    text = " ".join(["x" * 255, "y" * 256, "é" * 5000, "z", "w" * 70_001])
    found = resampling.buckets_of([text.encode()])[1]
    assert Counter(found.tolist()) == Counter(map(bucket, features(text)[1]))


def test_equals_plain_counting(spark):
    rng = random.Random(4)
    docs = [(k, " ".join(words(rng, rng.randrange(1, 120), 300))) for k in range(600)]
    docs += [(1000, None), (1001, ""), (1002, "?!"), (1003, "É " * 3000), (None, "w1 " * 40)]
    docs += [(2000 + k, docs[0][1]) for k in range(50)]
    target = [" ".join(f"w{rng.randrange(100)}" for _ in range(50)) for _ in range(20)] + [None, ""]
    items = spark.createDataFrame([(k, t, "x") for k, t in enumerate(target)], "item_id long, text string, score string")
    got = resampling.resample(documents(spark, docs).repartition(4), items, percent=20)
    assert ordered(got.collect()) == ordered(plain(docs, target, 20))


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "word " * 19)], [(1, "word " * 20)]])
@pytest.mark.parametrize("target", [[], ["word other word"]])
def test_few(spark, docs, target):
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(documents(spark, docs), items, percent=100)
    assert ordered(got.collect()) == ordered(plain(docs, target, 100))


def test_equal_rows(spark):
    """A third of all rows is one row: as many of them are drawn as are needed."""
    target = ["same " * 3000]
    docs = [(7, "same " * 30)] * 200 + [(k + 100, f"w{k} x{k} " * 60) for k in range(400)]
    got = resampling.resample(documents(spark, docs).repartition(7), documents(spark, target), percent=25).collect()
    assert ordered(got) == ordered(plain(docs, target, 25))
    assert [r["doc_id"] for r in got if r["rank"] is not None] == [7] * 150


def test_ties_go_to_the_smaller_id(spark):
    rows = [(k, 30, 0, 0, 5 if k % 3 else 9, (k * 37) % 101, k) for k in range(101)]
    names = "doc_id long, n_words long, n_features long, weight long, score long, key long, row long"
    scores = spark.createDataFrame(rows, names).repartition(5)
    for n in (0, 1, 33, 34, 35, 70, 100, 101):
        got = {r["row"] for r in scores.filter(resampling.is_drawn(scores, n)).collect()}
        best = sorted(rows, key=lambda r: (-r[4], r[5], r[6]))[:n]
        assert got == {r[6] for r in best}
        ranks = resampling.ranked(scores.filter(resampling.is_drawn(scores, n)), n).collect()
        assert {r["row"]: r["rank"] for r in ranks} == {r[6]: k + 1 for k, r in enumerate(best)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(1 << 40), 1 << 40) | st.integers(-3, 3), min_size=1, max_size=40), st.data())
def test_nth_smallest(spark, values, data):
    n = data.draw(st.integers(1, len(values)))
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    found, below = resampling.nth_smallest(frame, F.col("v"), n)
    assert found == sorted(values)[n - 1]
    assert below == sum(v < found for v in values)


def test_gains_are_whole_numbers():
    gain = resampling.gains(np.array([0, 5, 10]), np.array([3, 0, 1]))
    assert gain.dtype == np.int64
    assert gain.tolist() == [math.floor(1000 * math.log((t + 1) * 18 / ((s + 1) * 7))) for s, t in ((0, 3), (5, 0), (10, 1))]
