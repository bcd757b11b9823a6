"""Ball trees against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spark_triples.llm import lexical_search as ls
from tests.llm.helpers import documents, words


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in found]


def plain(docs, items, n=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    documents_, all_terms = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (i, c), length in zip(counts, lengths, strict=True):
            score = 0
            for t, times in Counter(terms(text)).items():
                if c[t]:
                    m = 100 - 25 + 25 * length * documents_ // all_terms
                    w = math.floor(1000 * math.log((2 * documents_ + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            scores.append((-score, i is None, i))
        best = sorted(s for s in scores if s[0] < 0)[:n]
        out += [(item_id, k + 1, i, -score) for k, (score, _, i) in enumerate(best)]
    return sorted(out, key=repr)


def got(spark, docs, items):
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score long")
    return sorted(map(tuple, ls.search(documents(spark, docs).repartition(3), frame).collect()), key=repr)


def corpus(rng, n=700):
    docs = [(k, " ".join(words(rng, rng.randrange(1, 60), 200))) for k in range(n)]
    docs += [(2000 + k, docs[5][1]) for k in range(100)]  # equal scores
    docs += [(5000, None), (5001, ""), (5002, "--"), (5003, "W1 w2, w3é 中文 " * 2000), (5004, docs[3][1].upper())]
    return docs


def test_equals_scoring_all(spark):
    rng = random.Random(5)
    docs = corpus(rng)
    items = [(k, " ".join(words(rng, 12, 200))) for k in range(15)]
    items += [(90, docs[5][1]), (91, None), (92, ""), (93, "nowhere"), (94, "w1 W1 w1 中文"), (0, "w7 w8")]
    items[-1] = (95, "w7 w8")
    assert got(spark, docs, items) == plain(docs, items)


def test_blocks_and_small_trees(spark, monkeypatch):
    rng = random.Random(6)
    docs = corpus(rng, 300)
    items = [(k, " ".join(words(rng, 10, 200))) for k in range(12)] + [(50, "w3 " * 400)]
    monkeypatch.setattr(ls.blocks, "__defaults__", (120,))
    monkeypatch.setattr(ls, "TREE_NUMBERS", 900)
    assert got(spark, docs, items) == plain(docs, items)


def test_empty_tables_null_and_repeated_ids(spark):
    assert got(spark, [], [(1, "w1")]) == []
    assert got(spark, [(1, "w1")], []) == []
    assert got(spark, [(1, None), (2, "")], [(1, "w1")]) == []
    docs = [(None, "a b"), (3, "a b"), (3, "a b"), (None, "a b"), (4, "c"), (5, "c")]
    assert got(spark, docs, [(None, "a"), (2, "A b")]) == plain(docs, [(None, "a"), (2, "A b")])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 150), st.integers(2, 12))
def test_bounds_hold(seed, n, width):
    rng = np.random.default_rng(seed)
    rows = (rng.integers(0, 1_000_000, (n, width)) * (rng.random((n, width)) < 0.4)).astype(np.int32)
    rows[n // 2 :] = rows[0]  # a group of copies
    cuts = np.unique(np.concatenate([[0], rng.integers(0, width, 2)]))
    tree = ls.BallTree(rows.copy(), np.arange(n), cuts, leaf=4)
    places = rng.choice(width, min(3, width), replace=False)
    query = (places, rng.integers(1, 30_000, len(places)))
    bounds = tree.bounds([query])[0]
    scores = tree.rows[:, query[0]].astype(np.int64) @ query[1]
    for node, bound in zip(tree.nodes, bounds, strict=True):
        assert scores[node.start : node.stop].max() <= bound
    best: list = []
    tree.search(query, bounds, best, 7)
    every = rows[:, query[0]].astype(np.int64) @ query[1]
    assert best == sorted((-s, k) for k, s in enumerate(every.tolist()) if s > 0)[:7]


def test_subtrees_are_left_out():
    """Documents of one item's terms are passed over by the other's search."""
    rng = random.Random(7)
    block = ls.block_of([b" ".join(b"a%d" % k for k in range(20)), b" ".join(b"b%d" % k for k in range(20))])
    rows = np.zeros((2000, len(block.terms)), np.int32)
    for k in range(2000):
        for t in rng.sample(range(20), 8):
            rows[k, block.terms[b"%s%d" % (b"ab"[k % 2 : k % 2 + 1], t)]] = 400_000
    tree = ls.BallTree(rows, np.arange(2000), block.groups)
    query = (block.places[0], np.full(20, 1000))
    best: list = []
    assert tree.search(query, tree.bounds([query])[0], best) < 1200
    assert len(best) == 20 and all(key % 2 == 0 for _, key in best)
