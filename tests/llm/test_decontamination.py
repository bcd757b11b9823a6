"""Benchmark leaks against laying every item over every place."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from spark_triples.llm import decontamination as d
from spark_triples.llm.common import core_hashes
from tests.llm.helpers import documents, words

ITEMS = "item_id long, text string"


def everywhere(text, items):
    """The items whose best stretch at any place reaches the limit."""
    h, found = core_hashes(text or ""), set()
    for item, item_text in items:
        w = core_hashes(item_text or "")
        if len(w) < d.SHORTEST:
            continue
        for first in range(1 - len(w), len(h)):
            a, b = max(0, first), min(len(h), first + len(w))
            agree = h[a:b] == w[a - first : b - first]
            score = best = same = most = 0
            for x in agree:
                score, same = (score + 1, same + 1) if x else (score - d.COST, same)
                if score <= 0:
                    score = same = 0
                if score > best:
                    best, most = score, same
            if most >= min(d.MIN_WORDS, len(w)):
                found.add(item)
    return found


def test_equals_laying_items_everywhere(spark):
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, rng.choice([9, 14, 30, 60])))) for i in range(25)]
    items += [(25, None), (26, ""), (27, "too short"), (28, items[3][1])]
    texts = []
    for k in range(120):
        body = words(rng, rng.randrange(5, 200))
        if k % 2:
            piece = rng.choice(items[:25])[1].upper().split()
            piece = piece[: rng.choice([8, 13, 60])]
            for at in range(rng.randrange(9), len(piece), rng.choice([9, 12, 50])):
                piece[at] = "changed,"
            at = rng.randrange(len(body))
            body[at:at] = [w + rng.choice(["", ".", ","]) for w in piece]
        texts.append(" ".join(body))
    texts += [None, "", items[0][1], items[1][1] + " " + items[1][1], "x " * 60_000]
    docs = documents(spark, texts)
    bench = spark.createDataFrame(items, ITEMS)
    got = {r["doc_id"]: {x[0] for x in r["_leaks"]} for r in d.find_leaks(docs, bench).collect()}
    expected = {i: everywhere(t, items) if i < 124 else set() for i, t in enumerate(texts)}
    assert got == expected
    kept = d.drop_leaked(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, x in expected.items() if not x}


def test_blocks_give_what_one_block_gives(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, 20))) for i in range(30)]
    texts = ["a b " + t + " c" for _, t in items] + ["clean text", items[3][1] + " " + items[4][1] + " " + items[9][1]]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id = 2"))  # a repeated row stays two
    bench = spark.createDataFrame(items, ITEMS)
    whole = {r["doc_id"]: r["_leaks"] for r in d.find_leaks(docs, bench).collect()}
    blocks = list(d._blocks(bench, 1500))
    assert len(blocks) > 1 and sorted(x for b in blocks for x in b) == sorted(items)
    parted = d.find_leaks(docs, bench, 1500)
    assert parted.columns == [*docs.columns, "_leaks"] and parted.count() == docs.count()
    parted = {r["doc_id"]: sorted(r["_leaks"]) for r in parted.collect()}
    assert parted == {k: sorted(v) for k, v in whole.items()} and len(parted[31]) == 3
    assert all(len(whole[i]) == 1 for i in range(30)) and not whole[30]


def test_odd_tables(spark):
    docs = documents(spark, [(1, "a")] * 2 + [(None, None)]).withColumns({c: F.lit(1) for c in ("item_id", "items")})
    none = spark.createDataFrame([], ITEMS)
    assert d.find_leaks(docs, none).count() == 3
    assert d.drop_leaked(documents(spark, []), none).count() == 0


def test_masks_stand_two_exchanged_words():
    h = np.arange(1, 31, dtype=np.uint64)
    index = d.Index([(5, h)])
    for a in range(30):
        for b in range(a + 4, 30):
            other = h.copy()
            other[[a, b]] = 99
            assert d.leaks(other, index), (a, b)


def test_every_stretch_that_counts_holds_a_mask():
    """All patterns of agreements up to the twelfth whose every beginning has a positive score."""
    found, grow = [], [("", 0)]
    while grow:
        made, score = grow.pop()
        if made.count("1") == d.MIN_WORDS:
            found.append(made)
            continue
        grow.append((made + "1", score + 1))
        if score > d.COST:
            grow.append((made + "0", score - d.COST))
    assert len(found) == 728
    for pattern in found:
        item = np.arange(1, len(pattern) + 1, dtype=np.uint64)
        other = np.where([c == "1" for c in pattern], item, np.uint64(99))
        index = d.Index([(5, item)])
        assert (0, 0) in index.hits(other), pattern


def test_short_items_match_as_a_whole():
    for n in range(1, 12):
        item = np.arange(1, n + 1, dtype=np.uint64)
        index = d.Index([(5, item), (6, np.zeros(0, np.uint64))])
        rest = np.full(3, 99, np.uint64)
        assert d.leaks(np.concatenate([rest, item, rest]), index) == [[5, 3, 3 + n, n]]
        other = item.copy()
        other[n // 2] = 98
        assert d.leaks(np.concatenate([rest, other, rest]), index) == []


def test_short_copies_with_changed_words_are_all_found():
    for n in (15, 16):
        item = np.arange(1, n + 1, dtype=np.uint64)
        index = d.Index([(5, item)])
        for changed in (c for k in range(5) for c in combinations(range(n), k)):
            other = item.copy()
            other[list(changed)] = 99
            a, b = d.best_stretch(other == item)
            counts = int((other == item)[a:b].sum()) >= d.MIN_WORDS
            assert bool(d.leaks(other, index)) == counts, changed


def test_equal_items_are_laid_once():
    """Copies of an item, also in other case and punctuation, are one in the index; each id is reported."""
    item = " ".join(words(random.Random(2), 40))
    copies = [(k, core_hashes(item.upper() if k % 2 else item + ".")) for k in range(3_000)]
    index = d.Index([*copies, (None, copies[0][1]), (5_000, core_hashes("only one more here"))])
    assert len(index.items) == 2
    assert len(index.keys) == len(d.Index([copies[0], (5_000, core_hashes("only one more here"))]).keys)
    found = d.leaks(core_hashes("x y " + item + " z"), index)
    assert [x[0] for x in found] == [*range(3_000), None]
    assert {tuple(x[1:]) for x in found} == {(2, 42, 40)}


def test_one_word_over_and_over():
    h = core_hashes("same " * 2_000)
    found = d.leaks(h, d.Index([(1, core_hashes("same " * 50))]))
    assert max(x[3] for x in found) == 50
    assert {x[0] for x in found} == {1}


def all_diagonals(h, index):
    """Places of items by every pair of equal seeds."""
    return {
        (number, p - q)
        for number, (_, w) in enumerate(index.items)
        for mask in (d.MASKS if len(w) >= len(d.MASKS[0]) else ["1" * len(w)])
        for p, a in enumerate(d.seeds(h, mask).tolist())
        for q, b in enumerate(d.seeds(w, mask).tolist())
        if a == b
    }


def test_runs_of_hits_are_looked_at_once():
    rng = np.random.default_rng(4)
    for period in (1, 2, 3, 7, 200):
        pattern = rng.integers(1, 5, period).astype(np.uint64)
        items = [(k, np.resize(np.roll(pattern, k), n)) for k, n in enumerate((30, 12, 5, 90))]
        items.append((9, rng.integers(1, 3, 60).astype(np.uint64)))
        index = d.Index(items)
        for h in (np.resize(pattern, 150), rng.integers(1, 3, 150).astype(np.uint64), items[4][1]):
            assert index.hits(h) == all_diagonals(h, index), period


def test_repeated_words_cost_the_sum_of_both_lengths():
    """The pairs that are laid: 60,000 words against 5,000 have 300 million pairs of equal seeds."""
    index = d.Index([(1, np.full(5_000, 7, np.uint64))])
    assert len(index.hits(np.full(60_000, 7, np.uint64))) < 65_000
