"""Near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_triples.llm import near_dedup
from spark_triples.llm.components import components
from tests.llm.helpers import documents, words


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if 0 < len(found) < 5:
        return {tuple(found)}
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}


def all_pairs(pairs, percent):
    """The component of every row: (doc_id, set size, smallest doc_id)."""
    sets = [shingle_set(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(pairs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(
        ((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(pairs)),
        key=repr,
    )


def corpus(seed):
    """Texts with copies around the limit, chains of copies, and a passage that many share."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 60))
    texts = []
    for _ in range(25):
        base = words(rng, rng.choice([5, 8, 20, 60, 150]))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            base = list(base)
            for _ in range(rng.randrange(1, 4)):
                base[rng.randrange(len(base))] = rng.choice(["new", "words"])
            texts.append(" ".join(base).upper() if rng.random() < 0.3 else "\t".join(base))
    group = words(rng, 120)
    for _ in range(40):  # a large group of near copies
        copy = list(group)
        copy[rng.randrange(120)] = f"n{rng.random()}"
        copy[rng.randrange(120)] = f"n{rng.random()}"
        texts.append(" ".join(copy))
    texts += [passage + " " + " ".join(words(rng, rng.choice([5, 40, 200]))) for _ in range(30)]
    texts += [texts[0]] * 5 + [None, "", " \n", "one", "One", "two words", "a b c d e"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "percent"), [(1, 85), (2, 80)])
def test_equals_all_pairs(spark, seed, percent):
    pairs = corpus(seed)
    found = near_dedup.link(documents(spark, pairs), percent)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=repr)
    assert got == all_pairs(pairs, percent)


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g"
    pairs = [(3, text), (3, text), (None, text), (None, "x y"), (None, None), (5, text + " "), (6, None)]
    docs = documents(spark, pairs)
    got = sorted(
        ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.link(docs).collect()), key=repr
    )
    assert got == all_pairs(pairs, 80)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.filter("doc_id is not null").collect()) == [(3, text), (6, None)]
    assert kept.filter("doc_id is null").count() == 2


def test_empty_table_and_clashing_columns(spark):
    assert near_dedup.link(documents(spark, [])).count() == 0
    assert near_dedup.keep_one(documents(spark, [])).count() == 0
    names = ("key", "row", "n", "s1", "s2", "signature", "cls", "root", "post")
    clash = documents(spark, ["a b c d e f"] * 3).withColumns({c: F.lit(1) for c in names})
    assert near_dedup.keep_one(clash).collect()[0]["doc_id"] == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    expected = {(i, 0) for i in range(1, 61)} | {(150, 100), (200, 100)}
    assert {tuple(r) for r in found.collect()} == expected


def test_least_agreement_misses_almost_nothing():
    for percent in (50, 80, 85, 95):
        t = near_dedup.least_agreement(percent)
        assert 1 <= t < percent * near_dedup.K / 100


def test_bit_signatures_differ_as_sets_do():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for similarity in (0.5, 0.7, 0.85, 1.0):
        kept = int(2 * len(base) * similarity / (1 + similarity))
        new = rng.integers(0, 2**63, len(base) - kept).astype(np.uint64)
        a, b = map(near_dedup.bit_signature, (base, np.concatenate([base[:kept], new])))
        unequal = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))
        expected = (1 - similarity) / 2 * near_dedup.BITS
        assert abs(unequal - expected) <= 6 * expected**0.5


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_most_unequal_bits(percent):
    """A pair at the limit passes almost always, one far below never."""
    most = near_dedup.most_unequal_bits(percent)
    rng = np.random.default_rng(2)
    p = (1 - percent / 100) / 2
    assert (rng.binomial(near_dedup.BITS, p, 100_000) <= most).all()
    assert (rng.binomial(near_dedup.BITS, p + 0.1, 1000) > most).all()


@pytest.mark.parametrize("percent", [80, 85])
def test_few_pairs_below_the_limit_are_compared(spark, monkeypatch, percent):
    """In a large group around the limit, signatures leave little but links to full comparison."""
    rng = random.Random(7)
    base = words(rng, 500)
    texts = []
    for number in range(120):
        copy = list(base)
        for at in rng.sample(range(500), rng.randrange(5, 11)):
            copy[at] = f"n{number}x{at}"
        texts.append(" ".join(copy))
    seen, stage = [], near_dedup.stage

    def noted(df, name, *more):
        written = stage(df, name, *more)
        if name == "near-pairs":
            seen.extend((r["a"], r["b"]) for r in written.collect())
        return written

    monkeypatch.setattr(near_dedup, "stage", noted)
    pairs = list(enumerate(texts))
    found = near_dedup.link(documents(spark, pairs).coalesce(1), percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == all_pairs(pairs, percent)
    sets = {r["row"]: shingle_set(texts[r["doc_id"]]) for r in found}
    alike = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in seen]
    far = sum(x < percent / 100 - 0.05 for x in alike)
    assert far <= 0.1 * 120 * 119 / 2
