"""Quality rules against plain counting."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_triples.llm import quality
from tests.llm.helpers import documents, words


def plain(text):
    found = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    covered = {k + s for k in range(len(found) - 2) if windows[tuple(found[k : k + 3])] > 1 for s in range(3)}
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:k] for k, x in enumerate(lines)),
        len(covered),
        len(lines),
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\x1c\xa0é", max_size=60))
def test_count(text):
    assert quality.count(text) == plain(text)


def test_hosts_decide_soft_rules(spark):
    rng = random.Random(3)
    clean = lambda: " ".join(words(rng, 80))
    noisy = lambda: " ".join(w + "###" for w in words(rng, 80))
    texts = [clean() for _ in range(299)] + [noisy()] + [noisy() for _ in range(30)] + [clean() for _ in range(70)]
    texts += ["too short", None, "", "x " * 100]
    hosts = ["good"] * 300 + ["bad"] * 100 + ["good", None, None, "good"]
    docs = documents(spark, texts, source=hosts)
    measured = quality.measure(docs)
    judged = quality.judge(measured, quality.host_rates(measured))
    got = {r["doc_id"]: (r["_quality_failed"], r["_quality_kept"]) for r in judged.collect()}
    assert all(got[i] == (False, True) for i in range(299))
    assert got[299] == (False, True)  # the one odd document of a good host
    assert all(got[i] == (False, False) for i in range(300, 330))
    assert all(got[i] == (False, True) for i in range(330, 400))
    assert all(got[i] == (True, False) for i in range(400, 404))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 370


def test_repeated_rows_clashes_and_empty_tables(spark):
    docs = documents(spark, [(1, "a b")] * 3).withColumns({c: F.lit(1) for c in ("n_words", "n", "symbols")})
    measured = quality.measure(docs)
    assert quality.judge(measured, quality.host_rates(measured)).count() == 3
    assert quality.keep_good(documents(spark, [])).count() == 0


def test_beta_prior():
    assert quality.beta_prior(None, None, None) == (1.0, 1.0)
    alpha, beta = quality.beta_prior(0.1, 0.01, 0.0)  # all hosts alike: a strong prior
    assert alpha + beta == pytest.approx(1e4)
    alpha, beta = quality.beta_prior(0.5, 0.5, 0.0)  # all or nothing: a weak one
    assert alpha + beta == pytest.approx(1.0)
