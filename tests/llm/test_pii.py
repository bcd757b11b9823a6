"""Personal data: base spans against plain patterns, and what contexts discover."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from spark_triples.llm import pii
from spark_triples.session import stage
from tests.llm.helpers import documents

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return [
        f"{k}:{m.start()}:{m.end()}"
        for k, p in PLAIN.items()
        for m in re.finditer(p, text or "")
        if valid(k, m[0])
    ]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(4)
    parts = [
        "a@b.c", "_", "@", ".", "x", "-", "+", " ", "1", "22", "255", "256", "0001", "+1 (743) 555-3824", "é", "😀",
        "4111 1111 1111 1111", "4111111111111112", "(", ")", "\n", "10.0.0.1", "a.b@c-d.e_f@g.h", "1234567890123",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(1500)]
    texts += [None, "", "a@b" + ".c" * 9000, "1" * 50_000, "+" + "1 " * 9000, "1.2.3.4" * 500]
    found = {r["doc_id"]: r for r in pii.extract(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        expected, got = plain(text), found[i]
        assert got["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest(), repr(text)[:300]
        assert [got[f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k) for s in expected) for k in PLAIN]
        assert [s for s in got["spans"].split(",") if s and not s.startswith("id:")] == expected


def test_contexts_discover_other_identifiers(spark):
    texts = [f"please write to my address user{i}@mail.example for more" for i in range(20)]
    texts += ["please write to my address @handle77 for more", "the year was 1984 and room 12b"]
    texts += ["they came in 1999 by train"] * 30
    found = {r["doc_id"]: r for r in pii.extract(documents(spark, texts)).collect()}
    start = texts[20].index("@handle77")
    assert found[20]["spans"] == f"id:{start}:{start + 9}"
    assert sum(r["n_id"] for r in found.values()) == 1


def test_letters_alone_are_found_and_plain_words_count(spark):
    texts = [f"contact handle user{i}@mail.example" for i in range(3)] + ["the contact handle dmitri"]
    texts += [f"in room user{i}@mail.example" for i in range(3)] + [f"in room word{chr(97 + i % 26)}" for i in range(240)]
    texts += ["in room 12"]
    got = [r["spans"] for r in pii.extract(documents(spark, texts)).orderBy("doc_id").collect()]
    assert got[3] == "id:19:25"
    assert not any("id:" in s for s in got[4:])


def test_contexts_are_whole_words(spark):
    long = "w" * 100
    texts = [f"{long} user{i}@mail.example" for i in range(5)] + ["w" * 80 + " 77"]
    assert sum(r["n_id"] for r in pii.extract(documents(spark, texts)).collect()) == 0


def plain_contexts(texts):
    """The contexts of a corpus, counted word by word."""
    seeds, places = {}, {}
    for text in texts:
        words = [re.sub("[0-9]", "0", w.lower()) for w in text.split()]
        for k in range(1, len(words)):
            for p in {words[k - 1], " ".join(words[max(k - 2, 0) : k])}:
                places[p] = places.get(p, 0) + 1
        for k, p in PLAIN.items():
            for m in re.finditer(p, text):
                if not valid(k, m[0]):
                    continue
                before = [re.sub("[0-9]", "0", w.lower()) for w in text[: m.start()].split()]
                for p_ in {" ".join(before[-1:]), " ".join(before[-2:])} - {""}:
                    seeds.setdefault(p_, []).append(m[0].lower())
    return {p: set(v) for p, v in seeds.items() if len(set(v)) >= pii.SEEDS and len(v) >= pii.SHARE * places[p]}


def plain_ids(texts):
    """Spans of discovered values, over dictionaries."""
    chosen = plain_contexts(texts)
    at, edges = [], {p: dict.fromkeys(v, True) for p, v in chosen.items()}
    for i, text in enumerate(texts):
        spans = [tuple(map(int, s.split(":")[1:])) for s in plain(text)]
        words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"\S+", text)]
        norm = [re.sub("[0-9]", "0", w.lower()) for *_, w in words]
        for k in range(1, len(words)):
            s, e, w = words[k]
            if any(a < e and b > s for a, b in spans):
                continue
            for p in {norm[k - 1], " ".join(norm[max(k - 2, 0) : k])} & set(chosen):
                at.append((i, s, e, w.lower(), p))
                edges[p].setdefault(w.lower(), False)
    known = {}
    for found in edges.values():
        for v, seed in found.items():
            known[v] = known.get(v, False) or seed
    score = {v: float(seed) for v, seed in known.items()}
    made = {}
    for _ in range(pii.ROUNDS):
        made = {p: (sum(score[v] for v in f) / len(f), sum(score[v] >= pii.VALUE for v in f)) for p, f in edges.items()}
        doubt = dict.fromkeys(known, 1.0)
        for p, f in edges.items():
            if made[p][1] >= pii.SEEDS:
                for v in f:
                    doubt[v] *= 1 - min(made[p][0], 0.999)
        score = {v: 1.0 if seed else 1 - doubt[v] for v, seed in known.items()}
    strong = {p for p, (c, n) in made.items() if c >= pii.PATTERN and n >= pii.SEEDS}
    return {(i, s, e) for i, s, e, v, p in at if p in strong and score[v] >= pii.VALUE}


def test_ids_equal_plain_counting(spark):
    rng = random.Random(12)
    leads = ["mail to", "call", "my address", "host", "x", "login as"]
    values = [f"u{i}@m.example" for i in range(8)] + [f"10.0.0.{i}" for i in range(6)] + ["dmitri", "anna", "n0b0dy", "plain", "word"]
    texts = []
    for _ in range(300):
        lead = rng.choice(leads)
        pick = values[:14] if lead != "x" and rng.random() < 0.85 else values
        texts.append(" ".join([*rng.choices(["a", "b", "c9"], k=rng.randrange(3)), lead, rng.choice(pick), rng.choice(["end", "or", "x"]), rng.choice(values)]))
    found = pii.extract(documents(spark, texts)).collect()
    got = {(r["doc_id"], *map(int, s.split(":")[1:])) for r in found for s in r["spans"].split(",") if s.startswith("id:")}
    assert got == plain_ids(texts)
    assert got


def test_very_many_matches_in_a_text(spark):
    rng = random.Random(5)
    parts = [f"u{i}@mail.example" for i in range(16_000)] + [f"n{i}" for i in range(16_000)]
    rng.shuffle(parts)
    got = pii.extract(documents(spark, [" ".join(parts)])).collect()
    assert got[0]["n_email"] == 16_000


def test_repeats_clashes_and_empty_tables(spark):
    assert pii.extract(documents(spark, [])).count() == 0
    docs = documents(spark, [(1, "a@b.cd")] * 3 + [(None, None)]).withColumns(
        {c: F.lit(1) for c in ("email", "row", "candidates", "_base", "new", "value")}
    )
    got = pii.extract(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_email"], r["spans"]) for r in got) == [(0, 0, "")] + [(1, 1, "email:0:6")] * 3


def test_no_python_in_the_plans(spark):
    """The main path has DataFrame functions only."""
    docs = documents(spark, ["a@b.cd"])
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = source.withColumn("row", F.lit(1))
    found = pii.base_spans(rows)
    chosen = stage(spark.createDataFrame([(1,)], "pattern long"), "chosen")
    for frame in (found, pii.seed_rows(found), pii.followed(rows), pii.candidates(rows, found, chosen)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
