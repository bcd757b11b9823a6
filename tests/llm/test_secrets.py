"""Secrets: base spans against plain patterns, and novel strings."""

import base64
import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_triples.llm import secrets
from tests.llm.helpers import documents, words

_WORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
PLAIN = {
    "assign": rf"({_WORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain(text):
    found = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= (8, 16, 32)[k]:
                found.append((m.start(), k, m.end()))
    return sorted(found)


PARTS = ["token", "Secret", "API_KEY", "apikey", "paſſword", "passwd", '"', "'", " ", "  ", ":", "=", "abc12345", "x", "AKIA", "AKIAABCDEFGHIJKL", "0123456789abcdef" * 2, "f", "é", "\n", "_", "K"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_equal_plain_patterns(text):
    assert secrets.base_spans(text) == plain(text)


def test_scan(spark):
    rng = random.Random(5)
    key = base64.b64encode(rng.randbytes(33)).decode().replace("=", "")
    filler = " ".join(words(rng, 60))
    texts = [
        f'{filler} authorization: Bearer {key} {filler}',
        f"{filler} the key configuration_parameter_name is configuration_parameter_name {filler}",
        f"{filler} {key} {filler}",  # not in a sensitive place
        'token = "0123456789abcdef0123456789abcdef"',
        None,
        "",
        "key " * 30_000,
    ]
    docs = documents(spark, texts)
    names = secrets.dictionary(docs)
    found = {r["doc_id"]: r["_secrets"] for r in secrets.scan(docs, names, redact=True).collect()}
    start = texts[0].index(key)
    assert found[0]["spans"] == f"novel:{start}:{start + len(key)}"
    assert key not in found[0]["redacted"]
    assert [found[i]["spans"] for i in (1, 2, 4, 5, 6)] == [""] * 5
    assert found[3]["spans"] == "assign:0:41,hex:9:41"
    for i, text in enumerate(texts):
        expected = ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in plain(text or ""))
        assert found[i]["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest()


def test_redact(spark):
    docs = documents(spark, ['say token: "abcdefgh12" now', "clean", None]).withColumn("spans", F.lit(1))
    found = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert found[0]["text"] == 'say <secret>" now' and found[0]["n_chars"] == len(found[0]["text"])
    assert found[1]["text"] == "clean" and found[2]["text"] is None
    assert secrets.redact(docs).columns == docs.columns
    assert secrets.redact(documents(spark, [])).count() == 0


def test_dictionary_is_bounded_and_counts_all(spark):
    docs = documents(spark, [f"secret key abcdefgh{i:08d}ijkl near_identifier other{i}" for i in range(50)])
    names = secrets.dictionary(docs, entries=2).decode().split()
    assert len(names) == 2 and "near_identifier" in names


def test_whole_sensitive_places_are_measured():
    rng = random.Random(6)
    body = base64.b64encode(rng.randbytes(200)).decode()
    lines = [body[k : k + 64] for k in range(0, len(body), 64)]
    assert len(lines[-1]) < 16
    block = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(lines) + "\n-----END RSA PRIVATE KEY-----"
    for text in (f"so:\n{block}\nthat was it", f"my key\n{body[:64]}\n{body[64:128]}\n{lines[-1]}\nthat was it"):
        clean = secrets.redacted(text, secrets.spans_of(text, b"")[1])
        assert not any(x in clean for x in lines), clean
        assert clean.endswith("that was it")
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", k=40))
    for key in (letters, letters.lower(), *("".join(rng.choices("0123456789", k=k)) for k in (16, 24, 31))):
        for text in (f"{key} is the key", f"the key that you will need to open any of the doors is this one: {key}"):
            start = text.index(key)
            assert secrets.spans_of(text, b"")[1] == [(start, 3, start + len(key))], text
    for text in ("key " + "=" * 40, "key " + "xy" * 20, f"no word\nof that kind {letters}"):
        assert secrets.spans_of(text, b"")[1] == []
