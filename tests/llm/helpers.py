"""Small tables with the odd rows every operator must stand."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def documents(spark, texts, **columns):
    """Documents with ids from 0, or (doc_id, text) pairs; other columns by name."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    source = columns.get("source", ["s"] * len(pairs))
    rows = [
        (i, t, "en", s, None if t is None else len(t), "x")
        for (i, t), s in zip(pairs, source, strict=True)
    ]
    return spark.createDataFrame(rows, DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
