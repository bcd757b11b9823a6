"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features are the distinct words, pairs of neighbours and pairs with one word between, without
case and outer punctuation, hashed to 2**BITS places. FTRL-proximal keeps a learning rate
per coordinate, and its L1 term leaves most weights at exactly zero, so the model is a short
list of (place, weight) that is broadcast; its size is bounded by 2**BITS.

Training takes labelled rows whose crc32(doc_id as text) mod 4 is not 2, at most TRAIN_ROWS
of them (those with the smallest hash of doc_id: a bounded sample), in order of that hash;
it is the work of one task. Scoring covers every row. ``lang``, ``source``, labels and
doc_id are no inputs of a score.

Cases: null and empty texts score as the bias alone. Labels that are null or name no document are
left out; without any labelled rows the score is that of an untrained model, 0.5. A document
labelled twice counts twice, repeated rows too. Ties of the hash are ordered by label. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triples.llm.common import (
    core_hashes,
    map_batches,
    mix,
    odd_numbers,
    ship,
    table,
    text_or_empty,
)
from spark_triples.session import stage

BITS = 20
#: Labelled rows to learn from, at most, and passes over them.
TRAIN_ROWS, EPOCHS = 20_000, 2
ALPHA, BETA, L1, L2 = 0.15, 1.0, 4.0, 1.0
CUTOFF = 0.3
_M = odd_numbers(4, 8)


def features(text: str) -> np.ndarray:
    """The sorted distinct places of a text's features; place 0 is the bias."""
    h = core_hashes(text)
    parts = [h * _M[0], h[:-1] * _M[1] + h[1:] * _M[2], h[:-2] * _M[1] + h[2:] * _M[3]]
    places = mix(np.concatenate(parts)) >> np.uint64(64 - BITS)
    return np.unique(np.append(places.astype(np.int32), np.int32(0)))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """FTRL-proximal with per-coordinate rates (McMahan et al., 2013) for 0/1 features."""

    def __init__(self) -> None:
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        rate = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] = n + g * g


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(order, toxic, text) of the labelled rows to learn from."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("_id"))
        .withColumn("order", F.xxhash64("_id"))
        .orderBy("order", "toxic")
        .limit(rows)
    )  # at most TRAIN_ROWS rows of three numbers: a fixed bound for the broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("order", "toxic", "text")


def train(examples: DataFrame, epochs: int = EPOCHS, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that are not zero.

    Features are made where the texts are; one task then learns from at most ``rows`` of them (a
    document that is in the table many times may add more, which the limit leaves out). Every
    pass is a copy of the rows: they are sorted by pass and order, on disk where they are
    many, and learnt from batch by batch, so that task keeps the model and one batch.
    """
    ship(examples.sparkSession)

    def featured(columns: dict) -> dict:
        found = [features(t).tobytes() for t in columns["text"]]
        return {"order": columns["order"], "toxic": columns["toxic"], "places": found}

    made = map_batches(examples, featured, "order long, toxic int, places binary")
    made = made.withColumns({"digest": F.xxhash64("places"), "row": F.monotonically_increasing_id()})
    made = stage(made, "toxicity-features")
    order = ("order", "toxic", "digest", "row")
    # at most ``rows`` numbers: a fixed bound for the broadcast
    first = made.select(*order).orderBy(*order).limit(rows).select(F.col("row").alias("_row"))
    chosen = made.join(F.broadcast(first), F.col("row") == F.col("_row"), "left_semi")
    passes = chosen.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    ready = passes.repartition(1).sortWithinPartitions("pass", *order).select("places", "toxic")

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Ftrl()
        for batch in batches:
            for raw, label in zip(batch["places"], batch["toxic"], strict=True):
                model.learn(np.frombuffer(raw, np.int32), label)
        w = model.weights(np.arange(1 << BITS))
        at = np.flatnonzero(w)
        yield pd.DataFrame({"place": at, "weight": w[at]})

    model = ready.mapInPandas(learn, "place long, weight double").toPandas()
    return model["place"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def work(columns: dict) -> dict:
        dense = np.zeros(1 << BITS)
        dense[sent.value[0]] = sent.value[1]
        out = np.array([sigmoid(dense[features(t)].sum()) for t in columns["text"]], float)
        return {
            "doc_id": columns["doc_id"],
            "held_out": columns["held_out"],
            "score": out,
            "predicted": (out >= CUTOFF).astype(np.int32),
        }

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        text_or_empty().alias("text"),
    )
    return map_batches(source, work, "doc_id long, held_out boolean, score double, predicted int")


def op8_ftrl_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, train(sample(docs, labels)))
