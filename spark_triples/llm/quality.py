"""Quality rules of documents, seen together with the rules their host breaks.

Base rules look at a document alone: too few words, or too many words in repeated
three-word windows. Two softer rules (many symbols, many repeated lines) also hit good
documents, such as tables or code, so the host decides: rule failures are counted per
host, each host's rate is shrunk towards the others by a beta prior fitted to all hosts,
and where the shrunk rate stays above a limit the host has lost the benefit of the doubt:
its documents that break the rule go. A host with few documents is near the prior.

Cases: a null or empty text has no words and fails the base rules. Null hosts and
empty ones are one host. Repeated rows are judged one by one. An empty table gives an empty result. Extra
columns are carried by ``judge``; the names that begin with ``_quality`` are reserved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triples.llm.common import (
    SPACES,
    mix,
    odd_numbers,
    ship,
    table,
    text_or_empty,
    word_hashes,
    words_of,
)
from spark_triples.session import stage

MIN_WORDS = 50
REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Soft rules: symbols per 100 characters of words, repeated per 100 lines.
SYMBOL_PERCENT = 8
DUP_LINE_PERCENT = 30
#: A host whose shrunk rate of a soft rule is above this loses the documents that break it.
HOST_LIMIT = 0.02

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SOFT = ("symbols", "lines")
_WINDOW = odd_numbers(3, 31)


def count(text: str) -> tuple[int, ...]:
    """The numbers of COUNTS of one text."""
    words = words_of(text)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeated = 0
    if len(words) > 3:
        h = word_hashes(words)
        windows = mix(h[:-2] * _WINDOW[0] + h[1:-1] * _WINDOW[1] + h[2:] * _WINDOW[2])
        _, which, often = np.unique(windows, return_inverse=True, return_counts=True)
        twice = often[which] > 1
        covered = np.zeros(len(words), bool)
        for shift in range(3):
            covered[shift : shift + len(twice)] |= twice
        repeated = int(covered.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_quality`` of COUNTS."""
    ship(docs.sparkSession)
    shape = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    @F.pandas_udf(shape)
    def counted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([count(t) for t in texts], columns=list(COUNTS))

    # so declared, the counts are made once, and not again for every filter that reads them
    return docs.withColumn("_quality", counted.asNondeterministic()(text_or_empty()))


def base_failed(q: str = "_quality") -> Column:
    n, repeated = F.col(f"{q}.n_words"), F.col(f"{q}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > REPEATED_PERCENT * n)


def soft_failed(q: str = "_quality") -> dict[str, Column]:
    return {
        "symbols": 100 * F.col(f"{q}.n_symbols") > SYMBOL_PERCENT * F.col(f"{q}.word_chars"),
        "lines": 100 * F.col(f"{q}.n_dup_lines") > DUP_LINE_PERCENT * F.col(f"{q}.n_lines"),
    }


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """(_quality_host, _quality_rates): the shrunk failure rate of each soft rule per host.

    The prior is a beta distribution with the mean and the variance of the hosts' rates (by
    moments, sampling variance taken off). Failures are summed before the shuffle.
    """
    failed = soft_failed()
    hosts = measured.groupBy(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_quality_host")).agg(
        F.count("*").alias("n"),
        *[F.sum(failed[r].cast("long")).alias(r) for r in SOFT],
    )
    hosts = stage(hosts, "quality-hosts")
    moments = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("n"),
        F.avg(1 / F.col("n")).alias("inverse"),
        *[F.sum(r).alias(r) for r in SOFT],
        *[F.avg((F.col(r) / F.col("n")) ** 2).alias(f"{r}_square") for r in SOFT],
        *[F.avg(F.col(r) / F.col("n")).alias(f"{r}_mean") for r in SOFT],
    ).first()
    rates = []
    for r in SOFT:
        alpha, beta = beta_prior(
            moments[f"{r}_mean"], moments[f"{r}_square"], moments["inverse"]
        )
        rates.append(((F.col(r) + alpha) / (F.col("n") + alpha + beta)).alias(r))
    return hosts.select("_quality_host", F.struct(*rates).alias("_quality_rates"))


def beta_prior(mean: float | None, square: float | None, inverse: float | None) -> tuple[float, float]:
    """Alpha and beta from the hosts' mean rate, mean squared rate, and mean of 1/n."""
    if mean is None:
        return 1.0, 1.0
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    noise = mean * (1 - mean) * inverse
    spread = max(square - mean * mean - noise, 1e-6 * mean * (1 - mean))
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e4)
    return mean * weight, (1 - mean) * weight


def judge(measured: DataFrame, hosts: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """``measured`` with booleans ``_quality_failed`` (base rules) and ``_quality_kept``.

    The hosts' table is broadcast where Spark finds it small; else it is joined by
    shuffle, and a host with a third of all rows is split by the skew join.
    """
    key = F.coalesce(F.col(host).cast("string"), F.lit(""))
    joined = measured.withColumn("_quality_key", key).join(
        hosts, F.col("_quality_key") == F.col("_quality_host"), "left"
    )
    failed = soft_failed()
    out = F.lit(False)
    for r in SOFT:
        out = out | (failed[r] & (F.col(f"_quality_rates.{r}") > limit))
    return joined.withColumn("_quality_failed", base_failed()).withColumn(
        "_quality_kept", ~F.col("_quality_failed") & ~out
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    measured = measure(docs)
    hosts = host_rates(measured)
    return judge(measured, hosts).filter("_quality_kept").select(*docs.columns)


def op5_host_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = stage(measure(docs).drop("text"), "quality-counts")
    judged = judge(measured, host_rates(measured))
    return judged.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(f"_quality.{c}").alias(c) for c in COUNTS[:-1]],
        F.col("_quality_failed").alias("base_failed"),
        F.col("_quality_kept").alias("kept"),
    )
