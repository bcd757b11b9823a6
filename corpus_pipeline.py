"""The corpus pipeline: from raw documents to packed training sequences.

Every stage works on all documents that the one before kept and returns the columns of
``documents``; the last returns pieces of sequences. Cases (nulls, empty tables, ties …)
are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spark_triples.llm.common import table
from spark_triples.llm.decontamination import drop_leaked
from spark_triples.llm.near_dedup import keep_one
from spark_triples.llm.packing import pack
from spark_triples.llm.quality import keep_good
from spark_triples.llm.secrets import redact
from spark_triples.session import stage as written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail alone, or together with their host, go."""
    return keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: of documents linked at a similarity of 0.8, one stays."""
    return keep_one(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold passages of the benchmark go."""
    return drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def discreet(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: secrets in the texts are replaced; no document goes."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of full sequences."""
    return pack(docs)


STAGES = [
    ("quality rules", good),
    ("near-duplicates", distinct),
    ("decontamination", unseen),
    ("secret scans", discreet),
    ("packing", packed),
]

#: Signatures, seeds, compression and tokens have no SQL form: tests hold every stage against
#: a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read
    again, so that no stage is computed twice and none depends on executors that are gone."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = written(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
