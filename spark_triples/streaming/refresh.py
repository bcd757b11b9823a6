"""Streams of triples: ingest with a watermark, and document refresh per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spark_triples.manifest import read_state, together
from spark_triples.operators.documents import document_values
from spark_triples.operators.triples import filter_property, normalise, visible
from spark_triples.plans.flows import subjects_of_runs, triples_of_subjects
from spark_triples.schema import STREAM_LAG, TRIPLE, TRIPLE_KEY
from spark_triples.session import job_scratch, make_dir
from spark_triples.sinks.tables import TIER, commit_checkpoint, compact_documents, write_documents
from spark_triples.sources.files import parse_lines
from spark_triples.sources.tables import read_seen


def stream_lines(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Triples of N-Triples files as they arrive in a folder."""
    lines = spark.readStream.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path")
    )
    return parse_lines(lines, mode)


def stream_triples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of Parquet files as they arrive; a pattern may name a table's runs."""
    return normalise(spark.readStream.schema(TRIPLE).parquet(path))


def with_watermark(triples: DataFrame) -> DataFrame:
    """Stamp rows with the time they are seen; the watermark follows five seconds behind."""
    stamped = triples.withColumn("ts", F.current_timestamp())
    return stamped.withWatermark("ts", STREAM_LAG)


def distinct_triples(triples: DataFrame) -> DataFrame:
    """A stream's triples, each the first time it is seen within the lag of the watermark. The
    state has the keys of that time only, hash-partitioned by the whole key."""
    return with_watermark(triples).dropDuplicatesWithinWatermark(TRIPLE_KEY)


def ingest(
    triples: DataFrame, path: str, checkpoint: str, once: bool = True, distinct: bool = False
) -> StreamingQuery:
    """Append a stream of triples to Parquet files, each row once, or each triple once within
    the lag of the watermark (``distinct``)."""
    writer = (
        (distinct_triples(triples) if distinct else with_watermark(triples))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_runs(spark: SparkSession, prefix: str) -> DataFrame:
    """The manifests of an index as they are written: a signal that runs were published. The
    index may still be empty."""
    make_dir(spark, f"{prefix}manifests")
    return spark.readStream.text(f"{prefix}manifests")


def refresh_from_runs(
    spark: SparkSession,
    prefix: str,
    properties: list[str],
    destination: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Rewrite the documents of the subjects that published runs changed, run by run.

    A run is published with all its copies, so what it changed is readable in each. The last
    manifest that was worked on is published with the documents; a repeated batch
    finds that it was done.
    """
    state = f"{checkpoint}/seen"

    def refresh(_: DataFrame, __: int) -> None:
        seen, _state = read_state(spark, prefix)
        before = read_seen(spark, state) or 0
        if seen == before:
            return
        with together(spark), job_scratch(spark):
            changed = subjects_of_runs(spark, prefix, properties, before)
            triples = triples_of_subjects(spark, prefix, properties, changed)
            write_documents(document_values(triples), destination, tier=None)
            commit_checkpoint(spark, state, 0, seen)
        compact_documents(spark, destination, tier=TIER)

    writer = stream_runs(spark, prefix).writeStream.foreachBatch(refresh)
    writer = writer.option("checkpointLocation", f"{checkpoint}/stream")
    return (writer.trigger(availableNow=True) if once else writer).start()


def refresh_documents(
    changes: DataFrame,
    prefix: str,
    properties: list[str],
    destination: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Per micro-batch, rewrite the documents of the subjects it changed.

    Their triples of any age are read from the index table, so the stream keeps no
    state; its checkpoint is the high-water mark. A repeated batch writes equal documents.
    """

    def refresh(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        changed = visible(filter_property(batch, properties)).select("subject")
        with job_scratch(spark):
            triples = triples_of_subjects(spark, prefix, properties, changed)
            write_documents(document_values(triples), destination)

    writer = changes.writeStream.foreachBatch(refresh).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
