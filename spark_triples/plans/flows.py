"""The composed jobs. Each step is a table or a DataFrame plan; Spark runs the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spark_triples.functions.terms import iso_to_epoch_ms
from spark_triples.manifest import Run, listing, names_of, read_runs, read_state, runs_of, together, update
from spark_triples.operators.documents import document_values
from spark_triples.operators.prospects import (
    aggregate_prospects,
    explode_prospects,
    prospect_counts,
)
from spark_triples.operators.ranges import SAMPLED_PER_RANGE, key_sample
from spark_triples.operators.skew import PUSHED_KEYS, key_join
from spark_triples.operators.triples import (
    dedup_triples,
    filter_property,
    filter_time,
    visible,
)
from spark_triples.schema import REJECT, TRIPLE, TRIPLE_KEY
from spark_triples.session import TASK_BYTES, job_scratch, stage
from spark_triples.sinks.tables import (
    TIER,
    bytes_of,
    commit_checkpoint,
    compact_documents,
    compact_prospects,
    ensure_tables,
    ranges_for,
    ranges_of,
    sample_of_counts,
    write_documents,
    write_indexes,
    write_prospect_files,
    write_prospects,
)
from spark_triples.sources.files import (
    MODES,
    Parser,
    read_sources,
    rejected_lines,
    rejected_sources,
    split_sources,
)
from spark_triples.sources.tables import (
    index_paths,
    new_triples,
    read_checkpoint,
    read_prospect_files,
    read_run,
    read_seen,
    scan_index,
)


# A statement is about as long, or longer; and the bytes of lines that one range of a load should get.
LINE_BYTES, LINES_RANGE_BYTES = 100, 64 << 20


def epoch_ms(spark: SparkSession, text: str | None) -> int | None:
    """A date-time option as epoch milliseconds."""
    if text is None:
        return None
    return spark.range(1).select(iso_to_epoch_ms(F.lit(text))).first()[0]


def bulk_load(
    spark: SparkSession,
    source: str,
    prefix: str,
    run: str | None = None,
    mode: str = "add",
    parsers: dict[str, Parser] | None = None,
    partitions: int | None = None,
    on_bad_line: str = "FAILFAST",
) -> str:
    """RDF files → the three index tables under ``prefix``. Returns where the triples
    of this run lie in subject order. A run that is not named is named by the files: loading the
    same files again changes nothing, other files are added.

    What is left out is published with the run (``read_rejects``): files without a known format,
    hidden ones, and, unless ``on_bad_line`` is ``FAILFAST``, malformed lines."""
    ensure_tables(spark, prefix)
    name, size = listing(spark, split_sources(source))
    run, partitions = run or name, partitions or ranges_of(spark, size, LINES_RANGE_BYTES)
    # what is to be left out is counted, so lenient reads keep it first
    lenient = on_bad_line != "FAILFAST"
    read_mode = "PERMISSIVE" if lenient and on_bad_line in MODES else on_bad_line
    triples = read_sources(spark, source, parsers, read_mode)
    seen = Observation("load")
    if lenient:
        bad = F.count_if(F.col("_corrupt").isNotNull()).alias("bad")
        triples = triples.observe(seen, bad).filter("_corrupt is null").drop("_corrupt")

    def rejects(folder: str) -> None:
        skipped = rejected_sources(spark, split_sources(source)).withColumn("line", F.lit(None).cast("string"))
        if lenient and seen.get["bad"]:
            skipped = skipped.unionByName(rejected_lines(spark, source))
        # few rows of many lines: these are read by as many tasks as they need, then the rows are packed
        skipped.select(*REJECT.names).hint("rebalance").write.parquet(f"{prefix}rejects/{folder}")

    sample = None
    if partitions > 1 and run not in names_of(read_runs(spark, prefix)):
        share = min(1.0, SAMPLED_PER_RANGE * partitions * LINE_BYTES / size)
        some = read_sources(spark, source, parsers, read_mode, share)
        if lenient:
            some = some.filter("_corrupt is null")
        sample = key_sample(some, TRIPLE_KEY, partitions)
    return write_indexes(triples, prefix, run, mode, partitions, sample, rejects)


def bulk_load_with_statistics(
    spark: SparkSession,
    source: str,
    prefix: str,
    statistics_table: str,
    run: str | None = None,
    mode: str = "add",
    parsers: dict[str, Parser] | None = None,
    partitions: int | None = None,
    on_bad_line: str = "FAILFAST",
    on_bad_iri: str = "error",
    counting: str = "run",
) -> None:
    """The same load; the counts of the loaded triples go to the count table as well.
    They are counted from the written copy, so the files are parsed once. Triples and counts are
    published at once: a job that fails leaves both tables as they were.

    ``counting`` ``run`` adds up the triples of every run, one that two runs have counts twice.
    ``new`` counts only triples that no earlier run has: the counts are those of the index. Such
    a job fails if another load is published while it counts; it can be repeated.
    """
    if counting not in ("run", "new"):
        raise ValueError(f"counting must be run or new, not {counting!r}")
    run = run or listing(spark, split_sources(source))[0]
    with together(spark), job_scratch(spark):
        before = read_runs(spark, prefix)
        there = names_of(before).get(run) if mode == "add" else None
        if counting == "new" and there is None:
            update(spark, prefix, unchanged_since(prefix, before))
        path = bulk_load(spark, source, prefix, run, mode, parsers, partitions, on_bad_line)
        if mode == "add" and run in names_of(read_runs(spark, f"{statistics_table}/")):
            return
        if there is not None and there.name != run:  # the files alone have it by itself
            if counting == "new":
                raise RuntimeError(f"run {run!r} was merged before it was counted: count the index anew")
            mode_read = on_bad_line if on_bad_line == "FAILFAST" else "DROPMALFORMED"
            loaded = dedup_triples(read_sources(spark, source, parsers, mode_read))
        elif counting == "new":
            held = there or Run(run, path.rsplit("/", 1)[1], 1 + max((r.number for r in before), default=0))
            loaded = new_triples(spark, prefix, held, [] if mode == "replace" else before)
        else:
            loaded = read_run(spark, path, TRIPLE)
        # the number of lines is given, that of ranges is not: counts are more rows than triples
        partitions = partitions or ranges_of(spark, bytes_of(spark, [path]))
        counts = prospect_counts(loaded, on_bad_iri=on_bad_iri)
        # new triples are fewer than the run's, but their keys are spread alike
        sample = sample_of_counts(read_run(spark, path, TRIPLE), partitions, on_bad_iri)
        write_prospects(counts, statistics_table, run, mode, partitions, tier=None, sample=sample)
    compact_prospects(spark, statistics_table, tier=TIER)


def unchanged_since(prefix: str, runs: list[Run]):
    """A change of a table that changes nothing, and fails if its runs are not these any more."""

    def same(_: int, state: dict) -> dict:
        if set(runs_of(state)) != set(runs):
            raise RuntimeError(f"{prefix}: other runs were published while this one was counted")
        return state

    return same


def statistics(
    spark: SparkSession,
    prefix: str,
    destination: str,
    run: str | None = None,
    mode: str = "replace",
    partitions: int | None = None,
    on_bad_iri: str = "error",
) -> None:
    """Triple table → count table, over the public triples."""
    paths = index_paths(spark, prefix, "spo")
    triples = visible(scan_index(spark, prefix))
    counts = prospect_counts(triples, on_bad_iri=on_bad_iri)
    partitions = partitions or ranges_of(spark, bytes_of(spark, paths))
    with job_scratch(spark):
        sample = sample_of_counts(visible(read_run(spark, paths, TRIPLE)), partitions, on_bad_iri)
        write_prospects(counts, destination, run, mode, partitions, sample=sample)


def statistics_fetch_only(spark: SparkSession, prefix: str, files: str) -> None:
    """Triple table → raw prospects in files; first of two steps."""
    write_prospect_files(explode_prospects(visible(scan_index(spark, prefix))), files)


def statistics_combine(
    spark: SparkSession,
    files: str,
    destination: str,
    run: str | None = None,
    mode: str = "replace",
    partitions: int | None = None,
) -> None:
    """Raw prospects in files → count table; second of two steps."""
    counts = aggregate_prospects(read_prospect_files(spark, files))
    partitions = partitions or ranges_for(spark, bytes_of(spark, [files]), TASK_BYTES)
    write_prospects(counts, destination, run, mode, partitions)


def fulltext_full(
    spark: SparkSession,
    prefix: str,
    properties: list[str],
    destination: str,
    checkpoint: str | None = None,
    end: str | None = None,
) -> None:
    """Triple table → all documents anew, in place of those in the table. They and the end time
    are published at once."""
    end_ms = epoch_ms(spark, end)
    seen, _ = read_state(spark, prefix)
    with together(spark), job_scratch(spark):
        triples = listed_triples(spark, prefix, properties)
        write_documents(document_values(triples), destination, mode="replace", tier=None)
        if checkpoint is not None:
            commit_checkpoint(spark, checkpoint, end_ms, seen)


def listed_triples(
    spark: SparkSession,
    prefix: str,
    properties: list[str],
    layout: str = "po",
    since_ms: int | None = None,
) -> DataFrame:
    """The public triples of the listed properties. The predicate-ordered copy is read:
    there the filter skips whatever files hold other predicates."""
    return visible(scan_index(spark, prefix, layout, properties, since_ms))


def subjects_of_runs(
    spark: SparkSession, prefix: str, properties: list[str], after: int
) -> DataFrame:
    """Subject and time of the listed public triples in the runs that were published after a
    manifest. All copies of a run are published at once, so any of them tells."""
    new = [r for r in read_runs(spark, prefix) if r.number > after]
    triples = read_run(spark, [f"{prefix}po/{r.folder}" for r in new], TRIPLE)
    return visible(filter_property(triples, properties)).select("subject", "ts")


def triples_of_subjects(
    spark: SparkSession, prefix: str, properties: list[str], subjects: DataFrame
) -> DataFrame:
    """The listed triples, of any age, of the given subjects. For a few subjects the
    subject-ordered copy is read, and only where they lie in it; the copies hold the same
    triples at any time, since they are published together."""
    subjects = stage(subjects.select("subject").distinct(), "subjects")
    layout = "spo" if subjects.count() <= PUSHED_KEYS else "po"
    listed = listed_triples(spark, prefix, properties, layout)
    return key_join(listed, subjects, "subject", "left_semi", staged=True)


def fulltext_incremental(
    spark: SparkSession,
    prefix: str,
    properties: list[str],
    destination: str,
    checkpoint: str,
    end: str,
    start: str | None = None,
) -> None:
    """Documents of the subjects changed since ``start``, else since the last stored
    end, up to ``end``; documents and the new end are published at once.

    A triple has the time at which its load began. So what a load published after the last
    refresh is looked at whatever its time: each run is seen once, however long it took.
    """
    end_ms = epoch_ms(spark, end)
    if end_ms is None:
        raise ValueError("the end time must be set")
    start_ms = read_checkpoint(spark, checkpoint, epoch_ms(spark, start))
    seen, _ = read_state(spark, prefix)
    before = read_seen(spark, checkpoint)
    with together(spark), job_scratch(spark):
        listed = listed_triples(spark, prefix, properties, since_ms=start_ms)
        changed = filter_time(listed, start_ms, end_ms).select("subject")
        if before is not None:
            late = subjects_of_runs(spark, prefix, properties, before)
            changed = changed.unionByName(filter_time(late, None, end_ms).select("subject"))
        triples = triples_of_subjects(spark, prefix, properties, changed)
        write_documents(document_values(triples), destination, tier=None)
        commit_checkpoint(spark, checkpoint, end_ms, seen)
    compact_documents(spark, destination, tier=TIER)
