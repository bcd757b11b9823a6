"""Writing the Parquet tables.

A table is a set of runs. One Spark job writes a run into a fresh folder, and a manifest that
is written afterwards makes it part of the table (``manifest``). A run has a name: adding a
name that the table holds, merged or not, changes nothing, so a repeated job neither
doubles a count nor a document. Readers merge the runs (``sources.tables``).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_triples import manifest
from spark_triples.manifest import Run
from spark_triples.operators.documents import document_json
from spark_triples.operators.prospects import aggregate_prospects, explode_prospects
from spark_triples.operators.ranges import (
    RANGE,
    SAMPLED_PER_RANGE,
    Points,
    Sample,
    in_ranges,
    key_sample,
    sorted_distinct,
    split_points,
)
from spark_triples.schema import DELIM, KEY_TAIL, LAYOUTS, PROSPECT, PROSPECT_KEY, TRIPLE, TRIPLE_KEY, ZONE
from spark_triples.session import TASK_BYTES, delete, glob, job_scratch, make_dir, small_splits, stage
from spark_triples.sources.tables import (
    bytes_of,
    index_paths,
    last_documents,
    read_run,
)

MODES = ("add", "rerun", "replace")
# Runs of a size class that are merged, and the size below which all runs are of the first class.
TIER, FIRST_CLASS_BYTES = 4, 4 << 20
OWN_NAME, MERGED = "own-", "merged-"
_PROSPECT_ORDER = [*PROSPECT_KEY[1:], PROSPECT_KEY[0]]


def ensure_tables(spark: SparkSession, prefix: str) -> list[str]:
    """Create the folders of the index tables and of ``ns`` where they are missing."""
    tables = [prefix + name for name in (*LAYOUTS, "ns")]
    for table in tables:
        make_dir(spark, table)
    return tables


def _checked(run: str | None, mode: str) -> str:
    """The name of a run; one that is not named gets a name of its own, which nobody can repeat
    and which is forgotten when the run is merged."""
    if run is not None and (run.startswith((OWN_NAME, MERGED)) or not re.fullmatch(r"[A-Za-z0-9_.-]+", run)):
        raise ValueError(f"not a name for a run: {run!r}")
    run = run or OWN_NAME + uuid.uuid4().hex
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return run


def _start(spark: SparkSession, root: str, run: str, mode: str) -> tuple[str | None, str]:
    """The folder of a run that is there already and is to stay, and a fresh folder."""
    number, state = manifest.read_state(spark, root)
    held = manifest.names_of(manifest.runs_of(state)).get(run)
    if mode == "rerun" and held is not None and held.name != run:
        raise ValueError(f"run {run!r} was merged with others and cannot be replaced")
    there = held.folder if held is not None and mode == "add" else None
    return there, manifest.new_folder(number + 1, run)


def _publish(spark: SparkSession, root: str, run: str, folder: str, mode: str) -> None:
    def change(number: int, state: dict) -> dict:
        runs = manifest.runs_of(state)
        if mode == "add" and run in manifest.names_of(runs):
            return state  # the same run was added meanwhile
        kept = [] if mode == "replace" else [r for r in runs if r.name != run]
        return state | {"runs": [*kept, Run(run, folder, number)]}

    manifest.update(spark, root, change)


def write_table(
    df: DataFrame, table: str, run: str | None = None, mode: str = "add"
) -> str:
    """Write ``df`` as a run of the table and return its path. ``add`` puts it beside the
    other runs, or leaves all as it is if the name is there; ``rerun`` replaces the run of
    that name, ``replace`` all runs. The former state stays readable until the new one is
    published, and if the job fails."""
    run, spark, root = _checked(run, mode), df.sparkSession, f"{table}/"
    there, folder = _start(spark, root, run, mode)
    if there is None:
        df.write.parquet(f"{table}/{folder}")
        _publish(spark, root, run, folder, mode)
    return f"{table}/{there or folder}"


def write_sorted(
    df: DataFrame,
    table: str,
    keys: list[str],
    run: str | None = None,
    mode: str = "add",
    partitions: int | None = None,
) -> str:
    """Write a run in key order, so that a lookup by the leading keys skips files and
    row groups."""
    return write_table(in_key_order(df, keys, partitions), table, run, mode)


# Bytes of input that one range of a sorted copy should get; and a range that is worth a task.
RANGE_BYTES, LEAST_RANGE_BYTES = 256 << 20, 1 << 20


def ranges_for(spark: SparkSession, size: int, each: int = RANGE_BYTES) -> int | None:
    """How many ranges so many bytes ask for; None where the session's shuffle partitions are
    enough, which adaptive execution then merges where they are small."""
    wanted = -(-size // each)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def ranges_of(spark: SparkSession, size: int, each: int = TASK_BYTES) -> int:
    """How many ranges so many bytes are laid out in: one for each ``each``, and not fewer than
    the session's shuffle partitions unless they would be small."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // LEAST_RANGE_BYTES))
    return max(-(-size // each), least, 1)


def in_key_order(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """``df`` in ranges of its keys, sorted. With the whole row key in ``keys`` the range
    borders cut through even the most frequent leading key."""
    ranged = (
        df.repartitionByRange(partitions, *keys)
        if partitions
        else df.repartitionByRange(*keys)
    )
    return ranged.sortWithinPartitions(*keys)


def write_indexes(
    triples: DataFrame,
    prefix: str,
    run: str | None = None,
    mode: str = "add",
    partitions: int | None = None,
    sample: Sample | None = None,
    beside: Callable[[str], None] | None = None,
) -> str:
    """Write triples to the three index tables, each in its own order and once, publish them
    together, and return the path of the first copy.

    The first copy takes one exchange: rows go to ranges of the whole row key, where
    equal ones become one. The others read its Parquet instead of the input. All ranges are
    laid out from one sample of the keys. Unless it is given, the triples are written as they
    come first, and sampled there: so the input is evaluated once. ``beside`` gets the name of
    the run's folder before the run is published, for what belongs to it.
    """
    spark, run = triples.sparkSession, _checked(run, mode)
    there, folder = _start(spark, prefix, run, mode)
    if there is not None:
        return f"{prefix}spo/{there}"
    with job_scratch(spark):
        ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if sample is None and ranges > 1:
            triples = stage(triples.select(*TRIPLE.names), "unsorted", STAGED_GROUP_BYTES)
            rows = triples.count()
            ranges = partitions or max(ranges, -(-rows // RANGE_ROWS))
            sample = sample_of_files(triples, ranges, rows)
        _write_copies(triples, prefix, folder, ranges, sample)
    if beside is not None:
        beside(folder)
    _publish(spark, prefix, run, folder, mode)
    return f"{prefix}spo/{folder}"


# Row groups of triples that are read again by many tasks.
STAGED_GROUP_BYTES = 16 << 20
# Triples that a range should hold at most: a task sorts them.
RANGE_ROWS = 1_000_000
# Keys of counts are sampled from so many times the triples that would do.
THINNED = 32
# A range is one row group, so that no reader's splits cut through it.
ROW_GROUP_BYTES = 1 << 30


def sample_of_files(triples: DataFrame, ranges: int, rows: int) -> Sample:
    """A sample of the row keys of Parquet files, whose rows are counted from their footers."""
    share = min(1.0, SAMPLED_PER_RANGE * ranges / max(rows, 1))
    some = triples if share == 1 else triples.sample(share, seed=7)
    return key_sample(some, TRIPLE_KEY, ranges)


def sample_of_counts(triples: DataFrame, ranges: int, on_bad_iri: str = "error") -> Sample | None:
    """A sample of the places of prospects of triples in files, each once. A triple has two or three keys
    that no other one has, as a rule. Of more triples than needed some keys are taken, by their
    hash, lest frequent keys be too many of them. None, if there is one range."""
    if ranges < 2:
        return None
    share = SAMPLED_PER_RANGE * ranges / (3 * max(triples.count(), 1))
    thinned = max(1, min(THINNED, int(1 / share)))
    some = triples.sample(share * thinned, seed=7) if share * thinned < 1 else triples
    keys = explode_prospects(some, on_bad_iri=on_bad_iri).select(_place().alias("_place"))
    keys = keys.filter(F.pmod(F.xxhash64("_place"), F.lit(thinned)) == 0).distinct()
    return key_sample(keys, ["_place"], ranges)


def _place() -> Column:
    """Prospects in the order of this lie in the order of the count table; one text is compared with
    the borders of ranges by less code than five columns are, which the JVM can compile."""
    return F.concat_ws(DELIM, "triple_value_type", "data")


def _write_copies(
    triples: DataFrame,
    prefix: str,
    folder: str,
    ranges: int,
    sample: Sample | None,
) -> None:
    spark, source = triples.sparkSession, triples.select(*TRIPLE.names)
    laid_out = {}
    for name, order in LAYOUTS.items():
        path, order = f"{prefix}{name}/{folder}", [*order, *KEY_TAIL]
        points = split_points(sample, order, ranges)
        ranged = in_ranges(source, points)
        if name == "spo":
            copy = sorted_distinct(ranged, points, [F.max("ts").alias("ts")])
        else:
            copy = ranged.drop(RANGE).sortWithinPartitions(*order)
        with small_splits(spark, STAGED_GROUP_BYTES):  # an exchange holds what a task reads
            copy.select(*TRIPLE.names).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        laid_out[name] = points
        if name == "spo":
            source = read_run(spark, path, TRIPLE)
    _write_zones(spark, prefix, folder, laid_out)


BOUNDS = "layout: string, low: array<string>, high: array<string>, cut: boolean"


def _write_zones(spark: SparkSession, prefix: str, folder: str, laid_out: dict[str, Points]) -> None:
    """The zone map of a run: per file its rows and between which keys they lie."""
    files = read_run(spark, [f"{prefix}{name}/{folder}" for name in laid_out], TRIPLE)
    # no column is read: the rows of a file are counted from its footer
    counted = files.groupBy("_metadata.file_path").agg(F.count("*").alias("rows"))
    range_id = F.regexp_extract("file", r"^part-(\d+)", 1).cast("int")
    zones = counted.select(
        F.lit(folder).alias("run"),
        F.element_at(F.split("file_path", "/"), -3).alias("folder"),
        F.substring_index("file_path", "/", -1).alias("file"),
        "rows",
    ).withColumn("range", range_id)
    place = F.lit(None)
    for name, points in laid_out.items():
        cut = set(points.cut())
        bounds = [
            {"layout": name, "low": low, "high": high, "cut": low is not None and low[0] in cut}
            for low, high in zip([None, *points.keys], [*points.keys, None], strict=True)
        ]
        known = F.from_json(F.lit(json.dumps(bounds)), f"array<struct<{BOUNDS}>>")
        here = F.col("folder") == f"{prefix}{name}".rsplit("/", 1)[1]
        place = F.when(here, F.get(known, F.col("range"))).otherwise(place)
    zones = zones.withColumn("place", place).select("run", "place.*", "file", "range", "rows")
    zones.select(*ZONE.names).coalesce(1).write.parquet(f"{prefix}zones/{folder}")


def write_routed(df: DataFrame, path: str, key: str) -> None:
    """Write rows to one folder per value of ``key``, in one pass."""
    df.write.mode("overwrite").partitionBy(key).parquet(path)


def write_prospect_files(prospects: DataFrame, path: str) -> None:
    """Write prospects as they are, unaggregated."""
    with small_splits(prospects.sparkSession):  # files as small as those of the triples
        prospects.select(*PROSPECT.names).write.mode("overwrite").parquet(path)


def write_prospects(
    prospects: DataFrame,
    table: str,
    run: str | None = None,
    mode: str = "add",
    partitions: int | None = None,
    tier: int | None = TIER,
    sample: Sample | None = None,
) -> None:
    """Write aggregated prospects to the count table, sorted for lookups.

    ``add``: the table's counts grow by these, once per run name however often the run
    is repeated. ``replace``: these are the table's counts from now on. Runs that are due by
    size are merged afterwards (``tier`` None: never).

    With a ``sample`` of the keys the ranges are laid out beforehand; a range partitioner would add
    all counts up once more to find them.
    """
    rows = prospects.select(*PROSPECT.names)
    with small_splits(prospects.sparkSession):  # a task that counts holds several keys for each triple
        if sample is None:
            write_sorted(rows, table, _PROSPECT_ORDER, run, mode, partitions)
        else:
            points = split_points(sample, ["_place"], partitions or sample.n)
            ranged = in_ranges(rows.withColumn("_place", _place()), points).drop(RANGE, "_place")
            write_table(ranged.sortWithinPartitions(*_PROSPECT_ORDER), table, run, mode)
    _merge_due(prospects.sparkSession, f"{table}/", [table], tier, _merge_prospects)


def write_documents(
    docs: DataFrame, table: str, mode: str = "add", tier: int | None = TIER
) -> str:
    """Write documents as the table's next run; a document replaces those of the same id
    from earlier runs. Only these documents are written, whatever the size of the table.

    Writing the same documents again does no harm. The table has one writer at a time. Runs
    that are due by size are merged afterwards (``tier`` None: never).
    """
    path = write_table(docs, table, mode=mode)
    _merge_due(docs.sparkSession, f"{table}/", [table], tier, _merge_documents)
    return path


def export_documents(docs: DataFrame, path: str) -> None:
    """Write nested documents as JSON lines."""
    document_json(docs).select("json").write.mode("overwrite").text(path)


def _merge_runs(spark: SparkSession, root: str, runs: list[Run], folder: str) -> None:
    """Publish ``folder`` in place of ``runs``. Their names stay known, so that adding one of
    them again still changes nothing. Runs that came meanwhile stay."""
    names = tuple(sorted(n for n in manifest.names_of(runs) if not n.startswith((OWN_NAME, MERGED))))
    number = max((r.number for r in runs), default=0)

    def change(_: int, state: dict) -> dict:
        now = manifest.runs_of(state)
        if not set(runs) <= set(now):
            raise RuntimeError(f"{root}: merged runs were replaced meanwhile")
        rest = [r for r in now if r not in runs]
        return state | {"runs": [Run(MERGED + folder[-8:], folder, number, names), *rest]}

    manifest.update(spark, root, change)


def _merged_folder(runs: list[Run]) -> str:
    return manifest.new_folder(max((r.number for r in runs), default=0), "merged")


def runs_due(sizes: list[int], tier: int) -> int:
    """How many of the newest runs are to be merged, given the bytes of all, the oldest first.

    Runs are in size classes, each ``tier`` times the one before. When the end of the list has
    ``tier`` runs of a class and none above, that end is merged. A row is rewritten once
    for each class it passes, and fewer than ``tier`` runs of a class stay: both grow with the
    logarithm of the table. Only neighbours are merged, so the order of runs stays.
    """
    classes = []
    for size in sizes:
        k = 0
        while size >= FIRST_CLASS_BYTES * tier**k:
            k += 1
        classes.append(k)
    for k in sorted(set(classes)):
        n = next((n for n, c in enumerate(reversed(classes)) if c > k), len(classes))
        if classes[len(classes) - n :].count(k) >= tier:
            return n
    return 0


def _merge_due(
    spark: SparkSession,
    root: str,
    copies: list[str],
    tier: int | None,
    merge: Callable[[SparkSession, str, list[Run]], None],
) -> None:
    """Merge what is due by size, again until nothing is."""
    while tier is not None:
        runs = manifest.read_runs(spark, root)
        sizes = [bytes_of(spark, [f"{copy}/{r.folder}" for copy in copies]) for r in runs]
        if (n := runs_due(sizes, tier)) < 2:
            return
        merge(spark, root, runs[-n:])


def _merge_indexes(
    spark: SparkSession, prefix: str, runs: list[Run], partitions: int | None = None
) -> None:
    folder = _merged_folder(runs)
    paths = [f"{prefix}spo/{r.folder}" for r in runs]
    triples = read_run(spark, paths, TRIPLE)
    rows = triples.count()
    ranges = partitions or max(ranges_of(spark, bytes_of(spark, paths)), -(-rows // RANGE_ROWS))
    with job_scratch(spark):
        sample = sample_of_files(triples, ranges, rows) if ranges > 1 else None
        _write_copies(triples, prefix, folder, ranges, sample)
    _merge_runs(spark, prefix, runs, folder)


def _merge_prospects(
    spark: SparkSession, root: str, runs: list[Run], partitions: int | None = None
) -> None:
    folder = _merged_folder(runs)
    paths = [f"{root}{r.folder}" for r in runs]
    partitions = partitions or ranges_of(spark, bytes_of(spark, paths))
    # a run holds a prospect once: nothing to combine before the exchange, and none is needed after it
    ranged = read_run(spark, paths, PROSPECT).repartitionByRange(partitions, *_PROSPECT_ORDER)
    rows = aggregate_prospects(ranged).sortWithinPartitions(*_PROSPECT_ORDER)
    with small_splits(spark):
        rows.select(*PROSPECT.names).write.parquet(f"{root}{folder}")
    _merge_runs(spark, root, runs, folder)


def _merge_documents(spark: SparkSession, root: str, runs: list[Run]) -> None:
    folder = _merged_folder(runs)
    paths = [f"{root}{r.folder}" for r in runs]
    with job_scratch(spark):
        values = last_documents(spark, root.rstrip("/"), paths)
        values = values.coalesce(ranges_of(spark, bytes_of(spark, paths)))
        values.write.parquet(f"{root}{folder}")
    _merge_runs(spark, root, runs, folder)


def compact_index(
    spark: SparkSession, prefix: str, partitions: int | None = None, tier: int | None = None
) -> None:
    """Rewrite the index tables with their runs merged; with a ``tier``, only runs that are due by
    size. A refresh that follows runs sees the triples of a merged run anew."""
    if tier is not None:
        copies = [f"{prefix}{name}" for name in LAYOUTS]
        _merge_due(spark, prefix, copies, tier, _merge_indexes)
    elif runs := manifest.read_runs(spark, prefix):
        _merge_indexes(spark, prefix, runs, partitions)


def compact_prospects(
    spark: SparkSession, table: str, partitions: int | None = None, tier: int | None = None
) -> None:
    """Rewrite the count table with the counts of its runs added up; with a ``tier``, only of runs
    that are due by size."""
    if tier is not None:
        _merge_due(spark, f"{table}/", [table], tier, _merge_prospects)
    elif runs := manifest.read_runs(spark, f"{table}/"):
        _merge_prospects(spark, f"{table}/", runs, partitions)


def compact_documents(spark: SparkSession, table: str, tier: int | None = None) -> None:
    """Rewrite the document table without replaced documents; with a ``tier``, only runs that are
    due by size. It has one writer at a time."""
    if tier is not None:
        _merge_due(spark, f"{table}/", [table], tier, _merge_documents)
    elif runs := manifest.read_runs(spark, f"{table}/"):
        _merge_documents(spark, f"{table}/", runs)


def remove_old(spark: SparkSession, prefix: str, tables: tuple[str, ...] = tuple(LAYOUTS)) -> None:
    """Remove the folders of runs that the last manifest does not name: replaced and merged
    runs, and failed attempts; and the records of intents that are long settled. Not while jobs
    write or read an older state."""
    manifest.remove_settled(spark, prefix)
    kept = {run.folder for run in manifest.read_runs(spark, prefix)}
    beside = [e for name in ("zones", "rejects") for e in glob(spark, f"{prefix}{name}/run=*")]
    for entry in beside:
        if entry.path.rsplit("/", 1)[1] not in kept:
            delete(spark, entry.path)
    for table in tables:
        known = {path.rstrip("/").rsplit("/", 1)[1] for path in index_paths(spark, prefix, table)}
        for entry in glob(spark, f"{prefix}{table}/run=*"):
            if entry.path.rsplit("/", 1)[1] not in known:
                delete(spark, entry.path)


def commit_checkpoint(
    spark: SparkSession, path: str, end_ms: int | None, seen: int | None = None
) -> None:
    """Store the end time of a run, if it had one, and the last manifest it had seen. The last
    value stored counts, also if it is earlier. Call it after the sink's action has
    returned: an action is over when all of its tasks are."""
    if end_ms is not None:
        manifest.update(spark, f"{path}/", lambda _, __: {"end_ms": end_ms, "seen": seen})
