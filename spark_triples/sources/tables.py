"""Reading the Parquet tables the jobs write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triples.manifest import Run, read_runs, read_state
from spark_triples.operators.documents import document_values, group_by_subject, nest_documents
from spark_triples.operators.prospects import aggregate_prospects
from spark_triples.operators.skew import BROADCAST_KEYS, key_join
from spark_triples.operators.sorted_groups import file_name, sort_groups, stream_documents, stream_groups
from spark_triples.operators.triples import (
    choose_layout,
    dedup_triples,
    filter_property,
    match_pattern,
    require_not_null,
    visible,
)
from spark_triples.schema import (
    DOCUMENT,
    KEY_TAIL,
    LAYOUTS,
    PROSPECT,
    PROSPECT_KEY,
    REJECT,
    TRIPLE,
    TRIPLE_KEY,
    ZONE,
)
from spark_triples.session import TASK_BYTES, glob


def bytes_of(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files in some folders (or of some files), from their listing."""
    found = [e for path in paths for e in glob(spark, path)]
    return sum(x.size for e in found for x in (glob(spark, f"{e.path}/*") if e.is_dir else [e]))


def in_tasks(df: DataFrame, paths: list[str], keys: list[str]) -> DataFrame:
    """The rows of some folders, dealt out by their keys to as many tasks as their bytes ask for;
    as they are, if the scan has so many tasks."""
    spark = df.sparkSession
    tasks = -(-bytes_of(spark, paths) // TASK_BYTES)
    return df.repartition(tasks, *keys) if tasks > spark.sparkContext.defaultParallelism else df


def run_paths(spark: SparkSession, table: str) -> list[str]:
    """The published runs of a table, the oldest first."""
    return [f"{table}/{run.folder}" for run in read_runs(spark, f"{table}/")]


def index_paths(spark: SparkSession, prefix: str, name: str) -> list[str]:
    """The runs of one copy of the index: those published with all copies, and those that
    were written to this copy alone."""
    runs = read_runs(spark, prefix) if name in LAYOUTS else []
    shared = [f"{prefix}{name}/{run.folder}" for run in runs]
    return shared + run_paths(spark, prefix + name)


def read_run(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def zone_map(spark: SparkSession, prefix: str, name: str = "spo") -> DataFrame | None:
    """(run, file, range, rows, low, high, cut) of the files of a copy of the index: the keys of a
    file's rows begin with ``low`` and end before ``high``; no border is null. ``cut`` marks
    the files that begin within a leading value. None, if a run has no zone map."""
    there = {e.path.rstrip("/").rsplit("/", 1)[1] for e in glob(spark, f"{prefix}zones/run=*")}
    folders = [run.folder for run in read_runs(spark, prefix)]
    if not folders or not there.issuperset(folders) or run_paths(spark, prefix + name):
        return None
    zones = spark.read.schema(ZONE).parquet(*[f"{prefix}zones/{folder}" for folder in folders])
    return zones.filter(F.col("layout") == name).drop("layout")


# More files than this are not listed one by one.
LISTED_FILES = 10_000


def paths_with(spark: SparkSession, prefix: str, name: str, first: str) -> list[str]:
    """The files of a copy of the index that may hold a value of its leading key, without a look
    at the files; the paths of its runs, if there is no zone map or there are very many."""
    zones = zone_map(spark, prefix, name)
    if zones is None:
        return index_paths(spark, prefix, name)
    width = len(LAYOUTS[name]) + len(KEY_TAIL)
    start = F.array(F.lit(first), *[F.lit(None).cast("string")] * (width - 1))
    holds = (F.col("low").isNull() | (F.col("low")[0] <= first)) & (
        F.col("high").isNull() | (F.col("high") > start)
    )
    found = zones.filter(holds).select("run", "file").limit(LISTED_FILES + 1).collect()
    if len(found) > LISTED_FILES:
        return index_paths(spark, prefix, name)
    return [f"{prefix}{name}/{r['run']}/{r['file']}" for r in found]


def table_split_points(spark: SparkSession, prefix: str, name: str, most: int) -> list[str]:
    """Leading values that cut a copy of the index into at most ``most`` ranges of like numbers
    of rows, each at the beginning of a file; fewer where the table has fewer files. Read from
    the zone map, whose rows are as few as the files."""
    zones = zone_map(spark, prefix, name)
    if zones is None or most < 2:
        return []
    starts = zones.filter(F.col("low").isNotNull()).select(F.col("low")[0].alias("key"), "rows")
    # files of several runs may begin alike
    starts = starts.groupBy("key").agg(F.sum("rows").alias("rows"))
    # one row per file: few, whatever the size of the table
    before = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    total = zones.agg(F.sum("rows")).first()[0]
    first_rows = total - (starts.agg(F.sum("rows")).first()[0] or 0)
    passed = F.lit(first_rows) + F.coalesce(F.sum("rows").over(before), F.lit(0))
    share = F.floor(passed * most / F.lit(max(total, 1))).alias("share")
    chosen = starts.select("key", share).filter("share > 0").groupBy("share").agg(F.min("key").alias("key"))
    return [r["key"] for r in chosen.sort("key").collect()]


def lookup(
    spark: SparkSession,
    prefix: str,
    subject: str | None = None,
    predicate: str | None = None,
    obj: str | None = None,
    object_type: str | None = None,
) -> DataFrame:
    """Triples with the bound terms, from the copy that starts with one of them, and there only
    from the files that may hold it."""
    name = choose_layout(subject, predicate, obj)
    first = {"spo": subject, "po": predicate, "osp": obj}[name]
    triples = scan_index(spark, prefix, name, first=first)
    return match_pattern(triples, subject, predicate, obj, object_type)


def scan_index(
    spark: SparkSession,
    prefix: str,
    name: str = "spo",
    predicates: list[str] | None = None,
    since_ms: int | None = None,
    first: str | None = None,
) -> DataFrame:
    """The triples of an index table, optionally of some predicates only, or only those last
    written at a time or later, or only those with a value of its leading key (``first``).

    A table of one run holds each triple once already. More runs are merged: equal
    triples become one, with the latest time. Rows before ``since_ms`` cannot be the latest
    of a triple that stays, so the scan leaves them out, and older runs by their statistics.

    A run holds a triple once, so there is nothing to combine before the exchange of a merge: rows go
    to tasks of a bounded size as they are.
    """
    paths = index_paths(spark, prefix, name)
    runs = len(paths)
    if first is not None and name in LAYOUTS:
        paths = paths_with(spark, prefix, name, first)
    triples = read_run(spark, paths, TRIPLE)
    if first is not None:
        triples = triples.filter(F.col(LAYOUTS[name][0]) == first)
    if predicates is not None:
        triples = filter_property(triples, predicates)
    if since_ms is not None:
        triples = triples.filter(F.col("ts") >= F.timestamp_millis(F.lit(since_ms)))
    if first is None and runs > 1:
        triples = in_tasks(triples, paths, TRIPLE_KEY)
    return dedup_triples(triples) if runs > 1 else triples


def read_prospect_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw prospects from files. A row without its key or count fails the job."""
    paths = [paths] if isinstance(paths, str) else paths
    prospects = spark.read.schema(PROSPECT).parquet(*paths)
    return require_not_null(prospects, ["triple_value_type", "data", "count"])


def read_prospects(spark: SparkSession, table: str) -> DataFrame:
    """The count table; counts of equal prospects are added up over its runs."""
    paths = run_paths(spark, table)
    prospects = read_run(spark, paths, PROSPECT)
    if len(paths) < 2:
        return prospects
    # a run holds a prospect once: nothing to combine before the exchange
    return aggregate_prospects(in_tasks(prospects, paths, PROSPECT_KEY))


def read_documents(spark: SparkSession, table: str) -> DataFrame:
    """The values in the document table; of a document written by several runs, the last one.
    ``nest_documents`` makes one row per document of them."""
    return last_documents(spark, table, run_paths(spark, table))


def last_documents(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """The values in some runs of the document table, the oldest first; of a document written by
    several of them, the last one."""
    if len(paths) < 2:
        return read_run(spark, paths, DOCUMENT)
    runs = spark.read.option("basePath", table).schema(
        T.StructType([*DOCUMENT.fields, T.StructField("run", T.StringType())])
    )
    documents = runs.parquet(*paths)
    # only ids of later runs can replace a document: the first, largest run is not read
    later = runs.parquet(*paths[1:]).groupBy("id").agg(F.max("run").alias("last_run"))
    replaced = F.col("run") < F.col("last_run")
    return key_join(documents, later, "id", "left_anti", and_also=replaced).select(
        *DOCUMENT.names
    )


def read_rejects(spark: SparkSession, prefix: str) -> DataFrame:
    """(path, reason, line) of what the published loads left out: files that were not read, and
    malformed lines."""
    there = {e.path.rstrip("/").rsplit("/", 1)[1] for e in glob(spark, f"{prefix}rejects/run=*")}
    folders = [run.folder for run in read_runs(spark, prefix) if run.folder in there]
    return read_run(spark, [f"{prefix}rejects/{f}" for f in folders], REJECT)


def new_triples(spark: SparkSession, prefix: str, run: Run, runs: list[Run] | None = None) -> DataFrame:
    """The triples of a run, published or not, that no run published before it has. ``runs`` are
    those that are published, unless they are to be read.

    Only rows of earlier runs whose key hashes as one of this run's are compared with it, so a
    small load is checked against a large table by a scan that broadcasts hashes. A large load and
    the rows of its subjects' range meet at once, by one exchange of either: a hash has as many
    rows there as there are runs, so none is frequent.
    """
    triples = read_run(spark, f"{prefix}spo/{run.folder}", TRIPLE)
    runs = read_runs(spark, prefix) if runs is None else runs
    earlier = [r for r in runs if r.number < run.number and r.name != run.name]
    if not earlier:
        return triples
    low, high, rows = triples.agg(F.min("subject"), F.max("subject"), F.count("*")).first()
    if low is None:
        return triples
    before = read_run(spark, [f"{prefix}spo/{r.folder}" for r in earlier], TRIPLE)
    before = before.filter(F.col("subject").between(low, high))
    row_hash = F.xxhash64(*TRIPLE_KEY)
    held = before.withColumn("_hash", row_hash)
    if rows <= BROADCAST_KEYS:
        held = key_join(held, triples.select(row_hash.alias("_hash")), "_hash", "left_semi")
    held = held.select("_hash", *[F.col(c).alias(f"_{c}") for c in TRIPLE_KEY])
    same = F.col("_hash") == row_hash
    for c in TRIPLE_KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return triples.join(held, same, "left_anti")


def read_checkpoint(
    spark: SparkSession, path: str, start_ms: int | None = None
) -> int | None:
    """The start time given, else the stored end of the last run, else none."""
    if start_ms is not None:
        return start_ms
    return read_state(spark, f"{path}/")[1].get("end_ms")


def read_seen(spark: SparkSession, path: str) -> int | None:
    """The last manifest of the index that the last run had read, if it stored one."""
    return read_state(spark, f"{path}/")[1].get("seen")


def _one_run(spark: SparkSession, prefix: str) -> DataFrame | None:
    """The zone map of the subject-ordered copy, if it has one run."""
    return zone_map(spark, prefix) if len(index_paths(spark, prefix, "spo")) == 1 else None


def _cut(zones: DataFrame) -> DataFrame | None:
    """The subjects that are cut, if there are any, to be broadcast: there are fewer than files."""
    cut = zones.filter("cut").select(F.col("low")[0].alias("_cut")).distinct()
    return F.broadcast(cut) if cut.head(1) else None


def _sorted_rows(spark: SparkSession, prefix: str, zones: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The subject-ordered copy as it lies, with the name of each row's file, without the subjects
    that are cut; and the rows of these, if there are any."""
    rows = read_run(spark, index_paths(spark, prefix, "spo"), TRIPLE).select("*", file_name())
    cut, same = _cut(zones), F.col("subject") == F.col("_cut")
    if cut is None:
        return rows, None
    # every row of a file is counted, so those of cut subjects stay, but are not kept
    marked = rows.join(cut, same, "left")
    return marked, rows.join(cut, same, "left_semi").drop("_file")


def grouped_by_subject(
    spark: SparkSession,
    prefix: str,
    part_chars: int,
    auths: tuple[str, ...] = (),
    predicates: list[str] | None = None,
) -> DataFrame:
    """``group_by_subject`` of the visible triples of an index, or of those of some predicates. A
    table of one run is grouped as it is read, without an exchange of its rows. Several runs take one
    exchange by subject, behind which triples become one and are grouped. Subjects that hold more
    than a range of a run are cut, whatever their size, by exchanges of their own."""

    def chosen(df: DataFrame) -> DataFrame:
        df = visible(df, auths)
        return df if predicates is None else filter_property(df, predicates)

    zones, paths = zone_map(spark, prefix), index_paths(spark, prefix, "spo")
    if zones is None:
        return group_by_subject(chosen(scan_index(spark, prefix)), part_chars)
    if len(paths) > 1:
        rows, cut = chosen(read_run(spark, paths, TRIPLE)).filter("subject is not null"), _cut(zones)
        same = None if cut is None else F.col("subject") == F.col("_cut")
        light = rows if cut is None else rows.join(cut, same, "left_anti")
        tasks = -(-bytes_of(spark, paths) // TASK_BYTES)
        if tasks > spark.sparkContext.defaultParallelism:
            light = light.repartition(tasks, "subject")
        else:
            light = light.repartition("subject")
        # equal triples are of one subject, so they meet by the same exchange
        groups = sort_groups(dedup_triples(light), part_chars)
        heavy = None if cut is None else dedup_triples(rows.join(cut, same, "left_semi"))
        return groups if cut is None else groups.unionByName(group_by_subject(heavy, part_chars))
    rows, cut = _sorted_rows(spark, prefix, zones)
    groups = stream_groups(rows, _kept(auths, predicates, cut), zones, part_chars)
    return groups if cut is None else groups.unionByName(group_by_subject(chosen(cut), part_chars))


def nested_documents(
    spark: SparkSession,
    prefix: str,
    properties: list[str],
    part_chars: int,
    auths: tuple[str, ...] = (),
) -> DataFrame:
    """Nested documents of the listed properties, straight from an index. A table of one run is
    read in subject order and nested on the way; see :func:`grouped_by_subject`."""

    def chosen(df: DataFrame) -> DataFrame:
        return filter_property(visible(df, auths), properties)

    zones = _one_run(spark, prefix)
    if zones is None:
        listed = visible(scan_index(spark, prefix, "po", properties), auths)
        return nest_documents(document_values(listed), part_chars)
    rows, cut = _sorted_rows(spark, prefix, zones)
    values = document_values(rows, keep=("_file", "_kept"), kept=_kept(auths, properties, cut))
    docs = stream_documents(values, F.col("_kept"), zones, part_chars)
    if cut is None:
        return docs
    return docs.unionByName(nest_documents(document_values(chosen(cut)), part_chars))


def _kept(auths: tuple[str, ...], predicates: list[str] | None, cut: DataFrame | None) -> Column:
    kept = F.col("visibility").isin("", *auths) & F.col("subject").isNotNull()
    if predicates is not None:
        kept = kept & F.col("predicate").isin(*predicates)
    return kept if cut is None else kept & F.col("_cut").isNull()
