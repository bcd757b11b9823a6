"""Every operator and job as a query over the driver's tables, with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_triples.functions import ntriples
from spark_triples.functions import terms
from spark_triples.operators import documents, prospects, triples
from spark_triples.plans import flows
from spark_triples.plans.fixture import (
    DID,
    G_RAW_SQL,
    G_SQL,
    LABEL,
    PLACED_BY,
    PROPERTIES,
    STATUS,
    g,
    g_raw,
    table,
)
from spark_triples.schema import (
    ANYURI,
    DELIM,
    LAYOUTS,
    TRIPLE,
    TYPES,
    XSD,
    XSD_STRING,
)
from spark_triples.session import scratch_path
from spark_triples.sinks import tables as sinks
from spark_triples.sources import files
from spark_triples.sources import tables as sources
from spark_triples.streaming import refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SPLIT_TIME = "2024-01-15 12:00:00"
SPLIT_TIME_MS = 1705320000000
RANGE_START = "2024-01-30T23:00:00Z"
RANGE_END = "2024-01-31T00:59:59+01:00[Europe/Paris]"
RANGE_SQL = "timestamp '2024-01-30 23:00:00' and timestamp '2024-01-30 23:59:59'"
SMALL_PART = 200
# For the nested form: no document of the tables is so large.
WHOLE = 8_000_000


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


# --- SQL building blocks ------------------------------------------------------

WITH_G = f"with g_raw as ({G_RAW_SQL}), g as ({G_SQL}), v as (select * from g where visibility = '')"

NAMESPACE_SQL = (
    "case when instr({s}, '#') > 0 then substring({s}, 1, instr({s}, '#') - 1) "
    "when instr({s}, '/') > 0 then substring({s}, 1, length({s}) - instr(reverse({s}), '/')) "
    "when instr({s}, ':') > 0 then substring({s}, 1, length({s}) - instr(reverse({s}), ':')) end"
).format(s="subject")

# The delimiter of a pair is shown as '|'.
PROSPECT_SQL = {
    "subject": ("subject", f"'{ANYURI}'"),
    "predicate": ("predicate", f"'{ANYURI}'"),
    "object": ("object", "object_type"),
    "subjectpredicate": ("concat(subject, '|', predicate)", f"'{XSD_STRING}'"),
    "subjectobject": ("concat(subject, '|', object)", f"'{XSD_STRING}'"),
    "predicateobject": ("concat(predicate, '|', object)", f"'{XSD_STRING}'"),
    "entity": (NAMESPACE_SQL, f"'{ANYURI}'"),
}


def prospects_sql(source: str, types: tuple[str, ...] = TYPES) -> str:
    return " union all ".join(
        f"select '{name}' as triple_value_type, {PROSPECT_SQL[name][0]} as data, "
        f"{PROSPECT_SQL[name][1]} as data_type, visibility from {source}"
        for name in types
    )


def counts_sql(source: str = "v", types: tuple[str, ...] = TYPES) -> str:
    return (
        f"{WITH_G}, p as ({prospects_sql(source, types)}) "
        "select triple_value_type, data, data_type, visibility, count(*) as count "
        "from p group by all"
    )


ROW_ORDER_SQL = (
    "predicate, object, object_type, lang nulls first, context nulls first, visibility"
)
LITERAL_SQL = f"object_type <> '{ANYURI}'"
SHOWN_TRIPLE_SQL = (
    "subject, predicate, object, object_type, coalesce(lang, '') as lang, "
    "coalesce(context, '') as context, visibility"
)


def in_sql(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def part_sql(source: str, budget: int) -> str:
    """Rows of ``source`` with the part of their subject they fall in."""
    return (
        "select *, cast(floor(coalesce(sum(length(object) + 64) over (partition by subject "
        f"order by {ROW_ORDER_SQL} rows between unbounded preceding and 1 preceding), 0) "
        f"/ {budget}) as bigint) as part from {source}"
    )


def documents_sql(rows: str) -> str:
    """One row per document part and field, of rows that have a part."""
    return (
        "select subject as id, subject as uri, 'null' as context, part, "
        "concat('p_', predicate) as field, "
        f"string_agg(object, '|' order by {ROW_ORDER_SQL}) as field_values, count(*) as n "
        f"from ({rows}) where {LITERAL_SQL} group by subject, part, predicate"
    )


def listed_sql(source: str = "v", where: str = "true") -> str:
    return f"select * from {source} where predicate in ({in_sql(PROPERTIES)}) and {where}"


CHANGED_SQL = (
    f"select * from v where predicate in ('{DID}') and subject in (select subject from v "
    f"where predicate in ('{DID}') and ts between {RANGE_SQL})"
)

# --- shown forms: the columns of a result the comparison can read ---------------


def show_prospects(df: DataFrame) -> DataFrame:
    return df.select(
        "triple_value_type",
        F.replace("data", F.lit(DELIM), F.lit("|")).alias("data"),
        "data_type",
        "visibility",
        F.col("count").cast("bigint").alias("count"),
    )


def show_triples(df: DataFrame, *names: str) -> DataFrame:
    blank = {"lang", "context"}
    return df.select(
        *[
            F.coalesce(name, F.lit("")).alias(name) if name in blank else F.col(name)
            for name in names or TRIPLE.names[:-1]
        ]
    )


def with_ts(df: DataFrame) -> DataFrame:
    shown = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "context")]
    return df.select(
        *TRIPLE.names[:4], *shown, "visibility", F.unix_micros("ts").alias("ts_us")
    )


def nested(values: DataFrame, part_chars: int = WHOLE) -> DataFrame:
    return documents.nest_documents(values, part_chars)


def values(spark: SparkSession, table: str) -> DataFrame:
    """The document table, nested."""
    return nested(sources.read_documents(spark, table))


def show_documents(docs: DataFrame) -> DataFrame:
    fields = docs.select(
        "id", "uri", "context", "part", F.explode("properties").alias("field", "_values")
    )
    return fields.select(
        "id",
        "uri",
        "context",
        "part",
        "field",
        F.array_join("_values", "|").alias("field_values"),
        F.size("_values").cast("bigint").alias("n"),
    )


def show_groups(groups: DataFrame) -> DataFrame:
    objects = F.transform("triples", lambda t: t["object"])
    return groups.select(
        "subject",
        "part",
        F.size("triples").cast("bigint").alias("n"),
        F.array_join(objects, "|").alias("objects"),
    )


_loaded: dict[tuple[str, str], str] = {}


def loaded_prefix(spark: SparkSession, sf_dir: str) -> str:
    """Prefix of the graph's index tables, which are written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        prefix = scratch_path(spark, "graph") + "/"
        sinks.ensure_tables(spark, prefix)
        sinks.write_indexes(g_raw(spark, sf_dir), prefix)  # which makes one of equal triples
        _loaded[key] = prefix
    return _loaded[key]


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph as jobs see it: a scan of its triple table."""
    return sources.scan_index(spark, loaded_prefix(spark, sf_dir))


def public_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.visible(graph(spark, sf_dir))


def write_lines(df: DataFrame, line: Column, path: str) -> str:
    """Write the graph as text files named by the extension of ``path``'s last folder."""
    df.select(line.alias("value")).write.text(path)
    return path


# --- sources ------------------------------------------------------------------


@query(
    "src_split_list",
    "with s as (select o_orderkey, concat(o_orderpriority, ' , ', o_orderstatus, ',,', "
    "cast(o_custkey as varchar), ', ') as spec from orders) "
    "select o_orderkey, unnest(list_filter(regexp_split_to_array(spec, '\\s*,\\s*'), "
    "lambda x: x <> '')) as path from s",
)
def src_split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = F.concat(
        "o_orderpriority",
        F.lit(" , "),
        "o_orderstatus",
        F.lit(",,"),
        F.col("o_custkey").cast("string"),
        F.lit(", "),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.explode(files.split_list(spec)).alias("path")
    )


@query(
    "src_route_format",
    "with s as (select page_id, concat(url, case page_id % 5 when 0 then '/*.nt' when 1 then "
    "'/data.NT' when 2 then '/x.nt/*.ttl' when 3 then '/' else '/x.nq' end) as path from pages) "
    "select page_id, path, case when lower(path) like '%.nt' then 'line' else 'file' end "
    "as route from s",
)
def src_route_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    endings = F.array(*[F.lit(x) for x in ("/*.nt", "/data.NT", "/x.nt/*.ttl", "/", "/x.nq")])
    ending = F.get(endings, (F.col("page_id") % 5).cast("int"))
    paths = table(spark, sf_dir, "pages").select(
        "page_id", F.concat("url", ending).alias("path")
    )
    return paths.select("page_id", "path", files.route(F.col("path")).alias("route"))


PARSED_SQL = f"{WITH_G} select subject, predicate, object, object_type, coalesce(lang, '') as lang from g"
PARSED = ["subject", "predicate", "object", "object_type", "lang"]


@query("src_ntriples_parse", PARSED_SQL)
def src_ntriples_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(
        graph(spark, sf_dir), ntriples.render_line(), scratch_path(spark, "lines")
    )
    return show_triples(files.read_ntriples(spark, [path]), *PARSED)


@query(
    "src_nquads_parse",
    f"{WITH_G} select subject, predicate, object, object_type, coalesce(lang, '') as lang, "
    "coalesce(context, '') as context from g",
)
def src_nquads_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(
        graph(spark, sf_dir), ntriples.render_line(quads=True), scratch_path(spark, "quads")
    )
    parsed = files.read_ntriples(spark, [path], quads=True)
    return show_triples(parsed, *PARSED, "context")


def turtle_line() -> Column:
    """A triple as a line of Turtle that uses a prefix for its datatype."""
    line = ntriples.render_line()
    short = F.regexp_replace(line, rf"\^\^<{XSD}(\w+)>", r"^^xsd:$1")
    return F.concat(F.lit(f"@prefix xsd: <{XSD}> . "), short)


def write_turtle(df: DataFrame, path: str) -> str:
    """Turtle files of a bounded number of lines. The CSV writer is the one that lets
    the extension be chosen; its quote and separator are characters no line holds."""
    lines = df.select(turtle_line().alias("value")).write
    plain = {"extension": "ttl", "quote": "\u0000", "sep": "\u0001"}
    lines.options(maxRecordsPerFile=20_000, **plain).csv(path)
    return path


@query("src_whole_files", PARSED_SQL)
def src_whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_turtle(graph(spark, sf_dir), scratch_path(spark, "turtle"))
    return show_triples(files.read_whole_files(spark, [f"{path}/*.ttl"]), *PARSED)


@query("src_turtle_splits", PARSED_SQL)
def src_turtle_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, each read by as many tasks as it has splits."""
    path = write_turtle(graph(spark, sf_dir), scratch_path(spark, "turtle"))
    return show_triples(files.read_whole_files(spark, [f"{path}/*.ttl"], split_bytes=1), *PARSED)


@query("union_routes", PARSED_SQL)
def union_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "routes")
    half = F.pmod(F.xxhash64("subject"), F.lit(2))
    rows = graph(spark, sf_dir)
    write_lines(rows.filter(half == 0), ntriples.render_line(), f"{path}/by-line.nt")
    write_turtle(rows.filter(half == 1), f"{path}/whole")
    loaded = files.read_sources(spark, f"{path}/by-line.nt , {path}/whole/*.ttl,")
    return show_triples(loaded, *PARSED)


EXTENSION_SQL = (
    "case c_mktsegment when 'BUILDING' then 'nt' when 'MACHINERY' then 'ttl' "
    "when 'HOUSEHOLD' then 'txt' else 'data' end"
)


@query(
    "rejected_sources",
    "select c_custkey, 'unknown format' as reason from customer "
    f"where {EXTENSION_SQL} in ('txt', 'data')",
)
def rejected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the files that a load of some folders would pass over, by their paths."""
    path = scratch_path(spark, "rejected")
    customers = table(spark, sf_dir, "customer")
    extension = F.expr(EXTENSION_SQL)
    for name in ("nt", "ttl", "txt", "data"):
        rows = customers.filter(extension == name).select(F.col("c_custkey").cast("string"))
        rows.write.option("extension", name).csv(f"{path}/{name}")
    found = files.rejected_sources(spark, [f"{path}/*/*"])
    named = F.substring_index("path", "/", -1).alias("file_name")
    rows = spark.read.text([f"{path}/*/*"]).select("value", "_metadata.file_name")
    rows = rows.join(found.select(named, "reason"), "file_name")
    return rows.select(F.col("value").cast("bigint").alias("c_custkey"), "reason")


G_SQL_SHOWN = (
    f"{WITH_G} select subject, predicate, object, object_type, coalesce(lang, '') as lang, "
    "coalesce(context, '') as context, visibility, epoch_us(ts) as ts_us from "
)


@query("scan_index_spo", G_SQL_SHOWN + "g")
def scan_index_spo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ts(graph(spark, sf_dir))


@query("filter_property", G_SQL_SHOWN + f"g where predicate in ({in_sql(PROPERTIES)})")
def filter_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    return with_ts(sources.scan_index(spark, prefix, "po", predicates=PROPERTIES))


@query(
    "scan_filter",
    G_SQL_SHOWN + f"g where object_type in ('{ANYURI}', '{XSD}integer')",
)
def scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = [ANYURI, XSD + "integer"]
    return with_ts(triples.scan_filter(graph(spark, sf_dir), "object_type", types))


@query("filter_visibility", G_SQL_SHOWN + "v")
def filter_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ts(public_graph(spark, sf_dir))


@query("filter_visibility_auths", G_SQL_SHOWN + "g where visibility in ('', 'U')")
def filter_visibility_auths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ts(triples.visible(graph(spark, sf_dir), ("U", "FOUO")))


@query("filter_time_range", G_SQL_SHOWN + f"g where ts between {RANGE_SQL}")
def filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = flows.epoch_ms(spark, RANGE_START), flows.epoch_ms(spark, RANGE_END)
    return with_ts(triples.filter_time(graph(spark, sf_dir), start, end))


SPLIT_POINTS = ["urn:event#", "urn:order#", "urn:order#5", "urn:part#", "urn:user#"]


@query(
    "key_range_bucket",
    f"{WITH_G} select cast(len(list_filter([{in_sql(SPLIT_POINTS)}], lambda x: x <= subject)) "
    "as integer) as range_id, count(*) as n, min(subject) as first_key, "
    "max(subject) as last_key from g group by all",
)
def key_range_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranged = triples.key_ranges(graph(spark, sf_dir), F.col("subject"), SPLIT_POINTS)
    return ranged.groupBy("range_id").agg(
        F.count("*").alias("n"),
        F.min("subject").alias("first_key"),
        F.max("subject").alias("last_key"),
    )


@query(
    "split_points_from_table",
    f"{WITH_G} select subject, predicate, object, object_type, coalesce(lang, '') as lang, "
    "true as in_its_range, true as even from g",
)
def split_points_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges at points read from the zone map, against the files the rows lie in; no range
    has more than two of the parts they were asked for, and a file."""
    prefix, most = loaded_prefix(spark, sf_dir), 5
    points = sources.table_split_points(spark, prefix, "spo", most)
    rows = sources.read_run(spark, sources.index_paths(spark, prefix, "spo"), TRIPLE)
    ranged = triples.key_ranges(rows.select("*", "_metadata.file_name"), F.col("subject"), points)
    zones = sources.zone_map(spark, prefix).select(
        F.col("file").alias("file_name"), F.coalesce(F.col("low")[0], F.lit("")).alias("key"), "rows"
    )
    # a file lies in the range of its first key
    zones = triples.key_ranges(zones, F.col("key"), points, "of_file")
    sizes = zones.groupBy("of_file").agg(F.sum("rows").alias("n"))
    total, largest = zones.agg(F.sum("rows"), F.max("rows")).first()
    even = sizes.select("of_file", (F.col("n") <= 2 * total // most + largest).alias("even"))
    files = zones.join(even, "of_file").select("file_name", "of_file", "even")
    found = ranged.join(F.broadcast(files), "file_name")
    in_its_range = (F.col("range_id") == F.col("of_file")).alias("in_its_range")
    return show_triples(found.select("*", in_its_range), *PARSED, "in_its_range", "even")


@query("rebalance_rows", f"{WITH_G} select {SHOWN_TRIPLE_SQL} from g")
def rebalance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_triples(triples.rebalance(graph(spark, sf_dir)))


@query(
    "checkpoint_resolve",
    "select cast(floor(epoch(max(ts))) as bigint) * 1000 as start_ms, "
    "cast(floor(epoch(min(ts))) as bigint) * 1000 as given_ms from events",
)
def checkpoint_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    bounds = table(spark, sf_dir, "events").agg(
        F.min(seconds) * 1000, F.max(seconds) * 1000
    )
    first, last = bounds.first()
    path = scratch_path(spark, "checkpoint")
    for end_ms in (last, first, last, None):
        sinks.commit_checkpoint(spark, path, end_ms)
        if end_ms is not None and sources.read_checkpoint(spark, path) != end_ms:
            raise AssertionError("the last value stored must be the one that is read")
    resolved = (
        sources.read_checkpoint(spark, path),
        sources.read_checkpoint(spark, path, start_ms=first),
    )
    return spark.createDataFrame([resolved], "start_ms bigint, given_ms bigint")


# --- sinks --------------------------------------------------------------------


def all_layouts(spark: SparkSession, prefix: str, *names: str) -> DataFrame:
    """Every row of every index table."""
    shown = [
        show_triples(sources.scan_index(spark, prefix, name), *names).withColumn(
            "layout", F.lit(name)
        )
        for name in LAYOUTS
    ]
    return triples.union_triples(*shown)


def all_layouts_sql(columns: str) -> str:
    return f"{WITH_G} " + " union all ".join(
        f"select {columns}, '{name}' as layout from g" for name in LAYOUTS
    )


@query("index_layout_counts", all_layouts_sql(SHOWN_TRIPLE_SQL))
def index_layout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_layouts(spark, loaded_prefix(spark, sf_dir))


LOADED_SQL = all_layouts_sql(
    "subject, predicate, object, object_type, coalesce(lang, '') as lang"
)


@query("bulk_load", LOADED_SQL)
def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "load")
    write_lines(g_raw(spark, sf_dir), ntriples.render_line(), f"{path}/graph.nt")
    flows.bulk_load(spark, f"{path}/graph.nt", f"{path}/")
    return all_layouts(spark, f"{path}/", *PARSED)


@query("bulk_load_twice", LOADED_SQL)
def bulk_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the graph in two loads, none of them named, and one of them repeated."""
    path = scratch_path(spark, "load-twice")
    half = F.pmod(F.xxhash64("subject"), F.lit(2))
    for number in (0, 1):
        part = g_raw(spark, sf_dir).filter(half == number)
        write_lines(part, ntriples.render_line(), f"{path}/half{number}.nt")
    for number in (0, 1, 0):
        flows.bulk_load(spark, f"{path}/half{number}.nt", f"{path}/")
    return all_layouts(spark, f"{path}/", *PARSED)


MALFORMED_SQL = "concat('<urn:order#', cast(o_orderkey as varchar), '> <urn:unfinished')"


@query(
    "bulk_load_permissive",
    f"{WITH_G} select subject, predicate, object, '' as reason from g union all "
    f"select {MALFORMED_SQL}, '', '', 'malformed line' from orders where o_orderkey % 7 = 0",
)
def bulk_load_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that goes on at malformed lines, and the table that tells of them."""
    path = scratch_path(spark, "permissive")
    malformed = table(spark, sf_dir, "orders").filter("o_orderkey % 7 = 0")
    malformed = malformed.select(F.expr(MALFORMED_SQL.replace("varchar", "string")).alias("value"))
    lines = g_raw(spark, sf_dir).select(ntriples.render_line().alias("value"))
    lines.unionByName(malformed).write.text(f"{path}/graph.nt")
    flows.bulk_load(spark, f"{path}/graph.nt", f"{path}/", on_bad_line="PERMISSIVE")
    kept = sources.scan_index(spark, f"{path}/").select(*TRIPLE.names[:3], F.lit("").alias("reason"))
    none = F.lit("")
    # Spark's own marker file in the folder is among the rejects too
    left_out = sources.read_rejects(spark, f"{path}/").filter("line is not null").select(
        F.col("line").alias("subject"), none.alias("predicate"), none.alias("object"), "reason"
    )
    return kept.unionByName(left_out)


@query(
    "ensure_tables",
    f"{WITH_G} select 'ns' as name, cast(0 as bigint) as n union all select 'osp', count(*) from g "
    "union all select 'po', count(*) from g union all select 'spo', count(*) from g",
)
def ensure_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    sinks.ensure_tables(spark, prefix)
    counts = [
        sources.scan_index(spark, prefix, name)
        .agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("name"), "n")
        for name in (*LAYOUTS, "ns")
    ]
    return triples.union_triples(*counts)


@query("write_table_runs", G_SQL_SHOWN + "g")
def write_table_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = scratch_path(spark, "runs") + "/"
    half = F.pmod(F.xxhash64("subject"), F.lit(2))
    for number, run in ((0, "a"), (1, "b"), (0, "a")):
        part = graph(spark, sf_dir).filter(half == number)
        sinks.write_table(part, prefix + "spo", run)
    return with_ts(sources.scan_index(spark, prefix, "spo"))


@query(
    "write_routed",
    f"{WITH_G} select predicate, count(*) as n, min(subject) as first_subject, "
    "max(object) as last_object from g group by all",
)
def write_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "routed")
    sinks.write_routed(graph(spark, sf_dir), path, "predicate")
    return (
        spark.read.schema(TRIPLE)
        .parquet(path)
        .groupBy("predicate")
        .agg(
            F.count("*").alias("n"),
            F.min("subject").alias("first_subject"),
            F.max("object").alias("last_object"),
        )
    )


# --- projections --------------------------------------------------------------


@query(
    "normalise_terms",
    f"{WITH_G} select object_type, lang is null as no_lang, visibility, count(*) as n "
    f"from (select object_type, lang, '' as visibility from g) group by all",
)
def normalise_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = graph(spark, sf_dir).select(
        "subject",
        "predicate",
        "object",
        F.nullif(F.col("object_type"), F.lit(XSD_STRING)).alias("object_type"),
        "lang",
        "context",
    )
    stored = triples.require_not_null(triples.normalise(parsed), ["visibility", "ts"])
    keys = ["object_type", F.col("lang").isNull().alias("no_lang"), "visibility"]
    return stored.groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "index_rows_fanout",
    f"{WITH_G} select 'spo' as layout, subject as k1, predicate as k2, object as k3 from g "
    "union all select 'po', predicate, object, subject from g "
    "union all select 'osp', object, subject, predicate from g",
)
def index_rows_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples.index_rows(graph(spark, sf_dir))


@query(
    "extract_subject",
    f"{WITH_G}, k as (select concat(subject, chr(0), predicate, chr(0), object) as k from g "
    "union all select subject from g) "
    "select case when instr(k, chr(0)) > 0 then split_part(k, chr(0), 1) end as subject, "
    "count(*) as n from k group by all",
)
def extract_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.array(terms.encode_row_key("spo"), F.col("subject"))
    rows = graph(spark, sf_dir).select(F.explode(keys).alias("row_key"))
    subject = terms.extract_subject(F.col("row_key")).alias("subject")
    return rows.groupBy(subject).agg(F.count("*").alias("n"))


@query("row_key_round_trip", f"{WITH_G} select subject, predicate, object from g")
def row_key_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = graph(spark, sf_dir)
    for layout in LAYOUTS:
        keys = rows.select(terms.encode_row_key(layout).alias("row_key"))
        rows = keys.select(*terms.decode_row_key(F.col("row_key"), layout))
    return rows


@query(
    "prospect_rows",
    f"{WITH_G}, p as ({prospects_sql('v')}) select triple_value_type, data_type, "
    "count(*) as n, min(data) as first_data, max(data) as last_data from p group by all",
)
def prospect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = show_prospects(prospects.explode_prospects(public_graph(spark, sf_dir)))
    return rows.groupBy("triple_value_type", "data_type").agg(
        F.sum("count").alias("n"),
        F.min("data").alias("first_data"),
        F.max("data").alias("last_data"),
    )


@query(
    "entity_namespace",
    f"{WITH_G} select {NAMESPACE_SQL} as namespace, count(*) as n from g group by all",
)
def entity_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = terms.entity_namespace(F.col("subject")).alias("namespace")
    return graph(spark, sf_dir).groupBy(namespace).agg(F.count("*").alias("n"))


@query(
    "prospect_table_rows",
    f"{WITH_G}, p as ({prospects_sql('v')}) select concat(triple_value_type, '|', data) as "
    "row_key, 'count' as family, data_type as qualifier, visibility, "
    "cast(count(*) as varchar) as value from p group by triple_value_type, data, data_type, visibility",
)
def prospect_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prospects.prospect_counts(public_graph(spark, sf_dir))
    rows = prospects.prospect_to_row(counts).drop("updated_at")
    shown = F.replace("row_key", F.lit(DELIM), F.lit("|"))
    return rows.withColumn("row_key", shown)


@query(
    "object_kind",
    f"{WITH_G} select case when object_type = '{ANYURI}' then 'iri' when lang is not null "
    "then 'lang' else 'typed' end as kind, object_type, count(*) as n from g group by all",
)
def object_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = terms.object_kind(F.col("object_type"), F.col("lang")).alias("kind")
    return graph(spark, sf_dir).groupBy(kind, "object_type").agg(F.count("*").alias("n"))


@query(
    "property_field",
    f"{WITH_G} select concat('p_', predicate) as field, count(*) as n from g group by all",
)
def property_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = terms.property_field(F.col("predicate")).alias("field")
    return graph(spark, sf_dir).groupBy(field).agg(F.count("*").alias("n"))


@query(
    "iso_epoch_ms",
    "with d as (select o_orderkey, concat(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), case "
    "o_orderkey % 4 when 0 then 'Z' when 1 then '.987+02:00' when 2 then "
    "'-05:30[America/New_York]' else '+01:00[Europe/Paris]' end) as iso from orders) "
    "select o_orderkey, iso, cast(floor(epoch(cast(regexp_replace(iso, '\\[.*', '') as "
    "timestamptz))) as bigint) * 1000 as ms from d",
)
def iso_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = ("Z", ".987+02:00", "-05:30[America/New_York]", "+01:00[Europe/Paris]")
    zone = F.get(F.array(*[F.lit(z) for z in zones]), (F.col("o_orderkey") % 4).cast("int"))
    local = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    dates = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(local, zone).alias("iso")
    )
    return dates.withColumn("ms", terms.iso_to_epoch_ms(F.col("iso")))


@query("require_not_null", f"{WITH_G} select predicate, count(*) as n from g group by all")
def require_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = triples.require_not_null(graph(spark, sf_dir), TRIPLE.names[:4])
    return checked.groupBy("predicate").agg(F.count("*").alias("n"))


# --- lookups and joins ----------------------------------------------------------

PATTERNS = {
    "match_pattern_sp": {"subject": "urn:user#1", "predicate": DID},
    "match_pattern_po": {"predicate": STATUS, "obj": "F"},
    "match_pattern_o": {"obj": "urn:customer#1"},
    "match_pattern_spo": {
        "subject": "urn:order#1",
        "predicate": PLACED_BY,
        "obj": "urn:customer#769",
    },
}


def pattern_sql(pattern: dict[str, str]) -> str:
    bound = {("object" if k == "obj" else k): v for k, v in pattern.items()}
    where = " and ".join(f"{name} = '{value}'" for name, value in bound.items())
    return f"{WITH_G} select {SHOWN_TRIPLE_SQL} from g where {where}"


def match_pattern(pattern: dict[str, str], spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_triples(sources.lookup(spark, loaded_prefix(spark, sf_dir), **pattern))


for _name, _pattern in PATTERNS.items():
    query(_name, pattern_sql(_pattern))(partial(match_pattern, _pattern))


@query(
    "match_pattern_any_type",
    f"{WITH_G} select {SHOWN_TRIPLE_SQL} from g where object in "
    "('urn:customer#1', 'FRANCE', 'ASIA', '7')",
)
def match_pattern_any_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of all kinds: an IRI, a text with a language, a string and an integer."""
    index = sources.scan_index(spark, loaded_prefix(spark, sf_dir), "osp")
    wanted = ("urn:customer#1", "FRANCE", "ASIA", "7")
    found = [triples.match_pattern(index, obj=o) for o in wanted]
    return show_triples(triples.union_triples(*found))


def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.changed_subject_triples(
        public_graph(spark, sf_dir),
        [DID],
        flows.epoch_ms(spark, RANGE_START),
        flows.epoch_ms(spark, RANGE_END),
    )


@query(
    "changed_subjects_semi_join",
    f"{WITH_G}, c as ({CHANGED_SQL}) select {SHOWN_TRIPLE_SQL} from c",
)
def changed_subjects_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_triples(changed(spark, sf_dir))


REQUESTS_SQL = (
    "select 'subject' as triple_value_type, concat('urn:customer#', cast(c_custkey as varchar)) "
    f"as data, '{ANYURI}' as data_type from customer "
    "union select 'object', concat('urn:customer#', cast(c_custkey as varchar)), "
    f"'{ANYURI}' from customer "
    "union select 'subjectpredicate', concat('urn:customer#', cast(c_custkey as varchar), '|', "
    f"'{LABEL}'), '{XSD_STRING}' from customer "
    f"union select 'predicateobject', concat('{STATUS}', '|', o_orderstatus), '{XSD_STRING}' from orders "
    f"union select 'object', o_orderpriority, '{XSD_STRING}' from orders"
)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups made from the tables; some of them ask for what was never counted."""
    iri = F.concat(F.lit("urn:customer#"), F.col("c_custkey").cast("string"))

    def ask(name: str, data_type: str, *asked: Column) -> Column:
        return F.struct(
            F.lit(name).alias("triple_value_type"),
            F.array(*asked).alias("terms"),
            F.lit(data_type).alias("data_type"),
        )

    by_customer = F.array(
        ask("subject", ANYURI, iri),
        ask("object", ANYURI, iri),
        ask("subjectpredicate", XSD_STRING, iri, F.lit(LABEL)),
    )
    by_order = F.array(
        ask("predicateobject", XSD_STRING, F.lit(STATUS), F.col("o_orderstatus")),
        ask("object", XSD_STRING, F.col("o_orderpriority")),
    )
    return (
        table(spark, sf_dir, "customer")
        .select(F.inline(by_customer))
        .unionByName(table(spark, sf_dir, "orders").select(F.inline(by_order)))
    )


COUNTED_SQL = (
    f"{WITH_G}, p as ({prospects_sql('v')}), c as (select triple_value_type, data, data_type, "
    "visibility, count(*) as count from p group by all), "
    f"r as ({REQUESTS_SQL})"
)


@query(
    "lookup_prospects",
    f"{COUNTED_SQL} select c.* from c join r using (triple_value_type, data, data_type)",
)
def lookup_prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = requests(spark, sf_dir)
    counts = prospects.asked_counts(public_graph(spark, sf_dir), asked)
    return show_prospects(prospects.lookup_prospects(counts, asked))


@query(
    "cardinality_estimate",
    f"{COUNTED_SQL} select triple_value_type, data, data_type, "
    "coalesce(cast(count as double), -1.0) as cardinality "
    "from r left join c using (triple_value_type, data, data_type)",
)
def cardinality_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = requests(spark, sf_dir)
    counts = prospects.asked_counts(public_graph(spark, sf_dir), asked)
    found = prospects.cardinality(counts, asked)
    return found.withColumn("data", F.replace("data", F.lit(DELIM), F.lit("|")))


# --- aggregations ---------------------------------------------------------------


@query("prospect_counts", counts_sql())
def prospect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_prospects(prospects.prospect_counts(public_graph(spark, sf_dir)))


def count_type(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_prospects(prospects.count_by_type(public_graph(spark, sf_dir), name))


COUNT_QUERIES = {
    "count_subject": "subject",
    "count_predicate": "predicate",
    "count_object": "object",
    "count_subject_predicate": "subjectpredicate",
    "count_subject_object": "subjectobject",
    "count_predicate_object": "predicateobject",
    "count_entity": "entity",
}
for _name, _type in COUNT_QUERIES.items():
    query(_name, counts_sql(types=(_type,)))(partial(count_type, _type))


@query("dedup_triples", G_SQL_SHOWN + "g")
def dedup_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ts(triples.dedup_triples(g_raw(spark, sf_dir)))


BATCH = 100


@query(
    "local_batches",
    f"{WITH_G} select count(*) as n, true as within_size, true as enough_batches from g_raw",
)
def local_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = triples.local_batches(g_raw(spark, sf_dir), BATCH).groupBy("batch_id")
    sizes = batches.agg(F.count("*").alias("size"))
    return sizes.agg(
        F.sum("size").alias("n"),
        (F.max("size") <= BATCH).alias("within_size"),
        (F.count("*") * BATCH >= F.sum("size")).alias("enough_batches"),
    )


def groups_sql(budget: int) -> str:
    return (
        f"{WITH_G} select subject, part, count(*) as n, "
        f"string_agg(object, '|' order by {ROW_ORDER_SQL}) as objects "
        f"from ({part_sql('v', budget)}) group by subject, part"
    )


@query("group_by_subject", groups_sql(WHOLE))
def group_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    return show_groups(sources.grouped_by_subject(spark, prefix, WHOLE))


@query("group_by_subject_parts", groups_sql(SMALL_PART))
def group_by_subject_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    return show_groups(sources.grouped_by_subject(spark, prefix, SMALL_PART))


@query("group_by_subject_exchange", groups_sql(SMALL_PART))
def group_by_subject_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of rows in no order."""
    rows = public_graph(spark, sf_dir)
    return show_groups(documents.group_by_subject(rows, part_chars=SMALL_PART))


@query("group_by_subject_two_runs", groups_sql(SMALL_PART))
def group_by_subject_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of an index of two runs, which share some triples; then merged into one."""
    path = scratch_path(spark, "group-two") + "/"
    part = F.pmod(F.xxhash64("object"), F.lit(3))
    for number in (0, 1):
        # a run makes one of equal triples itself: no other copy of the graph is written for it
        sinks.write_indexes(g_raw(spark, sf_dir).filter(part != number), path)
    before = show_groups(sources.grouped_by_subject(spark, path, SMALL_PART))
    sinks.compact_index(spark, path)
    after = show_groups(sources.grouped_by_subject(spark, path, SMALL_PART))
    # a part of a subject comes once, and no column is null: the rows that both have
    return before.join(after, before.columns, "left_semi")


# --- documents --------------------------------------------------------------------


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    return triples.visible(sources.scan_index(spark, prefix, predicates=PROPERTIES))


@query(
    "fulltext_docs",
    f"{WITH_G}, l as ({listed_sql()}), d as ({part_sql('l', WHOLE)}) "
    + documents_sql("select * from d"),
)
def fulltext_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    flows.fulltext_full(spark, loaded_prefix(spark, sf_dir), PROPERTIES, path)
    return show_documents(values(spark, path))


@query(
    "fulltext_docs_parts",
    f"{WITH_G}, l as ({listed_sql()}), d as ({part_sql('l', SMALL_PART)}) "
    + documents_sql("select * from d"),
)
def fulltext_docs_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    return show_documents(sources.nested_documents(spark, prefix, PROPERTIES, SMALL_PART))


@query(
    "fulltext_text",
    f"{WITH_G}, l as ({listed_sql()}) select subject as id, cast(0 as bigint) as part, "
    f"string_agg(object, '|' order by {ROW_ORDER_SQL}) as text from l where {LITERAL_SQL} "
    "group by subject",
)
def fulltext_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    docs = sources.nested_documents(spark, prefix, PROPERTIES, WHOLE)
    return docs.select("id", "part", F.array_join("text", "|").alias("text"))


EVERY_PREDICATE = [PLACED_BY, STATUS, "urn:event-p#by"]


@query(
    "fulltext_iri_values",
    f"{WITH_G} select subject as id, count(*) filter (where {LITERAL_SQL}) as n_values, "
    f"coalesce(string_agg(object, '|' order by {ROW_ORDER_SQL}) filter (where {LITERAL_SQL}), '') "
    f"as text from v where predicate in ({in_sql(EVERY_PREDICATE)}) group by subject",
)
def fulltext_iri_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = loaded_prefix(spark, sf_dir)
    docs = sources.nested_documents(spark, prefix, EVERY_PREDICATE, WHOLE)
    return docs.select(
        "id",
        F.size("text").cast("bigint").alias("n_values"),
        F.array_join("text", "|").alias("text"),
    )


@query(
    "fulltext_json",
    f"{WITH_G}, l as ({listed_sql()} and {LITERAL_SQL}), f as (select subject, predicate, "
    f"list(object order by {ROW_ORDER_SQL}) as vs from l group by subject, predicate), "
    f"t as (select subject, list(object order by {ROW_ORDER_SQL}) as vs from l group by subject), "
    "j as (select subject, string_agg(concat(to_json(concat('p_', predicate)), ':', "
    "to_json(vs)), ',' order by predicate) as fields from f group by subject) "
    "select subject as id, concat('{\"context\":\"null\",\"text\":', to_json(vs), "
    "',\"uri\":', to_json(subject), ',', fields, '}') as json from t join j using (subject)",
)
def fulltext_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = nested(documents.document_values(listed(spark, sf_dir)))
    return documents.document_json(docs).select("id", "json")


@query(
    "fulltext_docs_incremental",
    f"{WITH_G}, c as ({CHANGED_SQL}), d as ({part_sql('c', WHOLE)}) "
    + documents_sql("select * from d"),
)
def fulltext_docs_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "incremental")
    flows.fulltext_incremental(
        spark,
        loaded_prefix(spark, sf_dir),
        [DID],
        destination=f"{path}/documents",
        checkpoint=f"{path}/checkpoint",
        end=RANGE_END,
        start=RANGE_START,
    )
    return show_documents(values(spark, f"{path}/documents"))


EARLY_SQL = f"ts <= timestamp '{SPLIT_TIME}'"
UPSERTED_SQL = (
    f"{WITH_G}, l as ({listed_sql()}), "
    f"old_rows as (select * from l where {EARLY_SQL}), "
    f"new_rows as (select * from l where not ({EARLY_SQL})), "
    "kept as (select * from old_rows where subject not in (select subject from new_rows)), "
    "rows as (select *, cast(0 as bigint) as part from kept union all "
    "select *, cast(0 as bigint) from new_rows) "
)


def early_and_late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = listed(spark, sf_dir)
    split = F.timestamp_millis(F.lit(SPLIT_TIME_MS))
    early = documents.document_values(rows.filter(F.col("ts") <= split))
    return early, documents.document_values(rows.filter(F.col("ts") > split))


@query("upsert_documents", UPSERTED_SQL + documents_sql("select * from rows"))
def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = early_and_late(spark, sf_dir)
    return show_documents(nested(documents.upsert_documents(early, late)))


@query("upsert_documents_table", UPSERTED_SQL + documents_sql("select * from rows"))
def upsert_documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = early_and_late(spark, sf_dir)
    path = scratch_path(spark, "upserted")
    sinks.write_documents(early, path)
    sinks.write_documents(late, path)
    return show_documents(values(spark, path))


TIERED_SQL = (
    f"{WITH_G}, l as ({listed_sql()}), s as (select *, case when {EARLY_SQL} then "
    "cast(ascii(right(subject, 1)) as bigint) % 5 else 9 end as slice from l), "
    "last as (select subject, max(slice) as slice from s group by subject), "
    "rows as (select s.*, cast(0 as bigint) as part from s join last using (subject, slice)) "
)


@query("upsert_documents_tiers", TIERED_SQL + documents_sql("select * from rows"))
def upsert_documents_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written in six small runs, of which the last replaces some of the others; runs
    are merged by size meanwhile."""
    path = scratch_path(spark, "tiered")
    rows = listed(spark, sf_dir)
    early = F.col("ts") <= F.timestamp_millis(F.lit(SPLIT_TIME_MS))
    slice_ = F.when(early, F.ascii(F.right("subject", F.lit(1))) % 5).otherwise(9)
    for number in (0, 1, 2, 3, 4, 9):
        sinks.write_documents(documents.document_values(rows.filter(slice_ == number)), path)
    if len(sources.run_paths(spark, path)) >= 6:
        raise AssertionError("runs of one size must be merged")
    return show_documents(values(spark, path))


# --- statistics jobs ----------------------------------------------------------------


@query("statistics", counts_sql())
def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "statistics")
    flows.statistics(spark, loaded_prefix(spark, sf_dir), path)
    return show_prospects(sources.read_prospects(spark, path))


@query("stats_two_step", counts_sql())
def stats_two_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "two-step")
    flows.statistics_fetch_only(spark, loaded_prefix(spark, sf_dir), f"{path}/files")
    flows.statistics_combine(spark, f"{path}/files", f"{path}/counts")
    return show_prospects(sources.read_prospects(spark, f"{path}/counts"))


@query("merge_prospects_add", counts_sql())
def merge_prospects_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the graph counted apart and added; one of them is run twice."""
    path = scratch_path(spark, "merged")
    half = F.pmod(F.xxhash64("subject"), F.lit(2))
    for number, run in ((0, "a"), (1, "b"), (1, "b")):
        part = public_graph(spark, sf_dir).filter(half == number)
        sinks.write_prospects(prospects.prospect_counts(part), path, run)
    return show_prospects(sources.read_prospects(spark, path))


@query("merge_after_compaction", counts_sql())
def merge_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table remembers what was merged: runs repeated after it add nothing."""
    path = scratch_path(spark, "compacted")
    half = F.pmod(F.xxhash64("subject"), F.lit(2))

    def add(number: int, run: str) -> None:
        part = public_graph(spark, sf_dir).filter(half == number)
        sinks.write_prospects(prospects.prospect_counts(part), path, run)

    add(0, "a")
    sinks.compact_prospects(spark, path)
    for number, run in ((0, "a"), (1, "b"), (0, "a")):
        add(number, run)
    sinks.compact_prospects(spark, path)
    add(1, "b")
    return show_prospects(sources.read_prospects(spark, path))


@query("merge_prospects_tiers", counts_sql())
def merge_prospects_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of many small runs, which are merged by size as they are added."""
    path = scratch_path(spark, "tiers")
    part = F.pmod(F.xxhash64("subject"), F.lit(9))
    for number in range(9):
        rows = public_graph(spark, sf_dir).filter(part == number)
        sinks.write_prospects(prospects.prospect_counts(rows), path)
    if len(sources.run_paths(spark, path)) >= 9:
        raise AssertionError("runs of one size must be merged")
    return show_prospects(sources.read_prospects(spark, path))


NO_NAMESPACE_SQL = "(select * replace (replace(subject, 'urn:customer#', 'customer') as subject) from v)"


@query(
    "statistics_skip_bad_iri",
    f"{counts_sql(NO_NAMESPACE_SQL)} having data is not null",
)
def statistics_skip_bad_iri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects without a namespace have no entity count where they are to be skipped."""
    path = scratch_path(spark, "skipped")
    bare = F.replace("subject", F.lit("urn:customer#"), F.lit("customer"))
    # equal triples become one in this load: no other copy of the graph is written for it
    sinks.write_indexes(g_raw(spark, sf_dir).withColumn("subject", bare), f"{path}/")
    flows.statistics(spark, f"{path}/", f"{path}/counts", on_bad_iri="skip")
    return show_prospects(sources.read_prospects(spark, f"{path}/counts"))


ALL_PUBLIC_SQL = "(select * replace ('' as visibility) from g)"


@query("load_and_stats", counts_sql(ALL_PUBLIC_SQL))
def load_and_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "load-stats")
    write_lines(g_raw(spark, sf_dir), ntriples.render_line(), f"{path}/graph.nt")
    counts = f"{path}/counts"
    flows.bulk_load_with_statistics(spark, f"{path}/graph.nt", f"{path}/", counts)
    return show_prospects(sources.read_prospects(spark, counts))


@query("load_twice_exact", counts_sql(ALL_PUBLIC_SQL))
def load_twice_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of two loads that share a third of their triples: each triple counts once."""
    path = scratch_path(spark, "load-exact")
    part = F.pmod(F.xxhash64("subject", "object"), F.lit(3))
    for number in (0, 1):
        rows = g_raw(spark, sf_dir).filter(part != number)
        write_lines(rows, ntriples.render_line(), f"{path}/part{number}.nt")
    for number in (0, 1, 0):
        flows.bulk_load_with_statistics(
            spark, f"{path}/part{number}.nt", f"{path}/", f"{path}/counts", counting="new"
        )
    return show_prospects(sources.read_prospects(spark, f"{path}/counts"))


# --- streams ------------------------------------------------------------------------


@query("stream_ingest", PARSED_SQL.replace(" from g", " from g_raw"))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ingest")
    write_lines(g_raw(spark, sf_dir), ntriples.render_line(), f"{path}/in")
    stream = refresh.stream_lines(spark, f"{path}/in")
    refresh.ingest(stream, f"{path}/out", f"{path}/state").awaitTermination()
    return show_triples(spark.read.schema(TRIPLE).parquet(f"{path}/out"), *PARSED)


@query("stream_ingest_distinct", PARSED_SQL)
def stream_ingest_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ingest-distinct")
    write_lines(g_raw(spark, sf_dir), ntriples.render_line(), f"{path}/in")
    stream = refresh.stream_lines(spark, f"{path}/in")
    refresh.ingest(stream, f"{path}/out", f"{path}/state", distinct=True).awaitTermination()
    return show_triples(spark.read.schema(TRIPLE).parquet(f"{path}/out"), *PARSED)


@query(
    "stream_refresh_docs",
    f"{WITH_G}, l as ({listed_sql()}), d as ({part_sql('l', WHOLE)}) "
    + documents_sql("select * from d"),
)
def stream_refresh_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix, path = loaded_prefix(spark, sf_dir), scratch_path(spark, "refresh")
    refresh.refresh_from_runs(
        spark, prefix, PROPERTIES, f"{path}/documents", f"{path}/state"
    ).awaitTermination()
    return show_documents(values(spark, f"{path}/documents"))


@query("stream_refresh_two_runs", ORACLES["stream_refresh_docs"])
def stream_refresh_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after two loads, refreshed after each, equal those of the whole graph."""
    path = scratch_path(spark, "refresh-two")
    half = F.pmod(F.xxhash64("object"), F.lit(2))
    for number in (0, 1):
        sinks.write_indexes(graph(spark, sf_dir).filter(half == number), f"{path}/")
        refresh.refresh_from_runs(
            spark, f"{path}/", PROPERTIES, f"{path}/documents", f"{path}/state"
        ).awaitTermination()
    return show_documents(values(spark, f"{path}/documents"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prospect counts of the graph, straight from the driver's tables."""
    return show_prospects(prospects.prospect_counts(triples.visible(g(spark, sf_dir))))
