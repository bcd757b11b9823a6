"""Reading RDF files: routing by name, line formats, whole-file formats."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triples.functions import ntriples
from spark_triples.functions.terms import or_fail
from spark_triples.operators.triples import normalise, union_triples
from spark_triples.schema import TRIPLE
from spark_triples.session import glob
from spark_triples.sources import turtle, turtle_splits
from spark_triples.sources.turtle import parse_turtle

# the parser travels with its tasks: executors need not have this package installed
cloudpickle.register_pickle_by_value(turtle)
cloudpickle.register_pickle_by_value(turtle_splits)

# --- Fixed values: file extensions of the RDF formats ------------------------
LINE_EXTENSION = "nt"
EXTENSIONS = {
    "nt": "N-Triples",
    "nq": "N-Quads",
    "ttl": "Turtle",
    "rdf": "RDF/XML",
    "rdfs": "RDF/XML",
    "owl": "RDF/XML",
    "xml": "RDF/XML",
    "n3": "N3",
    "trix": "TriX",
    "trig": "TriG",
    "brf": "BinaryRDF",
    "jsonld": "JSON-LD",
    "rj": "RDF/JSON",
    "xhtml": "RDFa",
    "html": "RDFa",
}
# -----------------------------------------------------------------------------

WILDCARD = r"[*?\[{]"
# Spark's readers pass over such files without a word.
HIDDEN = ("_", ".")
LONGEST_FILE = (1 << 31) - 1
# Longer Turtle files are read by many tasks.
SPLIT_BYTES = 256 << 20
# So many whole files are parsed for a sample.
FEW_FILES = 32
MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")
BATCH = 10_000
Parser = Callable[[bytes, str], Iterator[tuple]]


def split_list(spec: Column) -> Column:
    """Patterns of a comma-separated list; blanks around commas and empty pieces go."""
    return F.filter(F.split(spec, r"\s*,\s*"), lambda piece: piece != "")


def split_sources(spec: str) -> list[str]:
    """The same for a source option, which is read before any job runs."""
    pieces = spec.split(",")
    return [piece.strip() for piece in pieces if piece.strip()]


def _extension(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.when(
        F.contains(name, F.lit(".")), F.lower(F.substring_index(name, ".", -1))
    )


def route(path: Column) -> Column:
    """``line`` for N-Triples names and patterns, ``file`` for all others."""
    return F.when(_extension(path) == LINE_EXTENSION, "line").otherwise("file")


def route_sources(paths: DataFrame) -> DataFrame:
    return paths.select("path", route(F.col("path")).alias("route"))


def rdf_format(path: Column) -> Column:
    """Name of the format a file's extension stands for; null if unknown."""
    known = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    return F.try_element_at(known, _extension(path))


def parse_lines(
    lines: DataFrame, mode: str = "FAILFAST", quads: bool = False
) -> DataFrame:
    """``lines(value, file_path)`` as triples. ``FAILFAST`` fails the job at a malformed
    line, ``DROPMALFORMED`` leaves it out, ``PERMISSIVE`` keeps it in ``_corrupt``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    value = F.col("value")
    # generated rather than projected: a filter on a projected match would be pushed
    # below it and match every line a second time
    matched = F.explode(F.array(ntriples.match_line(value, quads))).alias("_fields")
    statements = lines.filter(ntriples.is_statement_line(value)).select(
        "value", "file_path", matched
    )
    fields = F.col("_fields")
    good = ntriples.is_well_formed(fields)
    if mode == "FAILFAST":
        message = F.concat(F.lit("malformed line in "), "file_path", F.lit(": "), value)
        statements = statements.filter(or_fail(good, message))
    elif mode == "DROPMALFORMED":
        statements = statements.filter(good)
    scope = ntriples.bnode_scope(F.col("file_path"))
    columns = ntriples.triple_columns(fields, scope)
    if mode != "PERMISSIVE":
        return normalise(statements.select(*columns))
    names = [n for n in TRIPLE.names if n not in ("visibility", "ts")]
    kept = [F.when(good, c).alias(n) for c, n in zip(columns, names, strict=True)]
    corrupt = F.when(~good, value).alias("_corrupt")
    return normalise(statements.select(*kept, corrupt), keep=("_corrupt",))


def malformed_lines(lines: DataFrame, quads: bool = False) -> DataFrame:
    """(path, reason, line) of the lines that are no statements."""
    value = F.col("value")
    good = ntriples.is_well_formed(ntriples.match_line(value, quads))
    return lines.filter(ntriples.is_statement_line(value) & ~good).select(
        F.col("file_path").alias("path"), F.lit("malformed line").alias("reason"), value.alias("line")
    )


def _is_hidden(path: str) -> bool:
    return path.rsplit("/", 1)[-1].startswith(HIDDEN)


def _matches(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Paths to read for the patterns. A wildcard may match nothing; directories it
    matches are left out, so that only files at the pattern's own depth are read. A
    directory named outright stands for its files."""
    found = []
    for pattern in patterns:
        entries = glob(spark, pattern)
        if not re.search(WILDCARD, pattern):
            if not entries:
                raise FileNotFoundError(pattern)
            if not entries[0].is_dir and _is_hidden(pattern):
                raise ValueError(f"{pattern}: files named _… or .… are not read; rename it")
            found.append(pattern)
            continue
        files = [e.path for e in entries if not e.is_dir]
        if files:
            found += [pattern] if len(files) == len(entries) else files
    return found


def name_filter(format_name: str | None) -> dict[str, str]:
    """Reader options that list only the files of a format, in any case of its
    extensions, so that the content of the others is never read."""
    if format_name is None:
        return {}
    endings = [
        "".join(f"[{c}{c.upper()}]" for c in extension)
        for extension, name in EXTENSIONS.items()
        if name == format_name
    ]
    return {"pathGlobFilter": "*.{" + ",".join(endings) + "}"}


def read_lines(
    spark: SparkSession,
    patterns: list[str],
    format_name: str | None = None,
    share: float = 1.0,
) -> DataFrame:
    """(value, file_path) of text files, or of a share of their lines. Large files are split
    between tasks."""
    paths = _matches(spark, patterns)
    if not paths:
        return spark.createDataFrame([], "value string, file_path string")
    lines = spark.read.options(**name_filter(format_name)).text(paths).select(
        "value", F.col("_metadata.file_path").alias("file_path")
    )
    return lines if share >= 1 else lines.sample(share, seed=7)


def read_ntriples(
    spark: SparkSession,
    patterns: list[str],
    mode: str = "FAILFAST",
    quads: bool = False,
    share: float = 1.0,
) -> DataFrame:
    """Triples of N-Triples (or N-Quads) files, or of a share of their lines."""
    return parse_lines(read_lines(spark, patterns, share=share), mode, quads)


def _parse_with(parser: Parser, names: list[str]) -> Callable:
    """The function a task runs over the files it is given, a few at a time."""
    size = BATCH

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for path, content in zip(files["path"], files["content"], strict=True):
                triples = parser(content, path)
                while rows := list(islice(triples, size)):
                    yield pd.DataFrame(rows, columns=names)

    return parse


def list_sources(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """(path, format, length) of the files the patterns match; contents are not read."""
    paths = _matches(spark, patterns)
    if not paths:
        return spark.createDataFrame([], "path string, format string, length long")
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    return files.select("path", rdf_format(F.col("path")).alias("format"), "length")


def rejected_sources(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """(path, reason) of what a read skips: directories, hidden names, and names of no known
    format, except where the pattern says that lines are read."""
    skipped = []
    whole = [p for p in patterns if not p.lower().endswith("." + LINE_EXTENSION)]
    for pattern in patterns:
        by_wildcard = re.search(WILDCARD, pattern) is not None
        for e in glob(spark, pattern):
            if e.is_dir and by_wildcard:
                skipped.append((e.path, "directory"))
            elif e.is_dir:
                inside = glob(spark, f"{e.path}/*")
                skipped += [(x.path, "hidden name") for x in inside if _is_hidden(x.path)]
            elif _is_hidden(e.path):
                skipped.append((e.path, "hidden name"))
    if not whole:
        return spark.createDataFrame(skipped, "path string, reason string")
    unknown = list_sources(spark, whole).filter(F.col("format").isNull())
    return spark.createDataFrame(skipped, "path string, reason string").unionByName(
        unknown.select("path", F.lit("unknown format").alias("reason"))
    )


def read_whole_files(
    spark: SparkSession,
    patterns: list[str],
    parsers: dict[str, Parser] | None = None,
    mode: str = "FAILFAST",
    share: float = 1.0,
    split_bytes: int | None = None,
) -> DataFrame:
    """Triples of files whose own name stands for an RDF format; see
    :func:`rejected_sources` for the others.

    A parser gets the bytes and the path of one file and yields its triples as
    (subject, predicate, object, object_type, lang, context). Line formats need none:
    their files are read by line, so their size is of no matter. A file of a known
    format without a parser fails here, before anything is read. Turtle files of more than
    ``split_bytes`` (SPLIT_BYTES) are parsed by many tasks, unless another parser is given for them. With a ``share``,
    only that share of lines and of files is parsed (all files, if they are few).
    """
    parsers = {"Turtle": parse_turtle, **(parsers or {})}
    longest = F.max(F.struct("length", "path")).alias("longest")
    formats = list_sources(spark, patterns).groupBy("format").agg(longest, F.count("*").alias("n"))
    # bounded by the number of formats
    listed = {row["format"]: row for row in formats.collect()}
    present = set(listed) - {None}
    missing = present - set(parsers) - {"N-Triples", "N-Quads"}
    if missing:
        raise ValueError(f"no parser given for {', '.join(sorted(missing))}")
    in_parts, split_bytes = parsers["Turtle"] is parse_turtle, split_bytes or SPLIT_BYTES
    for name in present & set(parsers) - ({"Turtle"} if in_parts else set()):
        if (file := listed[name]["longest"])["length"] > LONGEST_FILE:
            raise ValueError(f"{file['path']}: too long for a whole-file format")
    parts = []
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in TRIPLE.names[:6]]
    )
    for name in sorted(present):
        if name in parsers:
            files = spark.read.format("binaryFile").options(**name_filter(name))
            paths = _matches(spark, patterns)
            split = name == "Turtle" and in_parts and listed[name]["longest"]["length"] > split_bytes
            contents = files.load(paths)
            if split:
                contents = contents.filter(F.col("length") <= split_bytes)
            contents = contents.select("path", "content")
            of_files = max(share, FEW_FILES / listed[name]["n"])
            contents = contents if of_files >= 1 else contents.sample(of_files, seed=7)
            parsed = contents.mapInPandas(_parse_with(parsers[name], schema.names), schema)
            if split:
                large = turtle_splits.read_turtle(spark, paths, name_filter(name), split_bytes, share)
                parsed = parsed.unionByName(large)
            rows = normalise(parsed)
            if mode == "PERMISSIVE":
                rows = rows.withColumn("_corrupt", F.lit(None).cast("string"))
            parts.append(rows)
        else:
            lines = read_lines(spark, patterns, name, share)
            parts.append(parse_lines(lines, mode, quads=name == "N-Quads"))
    if not parts:
        corrupt = [T.StructField("_corrupt", T.StringType())] * (mode == "PERMISSIVE")
        return spark.createDataFrame([], T.StructType([*TRIPLE.fields, *corrupt]))
    return union_triples(*parts)


def read_sources(
    spark: SparkSession,
    spec: str,
    parsers: dict[str, Parser] | None = None,
    mode: str = "FAILFAST",
    share: float = 1.0,
) -> DataFrame:
    """Triples of all patterns of a source option, each by the route of its name; with a
    ``share``, a sample of them."""
    patterns = split_sources(spec)
    by_line = [p for p in patterns if p.lower().endswith("." + LINE_EXTENSION)]
    whole = [p for p in patterns if p not in by_line]
    parts = []
    if by_line or not whole:
        parts.append(read_ntriples(spark, by_line, mode, share=share))
    if whole:
        parts.append(read_whole_files(spark, whole, parsers, mode, share))
    return union_triples(*parts)


def rejected_lines(spark: SparkSession, spec: str) -> DataFrame:
    """(path, reason, line) of the malformed lines of a source option. Lines alone are matched:
    whole-file parsers fail the job."""
    patterns = split_sources(spec)
    by_line = [p for p in patterns if p.lower().endswith("." + LINE_EXTENSION)]
    whole = [p for p in patterns if p not in by_line]
    parts = [malformed_lines(read_lines(spark, by_line))] if by_line else []
    for name in ("N-Triples", "N-Quads") if whole else ():
        parts.append(malformed_lines(read_lines(spark, whole, name), name == "N-Quads"))
    return union_triples(*parts)
