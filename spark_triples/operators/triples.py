"""Operators on the triple table: normalise, deduplicate, filter, match, batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triples.functions.terms import or_fail
from spark_triples.schema import LAYOUTS, TRIPLE, TRIPLE_KEY, XSD_STRING


def normalise(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed statements as store rows: missing columns and nulls get their defaults.

    A literal without a type is a string, no visibility means public, and a row
    without a time was written now. Columns in ``keep`` stay as they are.
    """
    defaults = {
        "object_type": F.lit(XSD_STRING),
        "visibility": F.lit(""),
        "ts": F.current_timestamp(),
    }

    def column(name: str, data_type) -> Column:
        known = F.col(name) if name in parsed.columns else F.lit(None)
        known = known.cast(data_type)
        return F.coalesce(known, defaults[name]) if name in defaults else known

    return parsed.select(
        *[column(f.name, f.dataType).alias(f.name) for f in TRIPLE.fields], *keep
    )


def dedup_triples(triples: DataFrame) -> DataFrame:
    """One row per distinct triple, with its latest time. Copies combine map-side."""
    return triples.groupBy(*TRIPLE_KEY).agg(F.max("ts").alias("ts"))


def union_triples(*parts: DataFrame) -> DataFrame:
    """All rows of all parts (a bag: nothing is removed)."""
    return reduce(DataFrame.unionByName, parts)


def index_rows(triples: DataFrame) -> DataFrame:
    """Each triple once per layout: (layout, k1, k2, k3), the terms in key order."""
    rows = [
        F.struct(
            F.lit(layout).alias("layout"),
            *[F.col(name).alias(f"k{i + 1}") for i, name in enumerate(order)],
        )
        for layout, order in LAYOUTS.items()
    ]
    return triples.select(F.inline(F.array(*rows)))


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows; the job fails at the first null in one of the columns."""
    for name in columns:
        df = df.filter(or_fail(F.col(name).isNotNull(), f"{name} can't be null"))
    return df


def visible(df: DataFrame, auths: tuple[str, ...] = ()) -> DataFrame:
    """Public rows, and those labelled with one of ``auths``."""
    return df.filter(F.col("visibility").isin("", *auths))


def scan_filter(df: DataFrame, name: str, values: list[str]) -> DataFrame:
    """Rows whose column holds one of the values; reaches the file scan."""
    return df.filter(F.col(name).isin(*values))


def filter_property(triples: DataFrame, predicates: list[str]) -> DataFrame:
    """Triples of the listed predicates. IRIs may hold commas: this is a list."""
    return scan_filter(triples, "predicate", predicates)


def filter_time(
    triples: DataFrame, start_ms: int | None, end_ms: int | None
) -> DataFrame:
    """Triples written from start to end, both included. The end must be given."""
    if end_ms is None:
        raise ValueError("the end time must be set")
    ts = F.col("ts")
    if start_ms is not None:
        triples = triples.filter(ts >= F.timestamp_millis(F.lit(start_ms)))
    return triples.filter(ts <= F.timestamp_millis(F.lit(end_ms)))


def skip_null_subject(df: DataFrame) -> DataFrame:
    return df.filter(F.col("subject").isNotNull())


def choose_layout(
    subject: str | None = None, predicate: str | None = None, obj: str | None = None
) -> str:
    """The layout whose sort order starts with a bound term."""
    if subject is not None:
        return "spo"
    if predicate is not None:
        return "po"
    return "osp" if obj is not None else "spo"


def match_pattern(
    triples: DataFrame,
    subject: str | None = None,
    predicate: str | None = None,
    obj: str | None = None,
    object_type: str | None = None,
) -> DataFrame:
    """Triples that have the bound terms. An object is found whatever its datatype and
    language, or with the given datatype only."""
    bound = {
        "subject": subject,
        "predicate": predicate,
        "object": obj,
        "object_type": object_type,
    }
    for name, value in bound.items():
        if value is not None:
            triples = triples.filter(F.col(name) == value)
    return triples


def key_ranges(
    df: DataFrame, key: Column, split_points: list[str], name: str = "range_id"
) -> DataFrame:
    """Number of the half-open key range a row falls in.

    N split points make N+1 ranges: below the first, from each to the next, and from
    the last on. The points are compared in two steps (block, then within the block),
    so a row costs about 2√N comparisons.
    """
    points = sorted(set(split_points))
    if not points:
        return df.withColumn(name, F.lit(0))
    width = max(1, int(len(points) ** 0.5))
    blocks = [points[i : i + width] for i in range(0, len(points), width)]

    def texts(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    def at_most_key(values: Column) -> Column:
        return F.size(F.filter(values, lambda point: point <= key))

    block = at_most_key(texts([b[0] for b in blocks]))
    inside = F.get(F.array(*[texts(b) for b in blocks]), block - 1)
    number = (block - 1) * F.lit(width) + at_most_key(inside)
    return df.withColumn(name, F.when(block == 0, F.lit(0)).otherwise(number))


def rebalance(df: DataFrame, n: int | None = None) -> DataFrame:
    """Spread rows evenly over tasks: ``n`` of them, or as many as their size asks for."""
    return df.repartition(n) if n else df.hint("rebalance")


def local_batches(df: DataFrame, n: int, name: str = "batch_id") -> DataFrame:
    """Number batches of at most ``n`` rows within each task. Nothing is shuffled and
    no empty batch is made; ``n`` below 1 means batches of one row."""
    row = F.monotonically_increasing_id()
    partition = F.shiftright(row, 33)
    position = row.bitwiseAND(F.lit((1 << 33) - 1))
    batch = F.floor(position / F.lit(max(n, 1)))
    return df.withColumn(name, F.shiftleft(partition, 33).bitwiseOR(batch))
