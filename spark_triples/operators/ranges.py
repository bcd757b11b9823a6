"""Ranges of a sorted copy, laid out before it is written.

Split points come from a sample of the keys, so that the rows themselves are evaluated once
(a range partitioner runs its whole input twice), and one sample serves all copies. Where a
point falls in the value of the leading key that the one before it falls in, that value
holds more than a range, and the point is the whole key: it is cut. All other points are
the beginning of a value, so a value that is not cut lies in one range.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triples.operators.skew import size_of
from spark_triples.session import stage

RANGE = "_range"
#: Rows of the sample for one range.
SAMPLED_PER_RANGE = 200
#: What the driver takes of a sample, at most.
HELD_KEYS, HELD_BYTES = 200_000, 32 << 20
#: A range needs so many sampled rows, lest chance decides its size.
LEAST_SAMPLED = 20


class Points(NamedTuple):
    """The keys that every range but the first begins with, in order; trailing fields of a key
    that begins a value are null."""

    order: list[str]
    keys: list[tuple]

    @property
    def ranges(self) -> int:
        return len(self.keys) + 1

    def cut(self) -> list[str]:
        """The leading values that lie in more than one range."""
        inside = [k[0] for k in self.keys if any(x is not None for x in k[1:])]
        return list(dict.fromkeys(inside))


class Sample(NamedTuple):
    """Sampled keys: their names and number, and the keys themselves, on the driver where they
    are few and short, else in files."""

    names: list[str]
    n: int
    held: list[tuple] | None
    written: DataFrame | None


def key_sample(some: DataFrame, keys: list[str], ranges: int) -> Sample:
    """The keys of ``some``, a sample of about SAMPLED_PER_RANGE rows for each range."""
    if SAMPLED_PER_RANGE * ranges <= HELD_KEYS // 4:
        held = [tuple(r) for r in some.select(*keys).collect()]
        return Sample(keys, len(held), held, None)
    written = stage(some.select(*keys), "key-sample")
    n, size = size_of(written)
    if n <= HELD_KEYS and size <= HELD_BYTES:
        return Sample(keys, n, [tuple(r) for r in written.collect()], None)
    return Sample(keys, n, None, written)


def split_points(sample: Sample | None, order: list[str], ranges: int) -> Points:
    """Points that cut the sample into about ``ranges`` equal parts. The driver gets one key for
    each range."""
    ranges = 1 if sample is None else max(1, min(ranges, sample.n // LEAST_SAMPLED))
    if ranges == 1:
        return Points(order, [])
    if sample.held is not None:
        places = [sample.names.index(c) for c in order]
        keys = sorted((tuple(k[p] for p in places) for k in sample.held), key=_nulls_first)
        found = [keys[k * len(keys) // ranges] for k in range(ranges)]
        found = list(dict.fromkeys(found))
    else:
        starts = (
            sample.written.repartitionByRange(ranges, *order)
            .groupBy(F.spark_partition_id())
            .agg(F.min(F.struct(*order)).alias("start"))
            .sort("start")
        )
        found = [tuple(r["start"]) for r in starts.collect()]
    keys = []
    for before, key in zip(found, found[1:], strict=False):
        keys.append(key if key[0] == before[0] else (key[0], *[None] * (len(order) - 1)))
    return Points(order, keys)


def _nulls_first(key: tuple) -> tuple:
    return tuple((x is not None, x or "") for x in key)


def with_range(df: DataFrame, points: Points) -> DataFrame:
    """``df`` with the number of the range that a row belongs to: how many points are not
    beyond its key.

    A binary search over the points, a projection per level. A level's points travel as one
    constant of the plan.
    """
    depth = len(points.keys).bit_length()
    own = F.struct(*points.order)
    key_type = T.StructType([T.StructField(c, T.StringType()) for c in points.order])
    numbered = df.withColumn(RANGE, F.lit(0))
    for level in range(depth):
        step = 1 << (depth - level)
        # no key reaches a null, which stands for a point beyond the last
        places = range(step // 2 - 1, (1 << depth) - 1, step)
        keys = points.keys[step // 2 - 1 :: step]
        named = [dict(zip(points.order, k, strict=True)) for k in keys]
        texts = json.dumps(named + [None] * (len(places) - len(keys)))
        point = F.get(F.from_json(F.lit(texts), T.ArrayType(key_type)), F.col(RANGE))
        numbered = numbered.withColumn(RANGE, 2 * F.col(RANGE) + F.when(own >= point, 1).otherwise(0))
    return numbered


def in_ranges(df: DataFrame, points: Points) -> DataFrame:
    """``df`` with a partition for each range, numbered alike, and the number as a column. The
    only exchange that a sorted copy takes."""
    return with_range(df, points).repartitionById(points.ranges, RANGE)


def sorted_distinct(ranged: DataFrame, points: Points, others: list[Column]) -> DataFrame:
    """Ranged rows, one per key, sorted by it, with aggregates of the other columns. Equal keys
    are in one range, so nothing moves."""
    found = ranged.groupBy(RANGE, *points.order).agg(*others).drop(RANGE)
    return found.sortWithinPartitions(*points.order)
