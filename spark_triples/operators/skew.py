"""Joins and per-group running totals that stay spread when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triples.session import stage

# What may be broadcast, counted beforehand; and how many keys the scan may filter by.
BROADCAST_KEYS = 500_000
BROADCAST_BYTES = 128 << 20
PUSHED_KEYS = 1_000
PUSHED_BYTES = 1 << 20
SALTS = 32
# Parquet readers test up to ten listed values against statistics, one by one.
_PUSHED_AT_ONCE = 10


def size_of(keys: DataFrame) -> tuple[int, int]:
    """Rows of a set of keys, and the bytes of its string columns."""
    strings = [f.name for f in keys.schema.fields if f.dataType.typeName() == "string"]
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in strings), F.lit(0))
    rows, size = keys.agg(F.count("*"), F.coalesce(F.sum(length), F.lit(0))).first()
    return rows, size


def can_broadcast(size: tuple[int, int], broadcast_keys: int = BROADCAST_KEYS) -> bool:
    return size[0] <= broadcast_keys and size[1] <= BROADCAST_BYTES


def can_push(size: tuple[int, int], broadcast_keys: int = BROADCAST_KEYS) -> bool:
    """So few and short that they may travel through the driver into the plan."""
    return size[0] <= min(PUSHED_KEYS, broadcast_keys) and size[1] <= PUSHED_BYTES


def is_one_of(column: Column, values: list[str]) -> Column:
    """``column`` has one of a few values, in a form files and row groups are skipped by."""
    groups = [
        column.isin(values[i : i + _PUSHED_AT_ONCE])
        for i in range(0, len(values), _PUSHED_AT_ONCE)
    ]
    while len(groups) > 1:
        pairs = zip(groups[::2], [*groups[1::2], F.lit(False)], strict=False)
        groups = [a | b for a, b in pairs]
    return groups[0] if groups else F.lit(False)


def key_join(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    how: str,
    and_also: Column | None = None,
    broadcast_keys: int = BROADCAST_KEYS,
    staged: bool = False,
) -> DataFrame:
    """``left_semi`` or ``left_anti`` of ``df`` with ``keys``, which match on one column.

    ``keys`` may repeat the column alone; if ``and_also`` compares others of theirs, a
    key must come once. They are written (unless ``staged``: distinct and written by the
    caller) and measured first. A few to keep become a
    filter of the scan. A small set is broadcast, so the rows of ``df`` do not move. A
    larger one is joined by shuffle, except for the keys with more than
    1/``broadcast_keys`` of all rows: there are at most ``broadcast_keys`` of those, so
    they are broadcast and their rows stay in place.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"how must be left_semi or left_anti, not {how!r}")
    keys = keys.withColumnRenamed(on, "_key")
    if not staged:
        keys = stage(keys.distinct(), "join-keys")
    match = F.col(on) == F.col("_key")
    on_match = match if and_also is None else match & and_also
    size = size_of(keys)
    if can_push(size, broadcast_keys) and how == "left_semi" and and_also is None:
        return df.filter(is_one_of(F.col(on), [r["_key"] for r in keys.collect()]))
    if can_broadcast(size, broadcast_keys):
        return df.join(F.broadcast(keys), on_match, how)

    # one pass, over the key alone
    rows = df.groupBy(F.col(on).alias("_heavy")).agg(F.count("*").alias("_rows"))
    rows = stage(rows, "key-rows")
    least = (rows.agg(F.sum("_rows")).first()[0] or 0) // max(broadcast_keys, 1)
    heavy = stage(rows.filter(F.col("_rows") > least).select("_heavy"), "heavy-keys")
    if not can_broadcast(size_of(heavy), max(broadcast_keys, 1)):
        # Keys of an extreme length. Every key is sent to each salt and a row to one, so the
        # rows of a heavy key meet it in SALTS places.
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
        salted = keys.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = df.withColumn("_salt", salt)
        on_salt = on_match & (F.col("_salt") == F.col("_salt_of"))
        return rows.join(salted, on_salt, how).drop("_salt")
    heavy = F.broadcast(heavy)
    is_heavy = F.col(on) == F.col("_heavy")
    heavy_keys = keys.join(heavy, F.col("_key") == F.col("_heavy"), "left_semi")
    light_rows = df.join(heavy, is_heavy, "left_anti").join(keys, on_match, how)
    heavy_rows = df.join(heavy, is_heavy, "left_semi")
    return light_rows.unionByName(
        heavy_rows.join(F.broadcast(heavy_keys), on_match, how)
    )


def preceding_total(
    df: DataFrame, group: str, order: list[str], weight: Column, name: str
) -> DataFrame:
    """Per row, the weight of all rows before it in its group, in key order. Exact.

    A window over the group would put the whole group in one task. Here the rows are
    range-partitioned on (group, order), which cuts through a large group; a window
    runs within each range, and each range adds what the group had before it. Fewer
    groups than there are ranges cross a range border, so these additions are
    broadcast with a proven bound. (group, order) must be unique.
    """
    ranged = (
        df.withColumn("_weight", weight)
        .repartitionByRange(group, *order)
        .withColumn("_range", F.spark_partition_id())
    )
    ranged = stage(ranged, "ranges")
    before = Window.partitionBy(group).orderBy("_range")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(group, "_range")
        .agg(F.sum("_weight").alias("_weight"))
        .withColumn("_carried", F.sum("_weight").over(before))
        .filter(F.col("_carried").isNotNull())
        .select(group, "_range", "_carried")
    )
    within = Window.partitionBy("_range", group).orderBy(*order)
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_within", F.sum("_weight").over(within))
        .join(F.broadcast(carried), [group, "_range"], "left")
        .withColumn(
            name,
            F.coalesce("_within", F.lit(0)) + F.coalesce("_carried", F.lit(0)),
        )
        .select(*df.columns, name)
    )


def with_parts(
    df: DataFrame,
    group: str,
    order: list[str],
    weight: Column,
    budget: int,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """``df`` with the columns ``part`` and ``n_parts``: its groups cut, in key order, where
    their total weight passes each multiple of the budget.

    No part grows with the data, and the parts in order are the whole group. Groups are
    weighed first by an aggregation that combines map-side; only those above the budget
    take the longer way.
    """

    def cut(rows: DataFrame) -> DataFrame:
        total = preceding_total(rows, group, order, weight, "_total")
        part = F.call_function("div", "_total", F.lit(budget))
        parted = stage(total.withColumn("part", part).drop("_total"), "parts")
        last = parted.groupBy(F.col(group).alias("_of")).agg(
            (F.max("part") + 1).alias("n_parts")
        )
        # a group here has more than one part, so the parts are far fewer than the rows
        return parted.join(
            stage(last, "last-parts"), F.col(group) == F.col("_of")
        ).drop("_of")

    large = df.groupBy(group).agg(F.sum(weight).alias("_w")).filter(F.col("_w") > budget)
    large = stage(large.select(group), "large-groups")
    size = size_of(large)
    whole = df.withColumns(
        {"part": F.lit(0).cast("bigint"), "n_parts": F.lit(1).cast("bigint")}
    )
    if size[0] == 0:
        return whole
    if not can_broadcast(size, broadcast_keys):
        return cut(df)
    large = F.broadcast(large)
    return whole.join(large, group, "left_anti").unionByName(
        cut(df.join(large, group, "left_semi"))
    )
