"""Counts per subject, predicate, object, their pairs and namespaces ("prospects")."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triples.functions.terms import entity_namespace, pair_key
from spark_triples.operators.skew import (
    BROADCAST_KEYS,
    can_push,
    can_broadcast,
    is_one_of,
    size_of,
)
from spark_triples.operators.triples import require_not_null
from spark_triples.schema import (
    ABSENT,
    ANYURI,
    COUNT,
    DELIM,
    ENTITY,
    OBJECT,
    PREDICATE,
    PREDICATE_OBJECT,
    PROSPECT,
    PROSPECT_KEY,
    SUBJECT,
    SUBJECT_OBJECT,
    SUBJECT_PREDICATE,
    TYPES,
    XSD_STRING,
)
from spark_triples.session import stage


def _keys(on_bad_iri: str) -> dict[str, tuple[Column, Column]]:
    """Counted key and its data type, per prospect type."""
    s, p, o = F.col("subject"), F.col("predicate"), F.col("object")
    uri, string = F.lit(ANYURI), F.lit(XSD_STRING)
    return {
        SUBJECT: (s, uri),
        PREDICATE: (p, uri),
        OBJECT: (o, F.col("object_type")),
        SUBJECT_PREDICATE: (pair_key(s, p), string),
        SUBJECT_OBJECT: (pair_key(s, o), string),
        PREDICATE_OBJECT: (pair_key(p, o), string),
        ENTITY: (entity_namespace(s, on_bad_iri), uri),
    }


# Columns a type is counted by; "namespace" is that of the subject.
GROUPED = {
    SUBJECT: ("subject",),
    PREDICATE: ("predicate",),
    OBJECT: ("object", "object_type"),
    SUBJECT_PREDICATE: ("subject", "predicate"),
    SUBJECT_OBJECT: ("subject", "object"),
    PREDICATE_OBJECT: ("predicate", "object"),
    ENTITY: ("namespace",),
}


def explode_prospects(
    triples: DataFrame,
    types: tuple[str, ...] = TYPES,
    on_bad_iri: str = "error",
) -> DataFrame:
    """Each triple as one row per prospect type, with count 1.

    With ``on_bad_iri='skip'`` a subject without a namespace has no entity row.
    """
    keys = _keys(on_bad_iri)
    rows = [
        F.struct(
            F.lit(COUNT).alias("index_name"),
            F.lit(name).alias("triple_value_type"),
            keys[name][0].alias("data"),
            keys[name][1].alias("data_type"),
            F.col("visibility").alias("visibility"),
            F.lit(1).cast("bigint").alias("count"),
        )
        for name in types
    ]
    exploded = triples.select(F.inline(F.array(*rows)))
    return exploded.filter(F.col("data").isNotNull()) if on_bad_iri == "skip" else exploded


def aggregate_prospects(prospects: DataFrame) -> DataFrame:
    """Sum the counts of equal prospects. Combines map-side, so a key that occurs
    everywhere reaches the shuffle once per task."""
    return prospects.groupBy(*PROSPECT_KEY).agg(F.sum("count").alias("count"))


def prospect_counts(
    triples: DataFrame, on_bad_iri: str = "error", types: tuple[str, ...] = TYPES
) -> DataFrame:
    """The aggregated prospects of a triple table, of all types or of some.

    The same rows as aggregating :func:`explode_prospects`, as one GROUPING SETS query:
    terms are joined to pair keys only after equal ones have been counted, so fewer and
    narrower rows are built and shuffled.
    """
    if not types:
        return triples.sparkSession.createDataFrame([], PROSPECT)
    columns = ["subject", "predicate", "object", "object_type", "namespace", "visibility"]
    with_namespace = triples.select(
        *columns[:4],
        entity_namespace(F.col("subject"), on_bad_iri).alias("namespace"),
        "visibility",
    )
    grouped = {name: {*own, "visibility"} for name, own in GROUPED.items() if name in types}
    counted = with_namespace.groupingSets(
        [[F.col(c) for c in columns if c in own] for own in grouped.values()],
        *[F.col(c) for c in columns],
    ).agg(F.count("*").alias("count"), F.grouping_id().alias("_set"))
    # grouping_id has one bit per column, the first column highest, set if left out
    number = {
        name: sum(2**i for i, c in enumerate(reversed(columns)) if c not in own)
        for name, own in grouped.items()
    }
    types = F.create_map(*[F.lit(x) for n in grouped for x in (number[n], n)])
    uri_sets = [number[n] for n in (SUBJECT, PREDICATE, ENTITY) if n in grouped]
    rows = counted.select(
        F.lit(COUNT).alias("index_name"),
        types[F.col("_set")].alias("triple_value_type"),
        # columns outside the set are null, which concat_ws leaves out
        F.concat_ws(DELIM, "subject", "predicate", "object", "namespace").alias("data"),
        F.when(F.col("_set").isin(uri_sets), F.lit(ANYURI))
        .when(F.col("_set") == number.get(OBJECT, -1), F.col("object_type"))
        .otherwise(F.lit(XSD_STRING))
        .alias("data_type"),
        "visibility",
        "count",
        (F.col("_set") == number.get(ENTITY, -1)).alias("_entity"),
        "namespace",
    )
    if on_bad_iri == "skip":
        rows = rows.filter(~F.col("_entity") | F.col("namespace").isNotNull())
    return rows.select(*PROSPECT.names)


def count_by_type(
    triples: DataFrame, name: str, on_bad_iri: str = "error"
) -> DataFrame:
    """The aggregated prospects of one type; reads only the columns it needs."""
    return aggregate_prospects(explode_prospects(triples, (name,), on_bad_iri))


def merge_prospects(*tables: DataFrame) -> DataFrame:
    """Counts of equal prospects added up over tables."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return aggregate_prospects(merged)


def prospect_to_row(prospects: DataFrame) -> DataFrame:
    """Prospects as key/value rows: key = type and data, value = count as text."""
    checked = require_not_null(prospects, ["triple_value_type", "data", "count"])
    return checked.select(
        F.concat("triple_value_type", F.lit(DELIM), "data").alias("row_key"),
        F.col("index_name").alias("family"),
        F.col("data_type").alias("qualifier"),
        F.coalesce("visibility", F.lit("")).alias("visibility"),
        F.current_timestamp().alias("updated_at"),
        F.col("count").cast("string").alias("value"),
    )


def _lookup_key() -> list[str]:
    return ["triple_value_type", "data", "data_type"]


def lookup_prospects(
    prospects: DataFrame,
    requests: DataFrame,
    auths: tuple[str, ...] = (),
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """The prospects asked for: ``requests(triple_value_type, terms, data_type)``, the
    terms in key order. Each prospect comes once, however often it is asked for.

    The distinct requests are written and measured. A few become a filter of the
    scan, a small set is broadcast and the count table stays where it is, else both sides,
    unique on the key but for the visibility labels, meet by shuffle.
    """
    return _lookup(prospects, _asked(requests), auths, broadcast_keys)


def _asked(requests: DataFrame) -> DataFrame:
    """The distinct requests, written once."""
    wanted = requests.select(
        "triple_value_type",
        F.array_join("terms", DELIM).alias("data"),
        "data_type",
    ).distinct()
    return stage(wanted, "lookup-requests")


def _lookup(
    prospects: DataFrame, wanted: DataFrame, auths: tuple[str, ...], broadcast_keys: int
) -> DataFrame:
    found = prospects.filter(F.col("visibility").isin("", *auths))
    size = size_of(wanted)
    if can_push(size, broadcast_keys):
        # so few that the scan itself can skip files and row groups by them
        asked = wanted.collect()
        for name in ("triple_value_type", "data"):
            values = sorted({row[name] for row in asked} - {None})
            found = found.filter(is_one_of(F.col(name), values))
    if can_broadcast(size, broadcast_keys):
        wanted = F.broadcast(wanted)
    return found.join(wanted, _lookup_key(), "left_semi").select(*PROSPECT.names)


def asked_counts(triples: DataFrame, requests: DataFrame, on_bad_iri: str = "error") -> DataFrame:
    """The aggregated prospects of the types that are asked for. Counts of the other types would be
    built and moved for nothing, and those of subjects with objects are the most and the widest. The
    few namespaces are counted in any case where a subject without one is an error."""
    asked = requests.select("triple_value_type").distinct()
    found = asked.filter(F.col("triple_value_type").isin(*TYPES)).collect()  # at most one row a type
    names = {r["triple_value_type"] for r in found} | ({ENTITY} if on_bad_iri == "error" else set())
    return prospect_counts(triples, on_bad_iri, tuple(n for n in TYPES if n in names))


def cardinality(
    prospects: DataFrame,
    requests: DataFrame,
    auths: tuple[str, ...] = (),
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Every request with its count as a double, -1.0 when nothing was counted.

    Only the rows asked for leave the count table; they are summed per key (over
    visibility labels) and joined back to the distinct requests.
    """
    asked = _asked(requests)
    found = (
        _lookup(prospects, asked, auths, broadcast_keys)
        .groupBy(*_lookup_key())
        .agg(F.sum("count").alias("count"))
    )
    return asked.join(found, _lookup_key(), "left").select(
        *_lookup_key(),
        F.coalesce(F.col("count").cast("double"), F.lit(ABSENT)).alias("cardinality"),
    )
