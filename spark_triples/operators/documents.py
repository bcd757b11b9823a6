"""Full-text documents: pick changed subjects, group by subject, values, nesting, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triples.functions.terms import literal_label, property_field
from spark_triples.operators.skew import BROADCAST_KEYS, key_join, with_parts
from spark_triples.operators.sorted_groups import ROW_CHARS
from spark_triples.operators.triples import (
    filter_property,
    filter_time,
    skip_null_subject,
)
from spark_triples.schema import DOCUMENT, KEY_TAIL, NO_CONTEXT

_ORDER = ["predicate", "object", *KEY_TAIL]
_VALUE_ORDER = ["predicate", "object", "object_type", "lang", "graph", "visibility"]


def changed_subject_triples(
    triples: DataFrame,
    properties: list[str],
    start_ms: int | None,
    end_ms: int | None,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """All triples, of any age, of the listed properties of each subject that had one
    of them written in the time range. A subject counts once however often it changed."""
    listed = filter_property(triples, properties)
    changed = filter_time(listed, start_ms, end_ms).select("subject")
    return key_join(
        listed, changed, "subject", "left_semi", broadcast_keys=broadcast_keys
    )


def group_by_subject(
    triples: DataFrame, part_chars: int, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """(subject, part, n_parts, triples): the triples of a subject, sorted as in the table, in
    arrays of about ``part_chars`` characters at most.

    Expects distinct triples (the table has them). Rows without a subject are left out.
    """
    parted = with_parts(
        skip_null_subject(triples),
        "subject",
        _ORDER,
        F.length("object") + F.lit(ROW_CHARS),
        part_chars,
        broadcast_keys,
    )
    entry = F.struct(*_ORDER, "ts")
    return parted.groupBy("subject", "part", "n_parts").agg(
        F.sort_array(F.collect_list(entry)).alias("triples")
    )


def document_values(
    triples: DataFrame, keep: tuple[str, ...] = (), kept: Column | None = None
) -> DataFrame:
    """Documents of the given triples: one row per triple with its field and value, and the
    columns that order the values. A projection: nothing is grouped, whatever the size of a
    subject. IRI objects have no text; their rows have no value. With a condition ``kept``, no
    row goes: the column ``_kept`` tells which are meant."""
    known = skip_null_subject(triples) if kept is None else triples.withColumn("_kept", kept)
    return known.select(
        F.col("subject").alias("id"),
        F.col("subject").alias("uri"),
        F.lit(NO_CONTEXT).alias("context"),
        property_field(F.col("predicate")).alias("field"),
        literal_label(F.col("object"), F.col("object_type")).alias("value"),
        "predicate",
        "object",
        "object_type",
        "lang",
        F.col("context").alias("graph"),
        "visibility",
        *keep,
    )


def nest_documents(
    values: DataFrame, part_chars: int, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """(id, uri, context, part, n_parts, properties, text): documents as nested rows, cut into
    parts of about ``part_chars`` characters at most, for consumers that need one value per
    document. Per part the literal values of each predicate in a field of its own, and
    all of them in ``text``, in key order.

    Values are grouped by field before the fields are by document, so the work is in
    proportion to the values.
    """
    parted = with_parts(
        values,
        "id",
        _VALUE_ORDER,
        F.length("object") + F.lit(ROW_CHARS),
        part_chars,
        broadcast_keys,
    )
    keys = ["id", "uri", "context", "part", "n_parts"]
    entry = F.when(F.col("value").isNotNull(), F.struct(*_VALUE_ORDER, "value"))
    fields = parted.groupBy(*keys, "predicate", "field").agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    values_of = F.transform("entries", lambda e: e["value"])
    field = F.when(F.size("entries") > 0, F.struct("predicate", "field", values_of.alias("values")))
    documents = fields.groupBy(*keys).agg(
        F.sort_array(F.collect_list(field)).alias("fields")
    )
    return documents.select(
        *keys,
        F.map_from_entries(
            F.transform("fields", lambda f: F.struct(f["field"], f["values"]))
        ).alias("properties"),
        F.flatten(F.transform("fields", lambda f: f["values"])).alias("text"),
    )


def upsert_documents(
    existing: DataFrame, docs: DataFrame, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """``docs``, and those existing documents whose id is not among them, as values."""
    kept = key_join(
        existing, docs.select("id"), "id", "left_anti", broadcast_keys=broadcast_keys
    )
    names = DOCUMENT.names
    return kept.select(*names).unionByName(docs.select(*names))


def document_json(docs: DataFrame) -> DataFrame:
    """(id, part, n_parts, json): context, text, uri and the property fields of nested
    documents as one object. Every piece of a document in parts says which it is."""

    def body(json: Column) -> Column:
        return F.substring(json, F.lit(2), F.length(json) - 2)

    head = F.to_json(F.struct("context", "text", "uri"))
    part = F.when(F.col("n_parts") > 1, body(F.to_json(F.struct("part", "n_parts"))))
    fields = F.when(
        F.size("properties") > 0, body(F.to_json(F.col("properties")))
    )
    inner = F.concat_ws(",", body(head), part, fields)
    return docs.select(
        "id", "part", "n_parts", F.concat(F.lit("{"), inner, F.lit("}")).alias("json")
    )
