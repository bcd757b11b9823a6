"""Column functions on RDF terms, row keys and date-times. No Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spark_triples.schema import ANYURI, DELIM, FIELD_PREFIX, LAYOUTS

__all__ = [
    "decode_row_key",
    "encode_row_key",
    "entity_namespace",
    "extract_subject",
    "iso_to_epoch_ms",
    "literal_label",
    "object_kind",
    "or_fail",
    "pair_key",
    "property_field",
]


def or_fail(ok: Column, message: Column | str) -> Column:
    """True where ``ok`` holds, else the job fails. Use it inside a filter: a
    projected check is pruned away as soon as nobody reads its column."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))


def _before_last(text: Column, separator: str) -> Column:
    tail = F.instr(F.reverse(text), separator)
    return F.substring(text, F.lit(1), F.length(text) - tail)


def entity_namespace(iri: Column, on_bad_iri: str = "error") -> Column:
    """The IRI without its local name and without the separator before it.

    The separator is the first ``#``, else the last ``/``, else the last ``:``. An
    IRI with none of them fails the job, or gives null with ``on_bad_iri='skip'``.
    """
    if on_bad_iri not in ("error", "skip"):
        raise ValueError(f"on_bad_iri must be 'error' or 'skip', not {on_bad_iri!r}")
    found = (
        F.when(F.contains(iri, F.lit("#")), F.substring_index(iri, "#", 1))
        .when(F.contains(iri, F.lit("/")), _before_last(iri, "/"))
        .when(F.contains(iri, F.lit(":")), _before_last(iri, ":"))
    )
    if on_bad_iri == "skip":
        return found
    message = F.concat(F.lit("no separator in IRI: "), iri)
    return found.otherwise(F.raise_error(message).cast("string"))


def pair_key(first: Column, second: Column) -> Column:
    """Two terms as one key. An object counts by its text: type and language of
    the literal are left out on purpose."""
    return F.concat(first, F.lit(DELIM), second)


def extract_subject(row_key: Column) -> Column:
    """Text before the first delimiter; null when there is none."""
    return F.when(
        F.contains(row_key, F.lit(DELIM)), F.substring_index(row_key, DELIM, 1)
    )


def encode_row_key(layout: str) -> Column:
    """Key of a triple in one of the three layouts: its terms joined by the delimiter."""
    return F.concat_ws(DELIM, *LAYOUTS[layout])


def decode_row_key(row_key: Column, layout: str) -> list[Column]:
    """The three terms of a key, as columns named subject, predicate, object."""
    parts = F.split(row_key, DELIM)
    by_name = {name: parts[i].alias(name) for i, name in enumerate(LAYOUTS[layout])}
    return [by_name[name] for name in LAYOUTS["spo"]]


def object_kind(object_type: Column, lang: Column) -> Column:
    """``iri``, ``lang`` or ``typed``: what the stored object turns back into."""
    return (
        F.when(object_type == ANYURI, "iri")
        .when(lang.isNotNull(), "lang")
        .otherwise("typed")
    )


def literal_label(obj: Column, object_type: Column) -> Column:
    """Text of a literal; null for an IRI."""
    return F.when(object_type != ANYURI, obj)


def property_field(predicate: Column) -> Column:
    """Name of the document field that holds the values of a predicate."""
    return F.concat(F.lit(FIELD_PREFIX), predicate)


# Fixed format: ISO date-time, an offset is required, a region name may follow it.
ISO_DATE_TIME = (
    r"^[+-]?\d{4,9}-\d{2}-\d{2}[Tt]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
    r"([Zz]|[+-]\d{2}(:\d{2}(:\d{2})?)?)(\[[^\]]+\])?$"
)


def iso_to_epoch_ms(text: Column) -> Column:
    """ISO date-time with offset → epoch milliseconds, fractions of a second dropped."""
    plain = F.upper(F.regexp_replace(text, r"\[[^\]]*\]$", ""))
    full = F.regexp_replace(plain, r"(T\d{2}:\d{2})(?=[Z+-])", "$1:00")
    seconds = F.when(
        text.rlike(ISO_DATE_TIME), F.unix_seconds(F.try_to_timestamp(full))
    )
    message = F.concat(F.lit("not an ISO date-time with offset: "), text)
    failure = F.raise_error(message).cast("bigint")
    return F.when(text.isNotNull(), F.coalesce(seconds * F.lit(1000), failure))
