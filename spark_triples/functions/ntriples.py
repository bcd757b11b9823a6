"""N-Triples and N-Quads lines ↔ triple columns, as Catalyst expressions.

A line is matched once: ``regexp_replace`` rewrites it to its captured fields, one
per line feed (a character no input line can hold), and ``split`` cuts them apart.
Ten ``regexp_extract`` calls would run the grammar ten times per line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spark_triples.schema import ANYURI, LANG_STRING, XSD_STRING

# --- Fixed format: the public N-Triples / N-Quads line grammar ---------------
_HEX = "[0-9A-Fa-f]"
# \uXXXX outside the surrogates, a surrogate pair, or \UXXXXXXXX up to 10FFFF
_UCHAR = (
    rf"\\u(?![dD][89a-fA-F]){_HEX}{{4}}"
    rf"|\\u[dD][89abAB]{_HEX}{{2}}\\u[dD][c-fC-F]{_HEX}{{2}}"
    rf"|\\U(?!0000[dD][89a-fA-F])(?:000{_HEX}|0010){_HEX}{{4}}"
)
_IRI = rf'<((?:[^\x00-\x20<>"{{}}|^`\\]++|{_UCHAR})*+)>'
_LABEL = r"[\p{L}\p{Nd}_:](?:[\p{L}\p{M}\p{Nd}_:·.-]*[\p{L}\p{M}\p{Nd}_:·-])?"
_BNODE = rf"_:({_LABEL})"
# possessive loops: no backtracking and no recursion, whatever the literal's length
_STRING = rf'(")((?:[^"\\]++|\\[tbnrf"\'\\]|{_UCHAR})*+)"'
_LANG = r"@([A-Za-z]+(?:-[A-Za-z0-9]+)*)"
_LITERAL = rf"{_STRING}(?:\s*\^\^\s*{_IRI}|{_LANG})?"
_TERM = rf"(?:{_IRI}|{_BNODE})"
# -----------------------------------------------------------------------------
_FIELDS = [
    "s_iri",
    "s_bnode",
    "p_iri",
    "o_iri",
    "o_bnode",
    "quote",
    "literal",
    "datatype",
    "lang",
    "g_iri",
    "g_bnode",
]
_SEPARATOR = "\n"


def grammar(quads: bool = False) -> str:
    graph = rf"(?:\s*{_TERM})?" if quads else ""
    return (
        rf"^\s*{_TERM}\s*{_IRI}\s*(?:{_IRI}|{_BNODE}|{_LITERAL}){graph}\s*\.\s*(?:#[^\n]*)?\z"
    )


def is_statement_line(line: Column) -> Column:
    """False for blank and comment-only lines."""
    return ~line.rlike(r"^\s*(#|\z)")


def match_line(line: Column, quads: bool = False) -> Column:
    """The captured fields of a line as an array; a single element if it is malformed."""
    count = len(_FIELDS) if quads else len(_FIELDS) - 2
    captured = _SEPARATOR.join(f"${i + 1}" for i in range(count))
    return F.split(
        F.regexp_replace(line, F.lit(grammar(quads)), F.lit(captured)), _SEPARATOR
    )


def is_well_formed(fields: Column) -> Column:
    return F.size(fields) > 1


def unescape(text: Column) -> Column:
    """Undo backslash escapes. Text without a backslash passes through untouched.

    The text is cut into runs of plain characters and of escapes; neighbouring
    ``\\uXXXX`` escapes stay together, so a surrogate pair decodes as one character.
    """
    pieces = F.regexp_extract_all(
        text,
        F.lit(
            rf"([^\\]+|(?:\\u{_HEX}{{4}})+|\\U{_HEX}{{8}}|\\[tbnrf" + r"\"'\\])"
        ),
        F.lit(1),
    )

    def plain(piece: Column) -> Column:
        code = F.substring(piece, 2, 1)
        return (
            F.when(~piece.startswith("\\"), piece)
            .when(
                code == "u",
                F.decode(F.unhex(F.replace(piece, F.lit("\\u"), F.lit(""))), "UTF-16BE"),
            )
            .when(
                code == "U",
                F.decode(F.unhex(F.substring(piece, 3, 8)), "UTF-32"),
            )
            .otherwise(F.translate(code, "tbnrf", "\t\b\n\r\f"))
        )

    joined = F.array_join(F.transform(pieces, plain), "")
    return F.when(F.contains(text, F.lit("\\")), joined).otherwise(text)


def bnode_scope(file_path: Column) -> Column:
    """Blank-node labels hold within one file, so the file becomes part of the label."""
    return F.sha2(file_path, 256)


def triple_columns(fields: Column, scope: Column) -> list[Column]:
    """Parsed terms as subject, predicate, object, object_type, lang, context."""
    field = {name: F.get(fields, F.lit(i)) for i, name in enumerate(_FIELDS)}

    def bnode(name: str) -> Column:
        return F.concat(F.lit("_:"), scope, F.lit("-"), field[name])

    def resource(iri: str, label: str) -> Column:
        return F.when(field[label] != "", bnode(label)).otherwise(unescape(field[iri]))

    is_literal = field["quote"] != ""
    return [
        resource("s_iri", "s_bnode").alias("subject"),
        unescape(field["p_iri"]).alias("predicate"),
        F.when(is_literal, unescape(field["literal"]))
        .otherwise(resource("o_iri", "o_bnode"))
        .alias("object"),
        F.when(~is_literal, F.lit(ANYURI))
        .when(field["lang"] != "", F.lit(LANG_STRING))
        .when(field["datatype"] != "", unescape(field["datatype"]))
        .otherwise(F.lit(XSD_STRING))
        .alias("object_type"),
        F.nullif(field["lang"], F.lit("")).alias("lang"),
        F.coalesce(
            F.when(field["g_bnode"] != "", bnode("g_bnode")),
            F.when(field["g_iri"] != "", unescape(field["g_iri"])),
        ).alias("context"),
    ]


def _escape(text: Column) -> Column:
    """Escape what a quoted literal may not hold as it is."""
    for raw, escaped in [
        ("\\", "\\\\"),
        ('"', '\\"'),
        ("\n", "\\n"),
        ("\r", "\\r"),
    ]:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def render_line(quads: bool = False) -> Column:
    """A triple row as an N-Triples (or N-Quads) line."""

    def resource(term: Column) -> Column:
        return F.when(term.startswith("_:"), term).otherwise(
            F.concat(F.lit("<"), term, F.lit(">"))
        )

    obj, object_type, lang = F.col("object"), F.col("object_type"), F.col("lang")
    suffix = (
        F.when(lang.isNotNull(), F.concat(F.lit("@"), lang))
        .when(object_type == XSD_STRING, F.lit(""))
        .otherwise(F.concat(F.lit("^^<"), object_type, F.lit(">")))
    )
    literal = F.concat(F.lit('"'), _escape(obj), F.lit('"'), suffix)
    parts = [
        resource(F.col("subject")),
        F.concat(F.lit("<"), F.col("predicate"), F.lit(">")),
        F.when(object_type == ANYURI, resource(obj)).otherwise(literal),
    ]
    if quads:
        parts.append(resource(F.col("context")))
    return F.concat(F.concat_ws(" ", *parts), F.lit(" ."))
