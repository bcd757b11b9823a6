"""Table schemas and the fixed values every module agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (vocabulary IRIs, type names, key format) -----------------
XSD = "http://www.w3.org/2001/XMLSchema#"
ANYURI = XSD + "anyURI"
XSD_STRING = XSD + "string"
LANG_STRING = "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
DELIM = "\u0000"
COUNT = "count"
SUBJECT = "subject"
PREDICATE = "predicate"
OBJECT = "object"
SUBJECT_PREDICATE = "subjectpredicate"
SUBJECT_OBJECT = "subjectobject"
PREDICATE_OBJECT = "predicateobject"
ENTITY = "entity"
NO_CONTEXT = "null"
FIELD_PREFIX = "p_"
ABSENT = -1.0
STREAM_LAG = "5 seconds"
# -----------------------------------------------------------------------------

TYPES = (
    SUBJECT,
    PREDICATE,
    OBJECT,
    SUBJECT_PREDICATE,
    SUBJECT_OBJECT,
    PREDICATE_OBJECT,
    ENTITY,
)

TRIPLE = T.StructType(
    [
        T.StructField("subject", T.StringType(), False),
        T.StructField("predicate", T.StringType(), False),
        T.StructField("object", T.StringType(), False),
        T.StructField("object_type", T.StringType(), False),
        T.StructField("lang", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("visibility", T.StringType(), False),
        T.StructField("ts", T.TimestampType()),
    ]
)

PROSPECT = T.StructType(
    [
        T.StructField("index_name", T.StringType()),
        T.StructField("triple_value_type", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("visibility", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)

# A document is a set of rows, one per triple, whatever its size. A row without a value (an
# IRI) keeps the document known; the last columns are the order of its values.
DOCUMENT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "id",
            "uri",
            "context",
            "field",
            "value",
            "predicate",
            "object",
            "object_type",
            "lang",
            "graph",
            "visibility",
        )
    ]
)

# What a file of an index copy holds; keys are in the order of the copy.
ZONE = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("layout", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("range", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("low", T.ArrayType(T.StringType())),
        T.StructField("high", T.ArrayType(T.StringType())),
        T.StructField("cut", T.BooleanType()),
    ]
)

REJECT = T.StructType([T.StructField(name, T.StringType()) for name in ("path", "reason", "line")])

TRIPLE_KEY = [
    "subject",
    "predicate",
    "object",
    "object_type",
    "lang",
    "context",
    "visibility",
]
PROSPECT_KEY = ["index_name", "triple_value_type", "data", "data_type", "visibility"]

# Sort order of the three copies of the triples; the tail makes every key unique,
# so a range partitioning on it can cut through a subject, predicate or object.
LAYOUTS = {
    "spo": ["subject", "predicate", "object"],
    "po": ["predicate", "object", "subject"],
    "osp": ["object", "subject", "predicate"],
}
KEY_TAIL = ["object_type", "lang", "context", "visibility"]
