"""A small graph, weather readings, with known counts; and two small files, boats in harbours."""

from spark_triples.schema import ANYURI, DELIM, LANG_STRING, XSD, XSD_STRING

DECIMAL = XSD + "decimal"
STATION = "http://weather.example/station/blindern"
MAST = "_:mast"
MORNING, EVENING = "urn:reading:17", "urn:reading:18"
NAME = "http://weather.example/terms#name"
TEMPERATURE = "http://weather.example/terms#celsius"
AT, CARRIES = "urn:weather:at", "urn:weather:carries"

GRAPH = [
    (STATION, NAME, "Blindern", LANG_STRING, "no"),
    (STATION, NAME, "Oslo west", LANG_STRING, "en"),
    (STATION, CARRIES, MAST, ANYURI),
    (MAST, TEMPERATURE, "3", DECIMAL),
    (MORNING, AT, STATION, ANYURI),
    (MORNING, TEMPERATURE, "-4.5", DECIMAL),
    (EVENING, AT, STATION, ANYURI),
    (EVENING, TEMPERATURE, "-4.5", DECIMAL),
    (EVENING, TEMPERATURE, "-4.5"),
]


def pair(first, second):
    return first + DELIM + second


COUNTS = {
    ("subject", STATION, ANYURI): 3,
    ("subject", MAST, ANYURI): 1,
    ("subject", MORNING, ANYURI): 2,
    ("subject", EVENING, ANYURI): 3,
    ("predicate", NAME, ANYURI): 2,
    ("predicate", CARRIES, ANYURI): 1,
    ("predicate", AT, ANYURI): 2,
    ("predicate", TEMPERATURE, ANYURI): 4,
    ("object", "Blindern", LANG_STRING): 1,
    ("object", "Oslo west", LANG_STRING): 1,
    ("object", MAST, ANYURI): 1,
    ("object", STATION, ANYURI): 2,
    ("object", "3", DECIMAL): 1,
    ("object", "-4.5", DECIMAL): 2,
    ("object", "-4.5", XSD_STRING): 1,
    ("subjectpredicate", pair(STATION, NAME), XSD_STRING): 2,
    ("subjectpredicate", pair(STATION, CARRIES), XSD_STRING): 1,
    ("subjectpredicate", pair(MAST, TEMPERATURE), XSD_STRING): 1,
    ("subjectpredicate", pair(MORNING, AT), XSD_STRING): 1,
    ("subjectpredicate", pair(MORNING, TEMPERATURE), XSD_STRING): 1,
    ("subjectpredicate", pair(EVENING, AT), XSD_STRING): 1,
    ("subjectpredicate", pair(EVENING, TEMPERATURE), XSD_STRING): 2,
    ("subjectobject", pair(STATION, "Blindern"), XSD_STRING): 1,
    ("subjectobject", pair(STATION, "Oslo west"), XSD_STRING): 1,
    ("subjectobject", pair(STATION, MAST), XSD_STRING): 1,
    ("subjectobject", pair(MAST, "3"), XSD_STRING): 1,
    ("subjectobject", pair(MORNING, STATION), XSD_STRING): 1,
    ("subjectobject", pair(MORNING, "-4.5"), XSD_STRING): 1,
    ("subjectobject", pair(EVENING, STATION), XSD_STRING): 1,
    ("subjectobject", pair(EVENING, "-4.5"), XSD_STRING): 2,
    ("predicateobject", pair(NAME, "Blindern"), XSD_STRING): 1,
    ("predicateobject", pair(NAME, "Oslo west"), XSD_STRING): 1,
    ("predicateobject", pair(CARRIES, MAST), XSD_STRING): 1,
    ("predicateobject", pair(AT, STATION), XSD_STRING): 2,
    ("predicateobject", pair(TEMPERATURE, "3"), XSD_STRING): 1,
    ("predicateobject", pair(TEMPERATURE, "-4.5"), XSD_STRING): 3,
    ("entity", "http://weather.example/station", ANYURI): 3,
    ("entity", "_", ANYURI): 1,
    ("entity", "urn:reading", ANYURI): 5,
}

NT_LINES = [
    '<urn:boat:7> <urn:term:length> "11.5"^^<http://www.w3.org/2001/XMLSchema#decimal> .',
    "<urn:boat:7> <urn:term:moored> <urn:harbour:north> .",
    '<urn:boat:7> <urn:term:name> "Havørn"@no .',
    '<urn:harbour:north> <urn:term:depth> "6" .',
]
TURTLE = """@prefix t: <urn:term:> .
@prefix harbour: <urn:harbour:> .
# the berths of the south
harbour:south t:depth "4" , "5" ; a t:Marina .
<urn:boat:9> t:moored harbour:south .
"""
FILED = {
    ("urn:boat:7", "urn:term:length", "11.5", DECIMAL),
    ("urn:boat:7", "urn:term:moored", "urn:harbour:north", ANYURI),
    ("urn:boat:7", "urn:term:name", "Havørn", LANG_STRING),
    ("urn:harbour:north", "urn:term:depth", "6", XSD_STRING),
    ("urn:harbour:south", "urn:term:depth", "4", XSD_STRING),
    ("urn:harbour:south", "urn:term:depth", "5", XSD_STRING),
    ("urn:harbour:south", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "urn:term:Marina", ANYURI),
    ("urn:boat:9", "urn:term:moored", "urn:harbour:south", ANYURI),
}


def counts_of(prospects):
    """Collected prospects as {(type, data, data type): count}."""
    return {
        (r["triple_value_type"], r["data"], r["data_type"]): r["count"]
        for r in prospects.collect()
    }
