import pytest
from pyspark.sql import functions as F

from spark_triples.functions import terms


def value(spark, text, column):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("iri", "namespace"),
    [
        ("urn:lib:book#7", "urn:lib:book"),
        ("http://a/b/c", "http://a/b"),
        ("urn:a", "urn"),
        ("http://a/b#c#d", "http://a/b"),
        ("http://a/b#c/d", "http://a/b"),
        ("http://é/ü/x", "http://é/ü"),
    ],
)
def test_entity_namespace(spark, iri, namespace):
    assert value(spark, iri, terms.entity_namespace) == namespace


def test_iri_without_separator(spark):
    with pytest.raises(Exception, match="no separator in IRI: plain"):
        value(spark, "plain", terms.entity_namespace)
    assert value(spark, "plain", lambda c: terms.entity_namespace(c, "skip")) is None
    with pytest.raises(ValueError, match="on_bad_iri"):
        terms.entity_namespace(F.col("x"), "ignore")


@pytest.mark.parametrize(
    ("text", "ms"),
    [
        ("2018-09-01T10:15:30Z", 1535796930000),
        ("2018-09-01T10:15:30.987Z", 1535796930000),
        ("2018-09-01T10:15Z", 1535796900000),
        ("2018-09-01T12:15:30+02:00", 1535796930000),
        ("2018-09-01T12:15:30.5+02:00[Europe/Paris]", 1535796930000),
        ("1969-12-31T23:59:59.5Z", -1000),
        (None, None),
    ],
)
def test_iso_to_epoch_ms(spark, text, ms):
    assert value(spark, text, terms.iso_to_epoch_ms) == ms


@pytest.mark.parametrize("text", ["2018-09-01T10:15:30", "2018-13-01T10:15:30Z", "now", ""])
def test_iso_without_offset_fails(spark, text):
    with pytest.raises(Exception, match="not an ISO date-time with offset"):
        value(spark, text, terms.iso_to_epoch_ms)


def test_extract_subject(spark):
    assert value(spark, "urn:a\0urn:p\0x", terms.extract_subject) == "urn:a"
    assert value(spark, "\0urn:p", terms.extract_subject) == ""
    assert value(spark, "urn:a", terms.extract_subject) is None


def test_row_keys_round_trip(spark):
    row = ("urn:s", "urn:p", "an object")
    df = spark.createDataFrame([row], "subject string, predicate string, object string")
    for layout in ("spo", "po", "osp"):
        key = df.select(terms.encode_row_key(layout).alias("k"))
        assert tuple(key.select(*terms.decode_row_key(F.col("k"), layout)).first()) == row
    assert key.first()["k"] == "an object\0urn:s\0urn:p"
