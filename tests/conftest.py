import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from spark_triples.schema import TRIPLE, XSD_STRING  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def make_triples(spark):
    """Rows of (subject, predicate, object[, type[, lang[, context[, visibility[, ts]]]]])."""

    def make(rows):
        defaults = (None, None, None, XSD_STRING, None, None, "", None)
        full = [tuple(row) + defaults[len(row) :] for row in rows]
        return spark.createDataFrame(full, TRIPLE)

    return make
