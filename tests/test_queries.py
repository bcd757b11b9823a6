"""Every registered query against its SQL, over the whole smallest data set."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from spark_triples.plans import catalog

SF_DIR = contract.SMOKE_DIR
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as from '{SF_DIR}/{name}.parquet'")
    return connection


def as_rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    return sorted(
        tuple("" if pd.isna(v) else str(v) for v in row)
        for row in frame[columns].itertuples(index=False)
    )


def test_contract(spark):
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.count() == contract.queries()["prospect_counts"](spark, SF_DIR).count()


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = catalog.QUERIES[name](spark, SF_DIR)
    sql = catalog.ORACLES[name]
    described = {r[0]: r[1] for r in duck.execute(f"describe {sql}").fetchall()}
    assert {c: TYPES[t] for c, t in found.dtypes} == described
    assert as_rows(found.toPandas()) == as_rows(duck.execute(sql).df())
