"""The test graph: the driver's tables read as triples. The SQL runs unchanged on Spark
and on the engine the results are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spark_triples.session import prepare

G_RAW_SQL = """
select concat('urn:user#', cast(user_id as string)) as subject, 'urn:user-p#did' as predicate, event_type as object,
       'http://www.w3.org/2001/XMLSchema#string' as object_type, cast(null as string) as lang,
       cast(null as string) as context, '' as visibility, cast(ts as timestamp) as ts from events
union all
select concat('urn:event#', cast(event_id as string)), 'urn:event-p#by', concat('urn:user#', cast(user_id as string)),
       'http://www.w3.org/2001/XMLSchema#anyURI', null, null, '', cast(ts as timestamp) from events
union all
select concat('urn:order#', cast(o_orderkey as string)), 'urn:order-p#status', o_orderstatus,
       'http://www.w3.org/2001/XMLSchema#string', null, null, '', cast(o_orderdate as timestamp) from orders
union all
select concat('urn:order#', cast(o_orderkey as string)), 'urn:order-p#placedBy', concat('urn:customer#', cast(o_custkey as string)),
       'http://www.w3.org/2001/XMLSchema#anyURI', null, null, '', cast(o_orderdate as timestamp) from orders
union all
select concat('urn:customer#', cast(c_custkey as string)), 'http://www.w3.org/2000/01/rdf-schema#label', c_name,
       'http://www.w3.org/2001/XMLSchema#string', null, 'urn:graph:crm', '', timestamp '2024-01-01 00:00:00' from customer
union all
select concat('urn:part#', cast(p_partkey as string)), 'urn:part-p#size', cast(p_size as string),
       case when p_partkey % 2 = 0 then 'http://www.w3.org/2001/XMLSchema#integer' else 'http://www.w3.org/2001/XMLSchema#string' end,
       null, null, '', timestamp '2024-01-01 00:00:00' from part
union all
select concat('http://data.example/nation/', cast(n_nationkey as string)), 'http://www.w3.org/2000/01/rdf-schema#label', n_name,
       'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString', case when n_nationkey % 2 = 0 then 'en' else 'fr' end, null,
       case when n_nationkey % 5 = 0 then 'U' else '' end, timestamp '2024-01-15 00:00:00' from nation
union all
select concat('urn:region:', cast(r_regionkey as string)), 'http://www.w3.org/2000/01/rdf-schema#label', r_name,
       'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString', 'en', null, '', timestamp '2024-01-15 00:00:00' from region
"""

G_SQL = """
select subject, predicate, object, object_type, lang, context, visibility, max(ts) as ts
from g_raw group by subject, predicate, object, object_type, lang, context, visibility
"""

LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
DID = "urn:user-p#did"
STATUS = "urn:order-p#status"
PLACED_BY = "urn:order-p#placedBy"
PROPERTIES = [DID, LABEL]

TABLES = ["events", "orders", "customer", "part", "nation", "region"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def g_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph with its duplicate triples."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(G_RAW_SQL)


def g(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph, each triple once."""
    return spark.sql(G_SQL.replace("g_raw", "{g_raw}"), g_raw=g_raw(spark, sf_dir))
