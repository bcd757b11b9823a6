import pytest
from pyspark.sql import functions as F

from spark_triples.operators import prospects
from spark_triples.operators.triples import visible
from spark_triples.plans import flows
from spark_triples.schema import ANYURI, LANG_STRING, PROSPECT, TYPES, XSD_STRING
from spark_triples.sinks import tables as sinks
from spark_triples.sources import tables as sources

from .fixtures import COUNTS, GRAPH, NT_LINES, STATION, TEMPERATURE, counts_of


@pytest.fixture
def graph(make_triples):
    return make_triples(GRAPH)


def ask(spark, *requests):
    schema = "triple_value_type string, terms array<string>, data_type string"
    return spark.createDataFrame(requests, schema)


def test_all_counts(graph):
    counts = prospects.prospect_counts(graph)
    assert counts_of(counts) == COUNTS
    assert {(r["index_name"], r["visibility"]) for r in counts.collect()} == {("count", "")}


def test_counts_equal_aggregated_rows(make_triples):
    triples = make_triples([*GRAPH, ("http://a/b", TEMPERATURE, ""), ("u:x", TEMPERATURE, "-4.5", ANYURI)])
    rows = prospects.explode_prospects(triples)
    assert rows.count() == 7 * triples.count()
    assert rows.agg(F.max("count")).first()[0] == 1
    counts = prospects.prospect_counts(triples)
    assert counts_of(prospects.aggregate_prospects(rows)) == counts_of(counts)
    assert counts.columns == PROSPECT.names


@pytest.mark.parametrize("name", TYPES)
def test_counts_of_one_type(graph, name):
    expected = {k: n for k, n in COUNTS.items() if k[0] == name}
    assert counts_of(prospects.count_by_type(graph, name)) == expected


def test_visibility_is_part_of_the_key(make_triples):
    rows = make_triples([("a:b", "p:q", "x"), ("a:b", "p:q", "y", XSD_STRING, None, None, "U")])
    counts = prospects.count_by_type(rows, "subject").collect()
    assert sorted((r["visibility"], r["count"]) for r in counts) == [("", 1), ("U", 1)]
    assert visible(rows).count() == 1
    assert visible(rows, ("U", "FOUO")).count() == 2


def test_subject_without_namespace(make_triples):
    rows = make_triples([("plain", "p:q", "x"), ("a:b", "p:q", "x")])
    with pytest.raises(Exception, match="no separator in IRI: plain"):
        prospects.prospect_counts(rows).collect()
    with pytest.raises(Exception, match="no separator in IRI: plain"):
        prospects.explode_prospects(rows).collect()
    counts = counts_of(prospects.prospect_counts(rows, on_bad_iri="skip"))
    exploded = prospects.explode_prospects(rows, on_bad_iri="skip")
    assert counts == counts_of(prospects.aggregate_prospects(exploded))
    assert counts[("entity", "a", ANYURI)] == 1 and counts[("subject", "plain", ANYURI)] == 1
    assert [k for k in counts if k[0] == "entity"] == [("entity", "a", ANYURI)]


def test_empty_input(make_triples):
    assert prospects.prospect_counts(make_triples([])).collect() == []


@pytest.mark.parametrize("broadcast_keys", [prospects.BROADCAST_KEYS, 0])
def test_cardinality(spark, graph, broadcast_keys):
    counts = prospects.prospect_counts(graph)
    requests = ask(
        spark,
        ("predicateobject", [TEMPERATURE, "-4.5"], XSD_STRING),
        ("object", ["fog"], XSD_STRING),
        ("object", ["Blindern"], LANG_STRING),
        ("subject", [STATION], ANYURI),
        ("subject", [STATION], ANYURI),
    )
    found = prospects.cardinality(counts, requests, broadcast_keys=broadcast_keys)
    assert {r["data"]: r["cardinality"] for r in found.collect()} == {
        f"{TEMPERATURE}\0" + "-4.5": 3.0,
        "fog": -1.0,
        "Blindern": 1.0,
        STATION: 3.0,
    }


def test_lookup_respects_visibility(spark, make_triples):
    rows = [("a:b", "p:q", "x"), ("a:b", "p:q", "y", XSD_STRING, None, None, "U")]
    counts = prospects.prospect_counts(make_triples(rows))
    requests = ask(spark, ("subject", ["a:b"], ANYURI))
    assert prospects.lookup_prospects(counts, requests).count() == 1
    assert prospects.lookup_prospects(counts, requests, ("U",)).count() == 2
    both = prospects.cardinality(counts, requests, ("U",)).first()
    assert both["cardinality"] == 2.0


def test_table_rows(graph):
    rows = prospects.prospect_to_row(prospects.count_by_type(graph, "entity")).collect()
    assert {(r["row_key"], r["family"], r["qualifier"], r["value"]) for r in rows} == {
        ("entity\0urn:reading", "count", ANYURI, "5"),
        ("entity\0http://weather.example/station", "count", ANYURI, "3"),
        ("entity\0_", "count", ANYURI, "1"),
    }


def test_jobs_in_one_and_two_steps_agree(spark, graph, tmp_path):
    prefix = f"{tmp_path}/t_"
    hidden = graph.limit(1).withColumn("visibility", F.lit("U"))
    sinks.write_indexes(graph.unionByName(hidden), prefix)
    flows.statistics(spark, prefix, f"{tmp_path}/direct")
    flows.statistics_fetch_only(spark, prefix, f"{tmp_path}/files")
    flows.statistics_combine(spark, f"{tmp_path}/files", f"{tmp_path}/combined")
    for table in ("direct", "combined"):
        assert counts_of(sources.read_prospects(spark, f"{tmp_path}/{table}")) == COUNTS
    raw = sources.read_prospect_files(spark, f"{tmp_path}/files")
    assert raw.count() == 7 * len(GRAPH)
    one = raw.filter(
        (F.col("triple_value_type") == "subject") & (F.col("data") == STATION)
    )
    assert one.count() == 3


def test_statistics_replace_earlier_counts(spark, graph, tmp_path):
    prefix, table = f"{tmp_path}/t_", f"{tmp_path}/counts"
    sinks.write_indexes(graph, prefix)
    for _ in range(2):
        flows.statistics(spark, prefix, table)
    assert counts_of(sources.read_prospects(spark, table)) == COUNTS


def test_runs_add_up_once_each(spark, make_triples, tmp_path):
    table = f"{tmp_path}/counts"
    halves = [make_triples(GRAPH[:2]), make_triples(GRAPH[2:])]
    for number in (0, 1, 1, 0):
        counts = prospects.prospect_counts(halves[number])
        sinks.write_prospects(counts, table, run=f"half-{number}")
    assert counts_of(sources.read_prospects(spark, table)) == COUNTS
    merged = prospects.merge_prospects(*[prospects.prospect_counts(h) for h in halves])
    assert counts_of(merged) == COUNTS
    sinks.compact_prospects(spark, table)
    assert len(sources.run_paths(spark, table)) == 1
    assert counts_of(sources.read_prospects(spark, table)) == COUNTS


def test_null_in_prospect_files_fails(spark, tmp_path):
    row = [("count", "subject", None, ANYURI, "", 1)]
    sinks.write_prospect_files(spark.createDataFrame(row, PROSPECT), f"{tmp_path}/files")
    read = sources.read_prospect_files(spark, f"{tmp_path}/files")
    with pytest.raises(Exception, match="data can't be null"):
        read.select("count").collect()


def test_load_with_statistics(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("one.nt", "same.nt"):
        (tmp_path / "in" / name).write_text("\n".join(NT_LINES))
    args = (f"{tmp_path}/in/*.nt", f"{tmp_path}/t_", f"{tmp_path}/counts")
    for _ in range(2):
        flows.bulk_load_with_statistics(spark, *args, run="first")
    counts = counts_of(sources.read_prospects(spark, f"{tmp_path}/counts"))
    assert counts[("subject", "urn:boat:7", ANYURI)] == 3
    assert sum(counts.values()) == 7 * len(NT_LINES)
    flows.statistics(spark, f"{tmp_path}/t_", f"{tmp_path}/again")
    assert counts_of(sources.read_prospects(spark, f"{tmp_path}/again")) == counts


def test_counts_of_asked_types_only(spark, make_triples):
    graph = make_triples(GRAPH)
    some = ask(spark, ("subject", [STATION], ANYURI), ("predicateobject", [TEMPERATURE, "x"], XSD_STRING), ("other", ["x"], ANYURI))
    counts = prospects.asked_counts(graph, some)
    kept = ("subject", "predicateobject", "entity")  # a subject without a namespace stays an error
    assert counts_of(counts) == {k: n for k, n in COUNTS.items() if k[0] in kept}
    with pytest.raises(Exception, match="no separator in IRI: plain"):
        prospects.asked_counts(make_triples([("plain", "p:q", "x")]), some).collect()
    none = prospects.asked_counts(graph, some.filter("false"), on_bad_iri="skip")
    assert none.columns == PROSPECT.names and none.count() == 0
