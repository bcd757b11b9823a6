"""Ranges laid out from a sample, the zone map, and groups made as a copy is read."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from spark_triples.operators import documents, prospects, ranges, triples
from spark_triples.plans import flows
from spark_triples.schema import ANYURI, KEY_TAIL, LAYOUTS, TRIPLE_KEY
from spark_triples.sinks import tables as sinks
from spark_triples.sources import tables as sources

from .test_tables import plan

SPO = [*LAYOUTS["spo"], *KEY_TAIL]


def graph(rng, n=3000, heavy=0):
    rows = [
        (
            f"urn:s{rng.randrange(n // 5)}",
            f"urn:p{rng.randrange(4)}",
            f"o{rng.randrange(30)}é" * rng.randrange(1, 4),
            rng.choice([ANYURI, "urn:string"]),
            rng.choice([None, "en"]),
            rng.choice([None, "urn:g"]),
            rng.choice(["", "", "", "U"]),
        )
        for _ in range(n)
    ]
    return rows + [("urn:s77", f"urn:p{k % 3}", f"value {k}") for k in range(heavy)]


def sort_key(row):
    return tuple((x is not None, x or "") for x in row)


def test_split_points(spark, make_triples):
    rng = random.Random(1)
    rows = graph(rng, 2000, heavy=2500)
    df = make_triples(rows).select(*TRIPLE_KEY)
    sample = ranges.key_sample(df, TRIPLE_KEY, 6)
    for order in (SPO, [*LAYOUTS["po"], *KEY_TAIL]):
        points = ranges.split_points(sample, order, 6)
        assert points.keys == sorted(points.keys, key=sort_key) and points.ranges <= 6
        for before, key in zip(points.keys, points.keys[1:], strict=False):
            assert key[0] == before[0] or set(key[1:]) == {None}  # cut, or the beginning of a value
        found = ranges.with_range(df, points).collect()
        for r in found:
            key = sort_key(tuple(r[c] for c in order))
            assert r[ranges.RANGE] == bisect.bisect_right([sort_key(k) for k in points.keys], key)
    assert ranges.split_points(sample, SPO, 6).cut() == ["urn:s77"]
    assert ranges.split_points(None, SPO, 6).keys == []


def test_split_points_of_written_samples(spark, make_triples, monkeypatch):
    monkeypatch.setattr(ranges, "HELD_KEYS", 0)
    df = make_triples(graph(random.Random(2), 1000, heavy=900)).select(*TRIPLE_KEY)
    sample = ranges.key_sample(df, TRIPLE_KEY, 4)
    assert sample.held is None and sample.n == 1900
    points = ranges.split_points(sample, SPO, 4)
    assert 2 <= points.ranges <= 4 and points.keys == sorted(points.keys, key=sort_key)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """Prefixes of two tables of one run: one without a subject that is cut, one with."""
    from spark_triples.schema import TRIPLE

    found = {}
    for name, heavy in (("even", 0), ("heavy", 4000)):
        rows = graph(random.Random(3), heavy=heavy)
        full = [tuple(r) + (None, None, None, "urn:string", None, None, "")[len(r) :] + (None,) for r in rows]
        prefix = f"{tmp_path_factory.mktemp(name)}/t_"
        sinks.write_indexes(spark.createDataFrame(full, TRIPLE).repartition(3), prefix, partitions=7)
        found[name] = prefix, {r[:7] for r in full}
    return found


@pytest.mark.parametrize("name", ["even", "heavy"])
def test_zone_map(spark, index, name):
    prefix, rows = index[name]
    for layout, order in LAYOUTS.items():
        order = [*order, *KEY_TAIL]
        zones = {z["file"]: z for z in sources.zone_map(spark, prefix, layout).collect()}
        copy = sources.read_run(spark, sources.index_paths(spark, prefix, layout), sources.TRIPLE)
        files = copy.select("*", F.col("_metadata.file_name").alias("file")).collect()
        assert {tuple(r[c] for c in TRIPLE_KEY) for r in files} == rows and len(files) == len(rows)
        assert len(zones) == 7
        for file, zone in zones.items():
            keys = [sort_key(r[c] for c in order) for r in files if r["file"] == file]
            assert len(keys) == zone["rows"] and keys == sorted(keys)
            assert zone["low"] is None or sort_key(zone["low"]) <= keys[0]
            assert zone["high"] is None or keys[-1] < sort_key(zone["high"])


def test_lookups_list_only_matching_files(spark, index):
    prefix, rows = index["heavy"]
    for bound in ({"subject": "urn:s5"}, {"predicate": "urn:p3", "obj": "o7é"}, {"obj": "o9é"}, {"subject": "none"}):
        names = {("object" if k == "obj" else k): v for k, v in bound.items()}
        expected = {r for r in rows if all(r[TRIPLE_KEY.index(k)] == v for k, v in names.items())}
        got = sources.lookup(spark, prefix, **bound)
        assert {tuple(r)[:7] for r in got.collect()} == expected
        assert len(got.inputFiles()) <= 4
    assert len(sources.paths_with(spark, prefix, "spo", "urn:s5")) == 1
    assert len(sources.paths_with(spark, prefix, "spo", "urn:s77")) >= 3
    assert sources.scan_index(spark, prefix, first="urn:s77").count() == sum(r[0] == "urn:s77" for r in rows)


def test_table_split_points(spark, index):
    prefix, rows = index["even"]
    for most in (1, 2, 3, 7, 50):
        points = sources.table_split_points(spark, prefix, "spo", most)
        assert points == sorted(set(points)) and len(points) <= most - 1
        sizes = [0] * (len(points) + 1)
        for r in rows:
            sizes[bisect.bisect_right(points, r[0])] += 1
        assert max(sizes) <= 2 * len(rows) / min(most, 7) + len(rows) / 5
    assert sources.table_split_points(spark, f"{prefix}none_", "spo", 3) == []


def rows_of(df):
    return sorted((repr(r.asDict(True)) for r in df.collect()))


@pytest.mark.parametrize("name", ["even", "heavy"])
@pytest.mark.parametrize("budget", [150, 100_000])
def test_groups_as_read(spark, index, name, budget):
    prefix, rows = index[name]
    everything = sources.scan_index(spark, prefix)
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for auths, predicates in (((), None), (("U",), ["urn:p1", "urn:p2"])):
        chosen = triples.visible(everything, auths)
        chosen = chosen if predicates is None else triples.filter_property(chosen, predicates)
        expected = rows_of(documents.group_by_subject(chosen, budget))
        got = sources.grouped_by_subject(spark, prefix, budget, auths, predicates)
        assert rows_of(got) == expected
        try:  # files in many splits: each has one row group, so one task still reads it whole
            spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
            got = sources.grouped_by_subject(spark, prefix, budget, auths, predicates)
            assert rows_of(got) == expected
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", small)
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = ["urn:p0", "urn:p3"]
    listed = triples.filter_property(triples.visible(everything), wanted)
    expected = rows_of(documents.nest_documents(documents.document_values(listed), budget))
    assert rows_of(sources.nested_documents(spark, prefix, wanted, budget)) == expected


def test_no_exchange_of_triples(spark, index):
    prefix, _ = index["even"]
    for df in (
        sources.grouped_by_subject(spark, prefix, 1000),
        sources.nested_documents(spark, prefix, ["urn:p1"], 1000),
    ):
        shown = plan(df)
        assert "Exchange" not in shown and "Sort" not in shown and "FileScan" in shown


def test_one_exchange_of_a_load(spark, make_triples):
    df = make_triples(graph(random.Random(5), 900))
    points = ranges.split_points(ranges.key_sample(df, TRIPLE_KEY, 3), SPO, 3)
    copy = ranges.sorted_distinct(ranges.in_ranges(df, points), points, [F.max("ts").alias("ts")])
    assert plan(copy).count("Exchange") == 1
    assert copy.count() == len({tuple(r) for r in df.select(*TRIPLE_KEY).collect()})


def test_files_in_pieces_are_refused(spark, index, tmp_path):
    prefix, _ = index["even"]
    zones = sources.zone_map(spark, prefix).withColumn("rows", F.col("rows") + 1)
    rows, _ = sources._sorted_rows(spark, prefix, zones)
    from spark_triples.operators.sorted_groups import stream_groups

    with pytest.raises(Exception, match="not read as a whole"):
        stream_groups(rows, F.lit(True), zones, 1000).collect()


def test_empty_and_missing(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/e_"
    assert sources.grouped_by_subject(spark, prefix, 100).collect() == []
    sinks.write_indexes(make_triples([]), prefix, partitions=3)
    assert sources.grouped_by_subject(spark, prefix, 100).collect() == []
    assert sources.nested_documents(spark, prefix, ["urn:p"], 100).collect() == []
    assert sources.lookup(spark, prefix, subject="urn:s").collect() == []
    sinks.write_indexes(make_triples([("urn:s", "urn:p", "o")]), prefix, partitions=3)
    assert sources.lookup(spark, prefix, obj="o").count() == 1
    assert [r["part"] for r in sources.grouped_by_subject(spark, prefix, 100).collect()] == [0]
    sinks.compact_index(spark, prefix, 2)
    sinks.remove_old(spark, prefix)
    assert sources.zone_map(spark, prefix).count() == 1


@pytest.mark.parametrize("heavy", [0, 2500])
@pytest.mark.parametrize("budget", [150, 100_000])
def test_groups_of_two_runs(spark, make_triples, tmp_path, heavy, budget):
    rows = graph(random.Random(9), 1500, heavy)
    prefix = f"{tmp_path}/two_"
    for k in (0, 1):  # a third of the triples are in both
        sinks.write_indexes(make_triples([r for i, r in enumerate(rows) if i % 3 != k]), prefix, partitions=5)
    assert bool(sources._cut(sources.zone_map(spark, prefix))) == bool(heavy)
    everything = triples.visible(sources.scan_index(spark, prefix))
    got = sources.grouped_by_subject(spark, prefix, budget)
    assert rows_of(got) == rows_of(documents.group_by_subject(everything, budget))
    if not heavy:  # equal triples become one, and subjects are grouped, behind one exchange
        assert plan(sources.grouped_by_subject(spark, prefix, budget)).count("Exchange") == 1


@pytest.mark.parametrize("partitions", [None, 6])
def test_counts_are_not_added_up_to_find_ranges(spark, make_triples, tmp_path, monkeypatch, partitions):
    prefix, table = f"{tmp_path}/c_", f"{tmp_path}/counts"
    sinks.write_indexes(make_triples([*graph(random.Random(11), 3000, 500), ("bare", "urn:p1", "o")]), prefix)

    def refused(*_):
        raise AssertionError("a range partitioner evaluates its input twice")

    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1)), "repartitionByRange", refused)
        m.setattr(sinks, "LEAST_RANGE_BYTES", 4_000)
        flows.statistics(spark, prefix, table, partitions=partitions, on_bad_iri="skip")
    shown = triples.visible(sources.scan_index(spark, prefix))
    assert rows_of(sources.read_prospects(spark, table)) == rows_of(prospects.prospect_counts(shown, "skip"))
    key = F.struct(*sinks._PROSPECT_ORDER)
    files = sources.read_prospects(spark, table).groupBy(F.input_file_name().alias("file"))
    files = files.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n")).sort("low").collect()
    assert len(files) >= 3 and max(f["n"] for f in files) <= sum(f["n"] for f in files) / 2
    assert all(a["high"] < b["low"] for a, b in zip(files, files[1:], strict=False))


def test_rows_without_object_weigh_nothing_in_two_runs(spark, tmp_path):
    schema = "subject string, predicate string, object string, object_type string, lang string, context string, visibility string, ts timestamp"
    rows = [("urn:s", f"urn:p{k}", None if k % 2 else "o" * 50, ANYURI, None, None, "", None) for k in range(9)]
    for half in (rows[:6], rows[3:]):
        sinks.write_indexes(spark.createDataFrame(half, schema), f"{tmp_path}/n_")
    got = sources.grouped_by_subject(spark, f"{tmp_path}/n_", 200)
    expected = documents.group_by_subject(spark.createDataFrame(rows, schema), 200)
    assert rows_of(got) == rows_of(expected)
    assert len(got.collect()) == 3
