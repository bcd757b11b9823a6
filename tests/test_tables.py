import math
from pathlib import Path
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_triples import manifest, session
from spark_triples.operators.documents import document_values
from spark_triples.operators import triples as ops
from spark_triples.schema import LAYOUTS, TRIPLE
from spark_triples.sinks import tables as sinks
from spark_triples.sources import tables as sources

from .fixtures import AT, CARRIES, GRAPH, NAME, TEMPERATURE


def test_ensure_tables_twice(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/t_"
    for _ in range(2):
        assert sinks.ensure_tables(spark, prefix) == [
            prefix + n for n in ("spo", "po", "osp", "ns")
        ]
        assert sources.scan_index(spark, prefix, "ns").collect() == []
        sinks.write_indexes(make_triples(GRAPH), prefix)
        assert sources.scan_index(spark, prefix).count() == len(GRAPH)


def test_tables_are_sorted_and_whole(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/t_"
    sinks.write_indexes(make_triples(GRAPH), prefix, partitions=3)
    for name, order in LAYOUTS.items():
        index = sources.scan_index(spark, prefix, name)
        assert index.schema.names == TRIPLE.names and index.count() == len(GRAPH)
        for path in Path(f"{prefix}{name}").rglob("*.parquet"):
            keys = [tuple(r) for r in spark.read.parquet(str(path)).select(*order).collect()]
            assert keys == sorted(keys)


def test_failed_runs_leave_the_former_state(spark, make_triples, tmp_path):
    table = f"{tmp_path}/t_spo"
    sinks.write_table(make_triples(GRAPH[:2]), table, "1")
    failing = make_triples(GRAPH[2:]).filter(F.raise_error(F.lit("no")).isNull())
    for run, mode in (("1", "rerun"), ("2", "add"), ("2", "replace")):
        with pytest.raises(Exception, match="no"):
            sinks.write_table(failing, table, run, mode=mode)
        assert sources.scan_index(spark, f"{tmp_path}/t_").count() == 2
    sinks.write_table(make_triples(GRAPH[2:]), table, "1")  # the name is there: no change
    assert sources.scan_index(spark, f"{tmp_path}/t_").count() == 2
    sinks.write_table(make_triples(GRAPH[2:]), table, "1", mode="rerun")
    assert sources.scan_index(spark, f"{tmp_path}/t_").count() == len(GRAPH) - 2
    sinks.write_table(make_triples(GRAPH[:1]), table, "3", mode="replace")
    assert sources.scan_index(spark, f"{tmp_path}/t_").count() == 1


def test_manifests(spark, tmp_path):
    root = f"{tmp_path}/m/"
    assert manifest.read_state(spark, root) == (0, {})
    for n in range(1, 4):
        assert manifest.update(spark, root, lambda number, state: state | {str(number): 1}) == n
    assert manifest.read_state(spark, root) == (3, {"1": 1, "2": 1, "3": 1})
    (tmp_path / "m/manifests" / f"{4:012d}.json").write_text('{"torn')
    assert manifest.read_state(spark, root)[0] == 3
    assert manifest.update(spark, root, lambda _, state: state) == 5
    assert manifest.read_state(spark, root) == (5, {"1": 1, "2": 1, "3": 1})


def test_merged_runs_are_not_added_again(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/t_"
    for run in ("a", "b"):
        sinks.write_indexes(make_triples(GRAPH[:3] if run == "a" else GRAPH[2:]), prefix, run)
    sinks.compact_index(spark, prefix)
    sinks.write_indexes(make_triples([("urn:x", "urn:y", "z")]), prefix, "a")
    assert sources.scan_index(spark, prefix).count() == len(GRAPH)
    with pytest.raises(ValueError, match="merged"):
        sinks.write_indexes(make_triples(GRAPH), prefix, "b", mode="rerun")
    sinks.write_indexes(make_triples([("urn:x", "urn:y", "z")]), prefix)
    assert sources.scan_index(spark, prefix, "po").count() == len(GRAPH) + 1
    sinks.remove_old(spark, prefix)
    for name in LAYOUTS:
        assert sources.scan_index(spark, prefix, name).count() == len(GRAPH) + 1
        assert len(list(Path(f"{prefix}{name}").glob("run=*"))) == 2


def test_time_filter_reaches_the_scan_of_many_runs(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/t_"
    for run in ("a", "b"):
        sinks.write_indexes(make_triples(GRAPH), prefix, run)
    assert "GreaterThanOrEqual(ts," in plan(sources.scan_index(spark, prefix, since_ms=1000))


def test_run_and_mode_names(make_triples, tmp_path):
    with pytest.raises(ValueError, match="run"):
        sinks.write_table(make_triples(GRAPH), f"{tmp_path}/t", "a/b")
    with pytest.raises(ValueError, match="mode"):
        sinks.write_table(make_triples(GRAPH), f"{tmp_path}/t", mode="overwrite")


def test_compact_index(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/t_"
    sinks.write_indexes(make_triples(GRAPH[:3]), prefix, run="1")
    sinks.write_indexes(make_triples(GRAPH[2:]), prefix, run="2")
    assert sources.scan_index(spark, prefix, "osp").count() == len(GRAPH)
    sinks.compact_index(spark, prefix)
    for name in LAYOUTS:
        assert len(sources.index_paths(spark, prefix, name)) == 1
        assert sources.scan_index(spark, prefix, name).count() == len(GRAPH)


def test_routed(spark, make_triples, tmp_path):
    sinks.write_routed(make_triples(GRAPH), f"{tmp_path}/r", "predicate")
    back = spark.read.parquet(f"{tmp_path}/r").groupBy("predicate").count()
    assert {tuple(r) for r in back.collect()} == {(NAME, 2), (CARRIES, 1), (AT, 2), (TEMPERATURE, 4)}


def test_dedup_keeps_latest(spark, make_triples):
    rows = make_triples(GRAPH + GRAPH[:2]).withColumn(
        "ts", F.timestamp_seconds(F.monotonically_increasing_id())
    )
    kept = ops.dedup_triples(rows)
    assert kept.count() == len(GRAPH)
    latest = rows.groupBy("subject", "predicate", "object", "object_type").agg(F.max("ts"))
    assert {r["ts"] for r in kept.collect()} == {r[-1] for r in latest.collect()}


@pytest.mark.parametrize("count", [0, 1, 2, 9, 100])
def test_key_ranges(spark, count):
    points = [f"k{i:03d}" for i in range(0, 2 * count, 2)]
    keys = ["", "a", *[f"k{i:03d}" for i in range(2 * count + 2)], "z"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for r in ops.key_ranges(df, F.col("k"), points).collect():
        assert r["range_id"] == sum(p <= r["k"] for p in points)


@pytest.mark.parametrize("size", [0, 1, 7, 10_000])
def test_local_batches(spark, size):
    rows = spark.range(0, 1003, 1, 4)
    batched = ops.local_batches(rows, size)
    sizes = [r["count"] for r in batched.groupBy("batch_id").count().collect()]
    assert sum(sizes) == 1003 and max(sizes) <= max(size, 1) and min(sizes) > 0
    assert len(sizes) == {0: 1003, 1: 1003, 7: 144, 10_000: 4}[size]
    assert "Exchange" not in plan(batched)


def test_rebalance_keeps_rows(spark):
    for df in (ops.rebalance(spark.range(100), 7), ops.rebalance(spark.range(100))):
        assert df.agg(F.sum("id")).first()[0] == 4950


def test_require_not_null_survives_column_pruning(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    with pytest.raises(Exception, match="s can't be null"):
        ops.require_not_null(df, ["s"]).select("i").collect()


def fake_session(master, setting=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    conf = SimpleNamespace(get=lambda name, default: setting or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == session.shared_dir(spark)
    cluster = "spark://host:7077"
    assert session.shared_dir(fake_session(cluster, "hdfs:/shared/")) == "hdfs:/shared"
    assert session.shared_dir(fake_session(cluster, None, "hdfs:/c")) == "hdfs:/c"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake_session(cluster))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, make_triples, tmp_path):
    from spark_triples.operators.prospects import count_by_type, prospect_counts
    from spark_triples.operators.skew import key_join
    from spark_triples.sources.files import read_ntriples

    prefix = f"{tmp_path}/t_"
    sinks.write_indexes(make_triples(GRAPH), prefix)
    scan = sources.scan_index(spark, prefix)
    lookup = plan(
        ops.match_pattern(scan, subject="urn:a", obj="urn:b", object_type="urn:t")
    )
    for pushed in ("EqualTo(subject,urn:a)", "EqualTo(object,urn:b)", "EqualTo(object_type,"):
        assert pushed in lookup
    assert "Exchange" not in lookup
    assert "In(predicate, [urn:p,urn:q])" in plan(ops.filter_property(scan, ["urn:p", "urn:q"]))
    assert "LessThanOrEqual(ts," in plan(ops.filter_time(scan, None, 1000))

    few = spark.createDataFrame([("urn:a",), ("urn:b",)], "subject string")
    semi = plan(key_join(scan, few, "subject", "left_semi"))
    assert "In(subject, [urn:a,urn:b])" in semi and "Join" not in semi

    counts = plan(prospect_counts(ops.visible(scan)))
    assert counts.count("Exchange hashpartitioning") == 1
    assert "Expand" in counts and "partial_count" in counts and "Python" not in counts
    narrow = plan(count_by_type(ops.visible(scan), "predicate"))
    assert "ReadSchema: struct<predicate:string,visibility:string>" in narrow

    (tmp_path / "a.nt").write_text("<urn:a> <urn:b> <urn:c> .\n")
    parsed = plan(read_ntriples(spark, [f"{tmp_path}/a.nt"]))
    assert "Python" not in parsed and "Exchange" not in parsed


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=150), st.integers(2, 5))
def test_runs_due(sizes, tier):
    """Whatever the sizes of new runs, few stay, and no row is merged often."""
    unit = sinks.FIRST_CLASS_BYTES
    runs, merges = [], {}
    for number, size in enumerate(sizes):
        runs.append((size * unit // 4, [number]))
        while n := sinks.runs_due([r[0] for r in runs], tier):
            assert 2 <= n <= len(runs)
            merged = [x for r in runs[-n:] for x in r[1]]
            for x in merged:
                merges[x] = merges.get(x, 0) + 1
            runs[-n:] = [(sum(r[0] for r in runs[-n:]), merged)]
    assert [x for r in runs for x in r[1]] == list(range(len(sizes)))  # in order, none lost
    classes = 2 + int(math.log(max(sum(sizes), 1), tier)) if sizes else 0
    assert len(runs) <= (tier - 1) * (classes + 1) * (classes + 1)
    assert max(merges.values(), default=0) <= classes + 1


def test_a_thousand_runs_of_one_size():
    runs = []
    for _ in range(1000):
        runs.append(1 << 20)
        while n := sinks.runs_due(runs, 4):
            runs[-n:] = [sum(runs[-n:])]
    assert len(runs) <= 3 * 5 + 1


def test_runs_are_merged_as_they_are_written(spark, make_triples, tmp_path):
    table, kept = f"{tmp_path}/docs", f"{tmp_path}/kept"
    for k in range(9):
        rows = make_triples([(f"urn:s{k % 4}", "urn:p", f"v{k}"), (f"urn:t{k}", "urn:p", "x")])
        sinks.write_documents(document_values(rows), table)
        sinks.write_documents(document_values(rows), kept, tier=None)
    assert len(sources.run_paths(spark, table)) <= 4
    assert len(sources.run_paths(spark, kept)) == 9
    as_rows = lambda path: sorted(map(tuple, sources.read_documents(spark, path).collect()), key=repr)
    assert as_rows(table) == as_rows(kept)
    values = {r["id"]: r["value"] for r in sources.read_documents(spark, table).collect()}
    assert values["urn:s0"] == "v8" and values["urn:s1"] == "v5"
    names = [n for r in manifest.read_runs(spark, f"{table}/") for n in r.merged]
    assert names == []  # nobody can repeat a run without a name


def test_index_runs_due_by_size(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/t_"
    for k in range(5):
        sinks.write_indexes(make_triples(GRAPH[k : k + 5]), prefix, run=f"r{k}")
    sinks.compact_index(spark, prefix, tier=4)
    assert len(manifest.read_runs(spark, prefix)) == 1
    sinks.write_indexes(make_triples(GRAPH), prefix, run="r3")  # known, though merged
    assert sources.scan_index(spark, prefix, "po").count() == len(GRAPH)


def test_new_triples(spark, make_triples, tmp_path):
    prefix = f"{tmp_path}/t_"
    clash = (GRAPH[0][0], GRAPH[0][1], GRAPH[0][2], GRAPH[0][3], None)  # no language
    for run, rows in (("a", GRAPH[:4]), ("b", [*GRAPH[2:6], clash]), ("c", GRAPH), ("d", [])):
        sinks.write_indexes(make_triples(rows), prefix, run=run)
    runs = manifest.names_of(manifest.read_runs(spark, prefix))
    expected = {"a": GRAPH[:4], "b": [*GRAPH[4:6], clash], "c": GRAPH[6:], "d": []}
    for run, rows in expected.items():
        got = sources.new_triples(spark, prefix, runs[run])
        assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(r[:3] for r in rows)


def test_new_triples_of_a_large_run(spark, make_triples, tmp_path, monkeypatch):
    """More rows than may be broadcast: the runs meet by one join, no keys are written first."""
    prefix = f"{tmp_path}/"
    for run, subjects in (("a", range(6)), ("b", range(3, 9))):
        rows = [(f"urn:x#{i}", "urn:p#q", "v", "urn:type", "en" if i % 2 else None) for i in subjects]
        sinks.write_indexes(make_triples(rows), prefix, run)
    runs = {r.name: r for r in manifest.read_runs(spark, prefix)}

    def fail(*_, **__):
        raise AssertionError("keys were written")

    monkeypatch.setattr(sources, "BROADCAST_KEYS", 5, raising=False)
    monkeypatch.setattr(sources, "key_join", fail)
    got = sources.new_triples(spark, prefix, runs["b"])
    assert sorted(r["subject"] for r in got.collect()) == [f"urn:x#{i}" for i in range(6, 9)]


def test_names_of_own(make_triples, tmp_path):
    for name in ("own-1", "merged-1"):
        with pytest.raises(ValueError, match="run"):
            sinks.write_table(make_triples(GRAPH), f"{tmp_path}/t", name)


def test_ranges_follow_the_rows(spark, make_triples, tmp_path, monkeypatch):
    """Also where nobody says how many ranges there should be, and more than shuffle partitions."""
    monkeypatch.setattr(sinks, "RANGE_ROWS", 50)
    made = make_triples([(f"urn:s{k:03}", "urn:p", str(k)) for k in range(600)])
    for k in range(2):
        sinks.write_indexes(made.filter(f"object % 2 = {k}"), f"{tmp_path}/many_", partitions=None if k else 2)
    folders = sources.index_paths(spark, f"{tmp_path}/many_", "spo")
    assert [len(sources.read_run(spark, f, TRIPLE).inputFiles()) for f in folders] == [2, 6]
    sinks.compact_index(spark, f"{tmp_path}/many_")
    merged = sources.scan_index(spark, f"{tmp_path}/many_")
    assert len(merged.inputFiles()) == 12 and merged.count() == 600


def test_runs_are_merged_by_tasks_of_a_bounded_size(spark, make_triples, tmp_path, monkeypatch):
    """Rows of runs, which have nothing to combine, go to as many tasks as their bytes ask for."""
    from spark_triples.operators.prospects import prospect_counts

    made = make_triples([(f"urn:s{k:03}", "urn:p", str(k)) for k in range(200)])
    for k in range(2):
        sinks.write_indexes(made.filter(f"object % 3 <> {k}"), f"{tmp_path}/m_", partitions=2)
        sinks.write_prospects(prospect_counts(made.filter(f"object % 2 = {k}")), f"{tmp_path}/c")
    monkeypatch.setattr(sources, "TASK_BYTES", 100)
    scan = sources.scan_index(spark, f"{tmp_path}/m_")
    wanted = -(-sources.bytes_of(spark, sources.index_paths(spark, f"{tmp_path}/m_", "spo")) // 100)
    assert scan.rdd.getNumPartitions() == wanted > 50
    assert scan.count() == 200
    counts = sources.read_prospects(spark, f"{tmp_path}/c")
    assert counts.rdd.getNumPartitions() > 50
    assert {r["count"] for r in counts.filter("triple_value_type = 'predicate'").collect()} == {200}


def test_small_splits_are_for_the_jobs_inside(spark, tmp_path):
    spark.range(0, 1000, 1, 40).write.parquet(f"{tmp_path}/rows")
    names = session.SPLITS

    def tasks():
        return spark.read.parquet(f"{tmp_path}/rows").rdd.getNumPartitions()

    before, usual = [spark.conf.get(n, None) for n in names], tasks()
    with session.small_splits(spark, 1000):
        assert tasks() >= 40 > usual
    assert [spark.conf.get(n, None) for n in names] == before and tasks() == usual
