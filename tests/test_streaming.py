from spark_triples.operators.documents import document_values
from spark_triples.operators.triples import filter_property
from spark_triples.plans import flows
from spark_triples.sinks import tables as sinks
from spark_triples.sources import tables as sources
from spark_triples.schema import TRIPLE
from spark_triples.streaming import refresh

from .fixtures import NT_LINES
from .test_documents import CHANGED, MORNING, NOW, TEMPERATURE, row, whole


def test_ingest_each_line_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.nt").write_text("\n".join(NT_LINES))
    for name in ("2.nt", "3.nt", None):
        stream = refresh.stream_lines(spark, str(source))
        assert refresh.with_watermark(stream).isStreaming
        query = refresh.ingest(stream, f"{tmp_path}/out", f"{tmp_path}/state")
        query.awaitTermination()
        if name:
            (source / name).write_text(f'<urn:{name}> <urn:p> "x" .\n')
    found = spark.read.schema(TRIPLE).parquet(f"{tmp_path}/out")
    assert found.count() == len(NT_LINES) + 2 and found.filter("ts is null").count() == 0


def test_refresh_equals_batch(spark, make_triples, tmp_path):
    prefix, docs = f"{tmp_path}/t_", f"{tmp_path}/docs"
    sinks.write_indexes(make_triples(CHANGED), prefix, run="1")

    def run():
        refresh.refresh_from_runs(
            spark, prefix, [TEMPERATURE], docs, f"{tmp_path}/state"
        ).awaitTermination()
        return whole(sources.read_documents(spark, docs))

    def batch():
        rows = filter_property(sources.scan_index(spark, prefix), [TEMPERATURE])
        return whole(document_values(rows))

    assert run() == batch()
    sinks.write_indexes(make_triples([row(MORNING, TEMPERATURE, "new", ts=NOW)]), prefix, run="2")
    assert run() == batch()
    assert batch()[MORNING][1] == ["-4.5", "new"]
    runs = sources.run_paths(spark, docs)
    assert len(runs) == 2
    # the second batch wrote the changed subject only
    written = sources.read_run(spark, runs[1], sources.DOCUMENT)
    assert written.select("id").distinct().count() == 1
    flows.fulltext_full(spark, prefix, [TEMPERATURE], f"{tmp_path}/full")
    assert whole(sources.read_documents(spark, f"{tmp_path}/full")) == batch()


def test_refresh_before_the_first_load(spark, make_triples, tmp_path):
    prefix, docs = f"{tmp_path}/t_", f"{tmp_path}/docs"

    def run():
        refresh.refresh_from_runs(
            spark, prefix, [TEMPERATURE], docs, f"{tmp_path}/state"
        ).awaitTermination()

    run()
    sinks.write_indexes(make_triples(CHANGED), prefix)
    run()
    assert set(whole(sources.read_documents(spark, docs))) == {r[0] for r in CHANGED if r[1] == TEMPERATURE}


def test_distinct_triples_of_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name in ("1.nt", "2.nt"):
        (source / name).write_text("\n".join(NT_LINES * 3))
    stream = refresh.stream_lines(spark, str(source))
    refresh.ingest(stream, f"{tmp_path}/out", f"{tmp_path}/state", distinct=True).awaitTermination()
    assert spark.read.schema(TRIPLE).parquet(f"{tmp_path}/out").count() == len(NT_LINES)
