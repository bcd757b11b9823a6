import subprocess
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from spark_triples.functions import ntriples
from spark_triples.plans import flows
from spark_triples.schema import ANYURI, LANG_STRING, RDF_TYPE, XSD, XSD_STRING
from spark_triples.sources import files
from spark_triples.sources.tables import scan_index
from spark_triples.sources.turtle import parse_turtle

from .fixtures import FILED, NT_LINES, TURTLE



BY_LINE = {t for t in FILED if t[0] in ("urn:boat:7", "urn:harbour:north")}


@pytest.fixture
def source_dir(tmp_path):
    (tmp_path / "north.nt").write_text("\n".join(NT_LINES))
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "south.ttl").write_text(TURTLE)
    return tmp_path


def rows(df):
    return [tuple(r) for r in df.select("subject", "predicate", "object", "object_type").collect()]


def parse(spark, lines, **options):
    df = spark.createDataFrame([(line, "f") for line in lines], "value string, file_path string")
    return files.parse_lines(df, **options)


def test_split_sources(spark):
    spec = " a/*.nt ,, b/*.ttl\t,c,"
    assert files.split_sources(spec) == ["a/*.nt", "b/*.ttl", "c"]
    df = spark.createDataFrame([(spec.strip(),)], "spec string")
    assert df.select(files.split_list(F.col("spec"))).first()[0] == ["a/*.nt", "b/*.ttl", "c"]


def test_route(spark):
    paths = ["x/*.nt", "x/a.NT", "x/*.ttl", "x/", "x.nt/y", "x/*", "x.nq"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    routes = {r["path"]: r["route"] for r in files.route_sources(df).collect()}
    assert [p for p in paths if routes[p] == "line"] == ["x/*.nt", "x/a.NT"]


def test_both_routes(spark, source_dir):
    spec = f"{source_dir}/*.nt,{source_dir}/folder/*.ttl"
    loaded = files.read_sources(spark, spec)
    assert len(rows(loaded)) == len(FILED) and set(rows(loaded)) == FILED
    assert {r["visibility"] for r in loaded.collect()} == {""}
    assert loaded.filter("ts is null").count() == 0


def test_bulk_load_finds_every_triple(spark, source_dir, tmp_path):
    from spark_triples.operators.triples import choose_layout, match_pattern

    prefix = f"{tmp_path}/out_"
    spec = f"{source_dir}/*.nt,{source_dir}/folder/*.ttl"
    flows.bulk_load(spark, spec, prefix)
    for layout in ("spo", "po", "osp"):
        assert set(rows(scan_index(spark, prefix, layout))) == FILED
    for s, p, o, _ in FILED:
        index = scan_index(spark, prefix, choose_layout(s, p, o))
        assert rows(match_pattern(index, s, p, o)) == [next(t for t in FILED if t[:3] == (s, p, o))]
    assert rows(match_pattern(scan_index(spark, prefix, "osp"), obj="urn:c")) == []


def test_loading_twice_changes_nothing_but_times(spark, source_dir, tmp_path):
    prefix, spec = f"{tmp_path}/twice_", f"{source_dir}/*.nt"
    flows.bulk_load(spark, spec, prefix, run="1")
    flows.bulk_load(spark, spec, prefix, run="1")
    assert len(rows(scan_index(spark, prefix))) == len(NT_LINES)
    first = scan_index(spark, prefix).agg(F.max("ts")).first()[0]
    flows.bulk_load(spark, spec, prefix, run="2")
    merged = scan_index(spark, prefix)
    assert len(rows(merged)) == len(NT_LINES)
    assert merged.agg(F.min("ts")).first()[0] > first


def test_wildcard_skips_directories_and_unknown_names(spark, source_dir):
    (source_dir / "notes.txt").write_text("not RDF")
    (source_dir / "noext").write_text("not RDF")
    found = files.read_whole_files(spark, [f"{source_dir}/*"])
    assert set(rows(found)) == BY_LINE
    rejected = files.rejected_sources(spark, [f"{source_dir}/*"]).collect()
    reasons = {r["path"].rsplit("/", 1)[-1]: r["reason"] for r in rejected}
    assert reasons == {
        "folder": "directory",
        "notes.txt": "unknown format",
        "noext": "unknown format",
    }


def test_missing_sources(spark, source_dir):
    assert rows(files.read_sources(spark, f"{source_dir}/*.none,{source_dir}/none-*.nt")) == []
    with pytest.raises(FileNotFoundError):
        files.read_sources(spark, f"{source_dir}/none.nt")


def test_known_format_needs_a_parser(spark, source_dir):
    (source_dir / "data.rj").write_text("x y z")
    with pytest.raises(ValueError, match="RDF/JSON"):
        files.read_whole_files(spark, [f"{source_dir}/*"])

    def by_words(content, path):
        s, p, o = content.decode().split()
        yield s, p, o, XSD_STRING, None, None

    found = files.read_whole_files(spark, [f"{source_dir}/*"], {"RDF/JSON": by_words})
    assert ("x", "y", "z", XSD_STRING) in rows(found)


def test_line_grammar(spark):
    lines = [
        "",
        "   # a comment",
        '<urn:a> <urn:p> "" . # trailing comment',
        '<urn:a> <urn:p> "x"@en-GB .',
        f'<urn:a> <urn:p> "12"^^<{XSD}integer> .',
        r'<urn:a> <urn:p> "q\" t\t n\n b\\ éé \U0001F600 😀 \'" .',
        "<urn:a><urn:p><urn:é>.",
    ]
    parsed = [
        (r["object"], r["object_type"], r["lang"]) for r in parse(spark, lines).collect()
    ]
    assert parsed == [
        ("", XSD_STRING, None),
        ("x", LANG_STRING, "en-GB"),
        ("12", XSD + "integer", None),
        ("q\" t\t n\n b\\ éé 😀 😀 '", XSD_STRING, None),
        ("urn:é", ANYURI, None),
    ]


def test_very_long_literal(spark):
    text = "word " * 100_000
    line = f'<urn:a> <urn:p> "{text}\\n{text}" .'
    assert parse(spark, [line]).first()["object"] == f"{text}\n{text}"
    literals = "\n".join(f'<urn:a> <urn:p> """{text}\n\\t{text}""" .' for _ in range(2))
    assert [len(t[2]) for t in parse_turtle(literals.encode(), "f")] == [1_000_002] * 2


def test_blank_nodes_are_scoped_by_file(spark, tmp_path):
    for name in ("one.nt", "two.nt"):
        (tmp_path / name).write_text("_:b1 <urn:p> _:b2 .\n_:b2 <urn:p> _:b1 .\n")
    found = rows(files.read_ntriples(spark, [f"{tmp_path}/*.nt"]))
    assert len({r[0] for r in found}) == 4
    assert {r[0] for r in found} == {r[2] for r in found}
    assert {r[3] for r in found} == {ANYURI}


@pytest.mark.parametrize(
    "line",
    [
        "junk",
        "<urn:a> <urn:p> <urn:b>",
        '<urn:a> <urn:p> "open .',
        r'<urn:a> <urn:p> "bad \q escape" .',
        r'<urn:a> <urn:p> "lone \uD800 surrogate" .',
        r'<urn:a> <urn:p> "\UFFFFFFFF" .',
        '"literal" <urn:p> <urn:b> .',
        "<urn:a> _:b <urn:b> .",
        "<urn:a b> <urn:p> <urn:b> .",
        "<urn:a> <urn:p> <urn:b> <urn:graph> .",
    ],
)
def test_malformed_line(spark, line):
    good = "<urn:a> <urn:p> <urn:b> ."
    with pytest.raises(Exception, match="malformed line"):
        parse(spark, [good, line]).count()
    assert parse(spark, [good, line], mode="DROPMALFORMED").count() == 1
    kept = parse(spark, [good, line], mode="PERMISSIVE").filter("_corrupt is not null")
    assert [(r["_corrupt"], r["subject"]) for r in kept.collect()] == [(line, None)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode must be"):
        parse(spark, [], mode="STRICT")


def test_quads(spark):
    lines = [
        "<urn:a> <urn:p> <urn:b> <urn:g> .",
        '<urn:a> <urn:p> "x"@en <urn:g> .',
        "<urn:a> <urn:p> <urn:b> .",
    ]
    parsed = parse(spark, lines, quads=True).collect()
    assert [r["context"] for r in parsed] == ["urn:g", "urn:g", None]


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=200, max_size=200
    )
)
def test_rendered_lines_parse_back(spark, make_triples, texts):
    triples = make_triples([("urn:s", f"urn:p:{i}", text) for i, text in enumerate(texts)])
    lines = triples.select(
        ntriples.render_line().alias("value"), F.lit("f").alias("file_path")
    )
    parsed = {r[1]: r[2] for r in rows(files.parse_lines(lines))}
    assert parsed == {f"urn:p:{i}": text for i, text in enumerate(texts)}


def test_turtle():
    text = """
    @base <http://b/> . @prefix : <http://d/> . PREFIX x: <http://x#>
    # a comment
    <s> a :T , x:U ; x:p 'one', "two"@en, "3"^^x:n, \"\"\"long "quoted"
    text\"\"\" ; x:i 42, -1.5, 1e3, true ; .
    _:n x:q [ x:r "inner" ] , ( 1 <e> ) .
    [ x:only "bnode" ] .
    :dots.in.name x:p :end.
    x:esc\\,aped x:p "tab\\t\\u00e9 \\uD83D\\uDE00" .
    """
    triples = list(parse_turtle(text.encode(), "f"))
    plain = {t[:4] for t in triples if not t[0].startswith("_:") and not t[2].startswith("_:")}
    assert plain == {
        ("http://b/s", RDF_TYPE, "http://d/T", ANYURI),
        ("http://b/s", RDF_TYPE, "http://x#U", ANYURI),
        ("http://b/s", "http://x#p", "one", XSD_STRING),
        ("http://b/s", "http://x#p", "two", LANG_STRING),
        ("http://b/s", "http://x#p", "3", "http://x#n"),
        ("http://b/s", "http://x#p", 'long "quoted"\n    text', XSD_STRING),
        ("http://b/s", "http://x#i", "42", XSD + "integer"),
        ("http://b/s", "http://x#i", "-1.5", XSD + "decimal"),
        ("http://b/s", "http://x#i", "1e3", XSD + "double"),
        ("http://b/s", "http://x#i", "true", XSD + "boolean"),
        ("http://d/dots.in.name", "http://x#p", "http://d/end", ANYURI),
        ("http://x#esc,aped", "http://x#p", "tab\té 😀", XSD_STRING),
    }
    inner = {t[1:3] for t in triples if t[0].startswith("_:")}
    assert ("http://x#r", "inner") in inner and ("http://x#only", "bnode") in inner
    assert len([t for t in triples if t[1].endswith("#first")]) == 2


@pytest.mark.parametrize(
    "text", ["<s> <urn:p> <urn:o> .", "x:a <urn:p> 1 .", "<urn:a> <urn:p> 1", "<urn:a> ~ 1 .", "@prefix a:b <urn:x> ."]
)
def test_bad_turtle_fails_the_job(spark, tmp_path, text):
    (tmp_path / "bad.ttl").write_text(text)
    with pytest.raises(Exception, match="relative IRI|unknown prefix|expected|unexpected"):
        files.read_whole_files(spark, [f"{tmp_path}/*.ttl"]).collect()


def test_line_files_on_the_whole_file_route(spark, tmp_path):
    (tmp_path / "a.nq").write_text("<urn:a> <urn:p> <urn:b> <urn:g> .\n")
    (tmp_path / "b.nt").write_text("<urn:c> <urn:p> <urn:d> .\n")
    found = files.read_whole_files(spark, [f"{tmp_path}/*"]).collect()
    assert {(r["subject"], r["context"]) for r in found} == {("urn:a", "urn:g"), ("urn:c", None)}


def test_only_files_of_the_format_are_read(spark, tmp_path):
    (tmp_path / "a.nt").write_text("<urn:a> <urn:p> <urn:b> .\n")
    (tmp_path / "b.TTL").write_text("<urn:c> <urn:p> <urn:d> .")
    (tmp_path / "c.d.ttl").write_text("<urn:e> <urn:p> <urn:f> .")
    (tmp_path / "ttl").write_text("no extension")
    pattern = [f"{tmp_path}/*"]
    found = files.read_whole_files(spark, pattern)
    assert {r[0] for r in rows(found)} == {"urn:a", "urn:c", "urn:e"}
    for name, count in (("Turtle", 2), ("N-Triples", 1), ("N-Quads", 0)):
        assert files.read_lines(spark, pattern, name).count() == count


def test_parser_needs_no_package_on_the_worker(tmp_path):
    parse = files._parse_with(parse_turtle, ["s", "p", "o", "t", "l", "c"])
    (tmp_path / "task.pickle").write_bytes(cloudpickle.dumps(parse))
    script = (
        "import pickle, pandas as pd; parse = pickle.load(open('task.pickle', 'rb')); "
        "f = pd.DataFrame({'path': ['f'], 'content': [b'<urn:a> a <urn:b>, <urn:c> .']}); "
        "print(sum(len(rows) for rows in parse([f])))"
    )
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env={}, capture_output=True, text=True
    )
    assert done.stdout.strip() == "2", done.stderr


def test_hidden_files_fail_or_are_reported(spark, source_dir):
    (source_dir / "_h.nt").write_text('<urn:h> <urn:p> "x" .\n')
    with pytest.raises(ValueError, match="_h.nt"):
        files.read_ntriples(spark, [f"{source_dir}/_h.nt"])
    for pattern in (f"{source_dir}/*", f"{source_dir}"):
        found = files.rejected_sources(spark, [pattern]).collect()
        assert [r["reason"] for r in found if r["path"].endswith("_h.nt")] == ["hidden name"]


def test_permissive_on_mixed_routes(spark, source_dir):
    (source_dir / "bad.nt").write_text("not a triple\n")
    spec = f"{source_dir}/bad.nt,{source_dir}/*.ttl"
    found = files.read_sources(spark, spec, mode="PERMISSIVE")
    assert [r["_corrupt"] for r in found.filter("_corrupt is not null").collect()] == ["not a triple"]


def test_line_ends_are_ends(spark):
    for end in ("\u2028", "\u2029", "\x85"):
        with pytest.raises(Exception, match="malformed"):
            parse(spark, [f'<urn:a> <urn:p> "hi"@en .{end}']).collect()
        kept = parse(spark, [f'<urn:a> <urn:p> "hi"@en . # a{end}b']).collect()
        assert [r["lang"] for r in kept] == ["en"]


@pytest.mark.parametrize("text", ["<u:a> [] <u:b> .", "<u:a> (<u:x>) <u:b> .", "<u:a> _:p <u:b> .", "<u:a> <u:p> \"1\"^^_:t ."])
def test_predicates_and_datatypes_are_iris(text):
    with pytest.raises(ValueError, match="expected a term"):
        list(files.parse_turtle(text.encode(), "f"))


@pytest.mark.parametrize("mode", ["PERMISSIVE", "DROPMALFORMED"])
def test_a_load_tells_what_it_left_out(spark, source_dir, tmp_path, mode):
    from spark_triples.sources.tables import read_rejects

    (source_dir / "bad.nt").write_text('<urn:x> <urn:p> "1" .\nno statement\n# a comment\n<urn:y> .')
    (source_dir / "folder" / "notes.txt").write_text("not RDF")
    prefix = f"{tmp_path}/bad_"
    spec = f"{source_dir}/bad.nt,{source_dir}/folder/*"
    with pytest.raises(Exception, match="malformed line"):
        flows.bulk_load(spark, spec, prefix)
    assert read_rejects(spark, prefix).count() == 0  # nothing is published
    for _ in range(2):
        flows.bulk_load_with_statistics(spark, spec, prefix, f"{tmp_path}/counts", on_bad_line=mode)
    assert set(rows(scan_index(spark, prefix))) == {
        ("urn:x", "urn:p", "1", XSD_STRING), *(t for t in FILED if t not in BY_LINE)
    }
    found = {(r["path"].rsplit("/", 1)[1], r["reason"], r["line"]) for r in read_rejects(spark, prefix).collect()}
    assert found == {
        ("bad.nt", "malformed line", "no statement"),
        ("bad.nt", "malformed line", "<urn:y> ."),
        ("notes.txt", "unknown format", None),
    }


def test_many_lines_in_ranges(spark, tmp_path, monkeypatch):
    """Ranges are laid out from a share of the lines."""
    monkeypatch.setattr(flows, "SAMPLED_PER_RANGE", 40)
    lines = [f'<urn:s{k % 700}> <urn:p{k % 3}> "{k % 900}" .' for k in range(4000)]
    (tmp_path / "many.nt").write_text("\n".join(lines))
    flows.bulk_load(spark, f"{tmp_path}/many.nt", f"{tmp_path}/m_", partitions=4)
    assert len(rows(scan_index(spark, f"{tmp_path}/m_"))) == len(set(lines))
    assert len(scan_index(spark, f"{tmp_path}/m_", "osp").inputFiles()) == 4


def test_bulk_loads_add_up(spark, source_dir, tmp_path):
    """Without a name a load is named by its files: others add, the same change nothing."""
    prefix, counts = f"{tmp_path}/add_", f"{tmp_path}/counts"
    for n in (1, 2, 1, 2):
        (source_dir / "n1.nt").exists() or [
            (source_dir / f"n{k}.nt").write_text(f'<urn:x#{k}> <urn:p> "{k}" .\n') for k in (1, 2)
        ]
        flows.bulk_load_with_statistics(spark, f"{source_dir}/n{n}.nt", prefix, counts)
    assert scan_index(spark, prefix).count() == 2
    from spark_triples.sources.tables import read_prospects

    found = read_prospects(spark, counts).filter("triple_value_type = 'predicate'").collect()
    assert [r["count"] for r in found] == [2]


def test_many_tasks_look_for_malformed_lines(spark, source_dir, tmp_path, monkeypatch):
    """What a load leaves out is gathered by the tasks that read the lines, not by one."""
    from spark_triples.sources.tables import read_rejects

    def by_task(spark, spec):
        task = F.spark_partition_id().cast("string").alias("line")
        return spark.range(0, 40, 1, 4).select(F.lit("p").alias("path"), F.lit("r").alias("reason"), task)

    monkeypatch.setattr(flows, "rejected_lines", by_task)
    (source_dir / "bad.nt").write_text('<urn:x> <urn:p> "1" .\nno statement\n')
    flows.bulk_load(spark, f"{source_dir}/bad.nt", f"{tmp_path}/tasks_", on_bad_line="PERMISSIVE")
    left_out = read_rejects(spark, f"{tmp_path}/tasks_").collect()
    assert len(left_out) == 40 and len({r["line"] for r in left_out}) == 4
