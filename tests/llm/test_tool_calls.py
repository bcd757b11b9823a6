"""Tool calls: chains, cycles, repeated and missing identifiers, schemas."""

import json

from pyspark.sql import functions as F

from spark_triples.llm import tool_calls as t

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after string, extra int"
RESULTS = "conv_id long, call_id string, turn long, content string, role string"
GOOD = '{"query":"q","limit":3}'


def link(spark, calls, results=(), conv_id=1):
    """Results are of one conversation."""
    return t.link(
        spark.createDataFrame([(*c, 1) for c in calls], CALLS),
        spark.createDataFrame([(conv_id, *r, "tool") for r in results], RESULTS),
    )


def linked(spark, calls, results=()):
    found = link(spark, calls, results)
    return {r["call_id"]: r for r in found.collect()}


def test_order_of_chains_and_cycles(spark):
    calls = [(1, k, f"c{k}", "search", GOOD, f"c{k - 1}") for k in range(100)]
    calls += [(2, 0, "x", "search", GOOD, "y"), (2, 1, "y", "search", GOOD, "x"), (2, 2, "z", "search", GOOD, "x")]
    calls += [(3, 0, "self", "search", GOOD, "self"), (3, 1, "lost", "search", GOOD, "nowhere")]
    found = linked(spark, calls, [(f"c{k}", 0, "r") for k in range(100)])
    assert [found[f"c{k}"]["depth"] for k in range(100)] == list(range(100))
    assert all(found[f"c{k}"]["status"] == "ok" for k in range(100))
    assert {found[c]["status"] for c in ("x", "y", "z", "self")} == {"cycle"}
    assert (found["lost"]["depth"], found["lost"]["status"]) == (0, "no_result")


def test_schemas(spark):
    cases = {
        "ok": ("search", GOOD, ""),
        "none": ("search", None, "arguments: no object; limit: missing; query: missing"),
        "text": ("search", "not json", "arguments: no object; limit: missing; query: missing"),
        "list": ("search", "[1]", "arguments: no object; limit: missing; query: missing"),
        "kind": ("search", '{"query":5,"limit":"3"}', "limit: not BIGINT; query: not STRING"),
        "null": ("search", '{"query":"q","limit":null}', "limit: missing"),
        "low": ("search", '{"query":"q","limit":0}', "limit: below 1"),
        "high": ("search", '{"query":"q","limit":13}', "limit: above 12"),
        "more": ("search", '{"query":"q","limit":3,"z":1,"b":2}', "b z: unknown"),
        "tool": ("other", GOOD, "tool: unknown"),
        "no tool": (None, GOOD, "tool: unknown"),
        "optional": ("summarise", '{"query":"","words":1}', ""),
        "bool": ("summarise", '{"query":"","words":1,"strict":"yes"}', "strict: not BOOLEAN"),
    }
    calls = [(1, k, c, name, arguments, None) for k, (c, (name, arguments, _)) in enumerate(cases.items())]
    found = linked(spark, calls, [(c, 1, "r") for c in cases])
    assert {c: found[c]["errors"] for c in cases} == {c: e for c, (_, _, e) in cases.items()}
    assert {c for c in cases if found[c]["status"] == "ok"} == {c for c, (_, _, e) in cases.items() if not e}


def test_canonical_json(spark):
    arguments = '{ "query" : "é\\n\\"x\\"", "limit" : 3 , "deep": {"b": [1, {"z":1,"a":2}], "a": null} }'
    found = linked(spark, [(1, 0, "a", "search", arguments, None)], [("a", 1, "r")])
    plain = {**json.loads(arguments)}
    expected = json.dumps(
        {"arguments": plain, "depth": 0, "id": "a", "name": "search", "result": "r"},
        sort_keys=True, ensure_ascii=False, separators=(",", ":"),
    )
    assert found["a"]["json"] == expected


def test_odd_rows(spark):
    calls = [(1, 5, "a", "search", GOOD, None), (1, 3, "a", "search", '{"query":"first","limit":1}', None)]
    calls += [(None, None, None, None, None, None)] * 2 + [(1, 9, "b", "search", '{"query":"","limit":1}', "a")]
    results = [("a", 7, "late"), ("a", 6, "early"), (None, 1, "nobody's"), ("orphan", 1, "x"), ("b", 1, None)]
    found = link(spark, calls, results).collect()
    assert len(found) == 5
    assert sum(r["status"] == "unlinked" for r in found) == 2
    again = [r for r in found if r["status"] == "repeated"]
    assert [(r["call_id"], r["turn"], r["depth"]) for r in again] == [("a", 5, None)]
    a, b = (next(r for r in found if r["call_id"] == c and r["status"] != "repeated") for c in "ab")
    assert '"first"' in a["json"] and '"early"' in a["json"]
    assert (b["depth"], b["status"]) == (1, "ok")
    empty = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert t.link(*empty).count() == 0


def test_conversations_use_the_same_identifiers(spark):
    calls = [(c, 0, "call_0", "search", f'{{"query":"q{c}","limit":1}}', None) for c in (1, 2, None)]
    calls += [(c, 2, "call_1", "search", GOOD, "call_0") for c in (2, 3)] + [calls[0]] * 2
    found = t.link(
        spark.createDataFrame([(*c, 1) for c in calls], CALLS),
        spark.createDataFrame([(c, "call_0", 1, f"r{c}", "tool") for c in (2, None)] + [(9, "call_0", 0, "other", "tool")], RESULTS),
    ).collect()
    assert len(found) == len(calls)
    by_id = {(r["conv_id"], r["call_id"]): r for r in found if r["status"] != "repeated"}
    assert {k: (r["depth"], r["status"]) for k, r in by_id.items()} == {
        (1, "call_0"): (0, "no_result"),
        (2, "call_0"): (0, "ok"),
        (None, "call_0"): (0, "ok"),
        (2, "call_1"): (1, "no_result"),
        (3, "call_1"): (0, "no_result"),
    }
    for c in (2, None):
        whole = json.loads(by_id[c, "call_0"]["json"])
        assert (whole["arguments"]["query"], whole["result"]) == (f"q{c}", f"r{c}")
    assert [r["conv_id"] for r in found if r["status"] == "repeated"] == [1, 1]


def test_derive_stands_odd_rows(spark):
    rows = [(1, 0, "user", None, 1), (1, 1, "assistant", "", 1), (None, None, None, None, 1), (1, 2, "user", "x " * 50_000, 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, call_id int")
    assert t.link(*t.derive(turns)).count() == 2
    plan = t.link(*t.derive(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert t.link(*t.derive(turns.filter(F.lit(False)))).count() == 0
