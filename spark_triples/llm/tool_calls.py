"""Tool calls and their results: linked, ordered, checked, written as canonical JSON.

1. Calls and results of a conversation are joined by identifier; conversations may use the same
   identifiers. Of repeated identifiers the earliest row counts, further calls are ``repeated``.
2. A call may name an earlier one it continues. Its depth is the number of calls before it,
   found by pointer doubling: each round joins every call to the one its pointer names,
   which doubles the distance, so the rounds grow with the logarithm of the longest chain and
   no conversation is gathered in one place. Depth, then turn, is a topological order;
   calls that never reach a first one are a cycle.
3. Arguments are parsed once and held against the schema of their tool: required fields,
   types, bounds, unknown fields.
4. Every call is one JSON text: keys in order at all levels, no spaces, no nulls.

All of it is DataFrame functions. Cases: calls or results without an identifier can be linked with
nothing: such calls have the status ``unlinked``, such results are left out, as are results that
no call asked for. Rows without a conversation are of one conversation, that of null. Equal rows
are repeated calls too: every call gives one row. Arguments that are null or no JSON object are ``invalid``. A call that
continues an unknown one begins a chain. Empty texts are values like others; very long
ones are kept whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triples.llm.common import table
from spark_triples.session import stage


class Field(NamedTuple):
    """A field of a tool's arguments; ``kind`` is STRING, BIGINT, DOUBLE, BOOLEAN, …"""

    tool: str
    name: str
    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None


#: The tools that the query derives from conversations.
TOOLS = (
    Field("search", "limit", "BIGINT", True, 1, 12),
    Field("search", "query", "STRING"),
    Field("summarise", "query", "STRING"),
    Field("summarise", "strict", "BOOLEAN", False),
    Field("summarise", "words", "BIGINT", True, 1),
)


def _key(call_id: str) -> Column:
    """The conversation and an identifier in it; a null conversation is a value like others."""
    return F.struct(F.col("conv_id"), F.col(call_id).alias("call_id"))


def depths(calls: DataFrame) -> DataFrame:
    """(key, depth): calls before each in its chain, null in a cycle. ``calls`` has one row
    per (conv_id, call_id)."""
    ids = calls.select(_key("call_id").alias("known"))
    after = F.when(F.col("after").isNotNull(), _key("after"))
    asked = calls.select(_key("call_id").alias("key"), after.alias("after"))
    now = asked.join(ids, F.col("after") == F.col("known"), "left").select(
        "key",
        F.col("known").alias("jump"),
        F.col("known").isNotNull().cast("long").alias("depth"),
    )
    now = stage(now, "call-depths")
    calls_left, total = now.agg(F.count("jump"), F.count("*")).first()
    for _ in range(total.bit_length() + 1):
        if not calls_left:
            break
        other = now.select(
            F.col("key").alias("at"), F.col("jump").alias("next"), F.col("depth").alias("more")
        )
        # only calls that still point somewhere move
        moving = now.filter(F.col("jump").isNotNull()).join(other, F.col("jump") == F.col("at"))
        moved = moving.select("key", F.col("next").alias("jump"), (F.col("depth") + F.col("more")).alias("depth"))
        now = stage(now.filter(F.col("jump").isNull()).unionByName(moved), "call-depths")
        calls_left = now.agg(F.count("jump")).first()[0]
    return now.select("key", F.when(F.col("jump").isNull(), F.col("depth")).alias("depth"))


def _errors(parsed: Column, tool: Column, tools: tuple[Field, ...]) -> Column:
    """What is wrong with the arguments of a call, as an array of texts."""
    none = F.lit(None).cast("string")
    checks = [
        F.when(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("arguments: no object")),
        F.when(tool.isNull() | ~tool.isin(sorted({f.tool for f in tools})), F.lit("tool: unknown")),
    ]
    for f in tools:
        mine = tool == f.tool
        value = F.try_variant_get(parsed, f"$.{f.name}", "variant")
        kind = F.schema_of_variant(value)
        there = value.isNotNull() & (kind != "VOID")
        number = F.try_variant_get(parsed, f"$.{f.name}", "double")
        bad = (kind != f.kind) if f.kind != "DOUBLE" else ~(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"))
        if f.required:
            checks.append(F.when(mine & ~F.coalesce(there, F.lit(False)), F.lit(f"{f.name}: missing")))
        checks.append(F.when(mine & there & bad, F.lit(f"{f.name}: not {f.kind}")))
        if f.least is not None:
            checks.append(F.when(mine & (number < f.least), F.lit(f"{f.name}: below {f.least}")))
        if f.most is not None:
            checks.append(F.when(mine & (number > f.most), F.lit(f"{f.name}: above {f.most}")))
    for name in sorted({f.tool for f in tools}):
        known = [f.name for f in tools if f.tool == name]
        keys = F.json_object_keys(F.to_json(parsed))
        extra = F.array_except(keys, F.array(*map(F.lit, known)))
        checks.append(F.when((tool == name) & (F.size(extra) > 0), F.concat(F.array_join(F.array_sort(extra), " "), F.lit(": unknown"))))
    return F.array_compact(F.array(*[F.coalesce(c, none) for c in checks]))


def link(calls: DataFrame, results: DataFrame, tools: tuple[Field, ...] = TOOLS) -> DataFrame:
    """(conv_id, turn, call_id, name, depth, status, errors, json) of every call.

    ``calls`` has conv_id, turn, call_id, name, arguments (JSON text) and after (the call_id it
    continues); ``results`` has conv_id, call_id, turn and content.
    """
    columns = ("conv_id", "turn", "call_id", "name", "arguments", "after")
    told = stage(calls.select(*columns, F.monotonically_increasing_id().alias("row")), "calls")
    # the least row of an identifier is found before the shuffle of its conversation's rows
    least = F.min(F.struct("turn", "name", "arguments", "after", "row"))["row"]
    first = told.filter(F.col("call_id").isNotNull()).groupBy("conv_id", "call_id").agg(least.alias("row"))
    first = first.select("row", F.lit(True).alias("first"))
    told = stage(told.join(first, "row", "left"), "calls")
    named = told.filter("first")
    answers = (
        results.filter(F.col("call_id").isNotNull())
        .groupBy(_key("call_id").alias("key"))
        .agg(F.min(F.struct("turn", "content"))["content"].alias("content"))
        .withColumn("answered", F.lit(True))
    )
    linked = named.withColumn("key", _key("call_id")).join(depths(named), "key", "left").join(answers, "key", "left")
    others = told.filter(F.col("first").isNull())
    rows = linked.drop("key").unionByName(others, allowMissingColumns=True)
    parsed = F.try_parse_json(F.col("arguments"))
    rows = rows.withColumn("parsed", parsed)
    rows = rows.withColumn("errors", _errors(F.col("parsed"), F.col("name"), tools))
    status = (
        F.when(F.col("call_id").isNull(), "unlinked")
        .when(F.col("first").isNull(), "repeated")
        .when(F.col("depth").isNull(), "cycle")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("answered").isNull(), "no_result")
        .otherwise("ok")
    )
    canonical = F.to_json(
        F.struct(
            F.col("parsed").alias("arguments"),
            "depth",
            F.col("call_id").alias("id"),
            "name",
            F.col("content").alias("result"),
        )
    )
    return rows.select(
        "conv_id",
        "turn",
        "call_id",
        "name",
        "depth",
        status.alias("status"),
        F.array_join("errors", "; ").alias("errors"),
        canonical.alias("json"),
    )


def derive(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as conversations imply them: what a user says is a call, named by its
    length, that continues the user's turn two before; an assistant's next turn is its result."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    name = F.when(words <= 20, "search").otherwise("summarise")
    arguments = F.when(
        words <= 20, F.to_json(F.struct(words.alias("limit"), F.col("text").alias("query")))
    ).otherwise(
        F.to_json(F.struct(words.alias("words"), (words % 2 == 0).alias("strict"), F.col("text").alias("query")))
    )

    def identifier(shift: int) -> Column:
        return F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") + shift).cast("string"))

    calls = turns.filter(F.col("role") == "user").select(
        "conv_id",
        "turn",
        identifier(0).alias("call_id"),
        name.alias("name"),
        arguments.alias("arguments"),
        identifier(-2).alias("after"),
    )
    results = turns.filter(F.col("role") == "assistant").select(
        "conv_id", identifier(-1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results


def op6_tool_calls(spark, sf_dir: str) -> DataFrame:
    """The calls of all conversations with their results."""
    return link(*derive(table(spark, sf_dir, "conversations")))


OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n
  FROM conversations
),
users AS (
  SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
  FROM turns WHERE role = 'user'
),
calls AS (
  SELECT conv_id, turn, text, n, conv_id || ':' || turn AS call_id,
         CASE WHEN n <= 20 THEN 'search' ELSE 'summarise' END AS name,
         row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS depth
  FROM users
),
linked AS (
  SELECT c.*, a.text AS content,
         CASE WHEN c.n <= 20 THEN json_object('limit', c.n, 'query', c.text)
              ELSE json_object('query', c.text, 'strict', c.n % 2 = 0, 'words', c.n) END AS arguments,
         CASE WHEN c.n > 20 THEN '' WHEN c.n < 1 THEN 'limit: below 1'
              WHEN c.n > 12 THEN 'limit: above 12' ELSE '' END AS errors
  FROM calls c LEFT JOIN turns a ON a.conv_id = c.conv_id AND a.turn = c.turn + 1 AND a.role = 'assistant'
)
SELECT conv_id, turn, call_id, name, depth,
       CASE WHEN errors <> '' THEN 'invalid' WHEN content IS NULL THEN 'no_result' ELSE 'ok' END AS status,
       errors,
       CAST(CASE WHEN content IS NULL
            THEN json_object('arguments', arguments, 'depth', depth, 'id', call_id, 'name', name)
            ELSE json_object('arguments', arguments, 'depth', depth, 'id', call_id, 'name', name, 'result', content)
       END AS VARCHAR) AS json
FROM linked
"""
