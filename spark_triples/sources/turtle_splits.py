"""Turtle files of any length, read by many tasks.

1. Lines are read in splits and packed into chunks. A chunk does not know whether it begins inside a
   long string, so it is scanned from each of the three states a line can begin in; per file, the
   states are then followed from chunk to chunk.
2. A dot before white space ends a statement, whatever is around it, unless it is in a string, an IRI
   or a comment. So a chunk is cut at its first and last such dot. What lies between are whole
   statements; the rest is joined with the rest of its neighbours to the statement it is part of.
3. Prefixes and the base that hold at a piece are those of the directives before it in its file.
   With these, pieces are parsed like files.

Chunks and pieces are written to the shared folder, with explicit places: nothing depends on how a
file is split when it is read again. A line and a statement are held whole; per file, a task
sees a short row for each chunk (4 MB) and the directives. Of the texts, a task holds a few chunks,
whatever its share of them is: they are written in small row groups, go to the workers in small
batches, and stay in place in joins, where the short rows can be broadcast. The triples are
written too, as the size of a batch is a setting of the job that parses.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spark_triples.operators.skew import can_broadcast, size_of
from spark_triples.schema import TRIPLE
from spark_triples.session import small_batches, small_splits, stage
from spark_triples.sources import turtle

CHUNK_CHARS = 4 << 20
# Rows of a row group: of chunks, and of statements that chunks cut, which are short as a rule.
CHUNK_ROWS, REST_ROWS = 4, 64
BATCH = 10_000
# A line begins in a statement, or in a long string of one of two quotes.
STATES = ("", '"', "'")
_SKIP = re.compile(
    r"""\\.|\#[^\n\r]*|<[^>\n]*>|(?P<open>\"{3}|'{3})|"(?:[^"\\\n\r]|\\.)*+"|'(?:[^'\\\n\r]|\\.)*+'"""
    r"""|(?P<border>\.(?=[\s\#]|\Z))|(?P<directive>(?<![\w:.%·-])(?:@prefix\b|@base\b|(?i:prefix|base)(?=\s)))""",
    re.DOTALL,
)
_CLOSE = {q: re.compile(rf"(?:[^{q}\\]|\\.|{q}(?!{q}{q}))*+{q}{q}{q}", re.DOTALL) for q in STATES[1:]}


def scan(text: str, state: str = "") -> Iterator[re.Match | str]:
    """The borders and the keywords of directives in a text that begins in ``state``; at last, the
    state it ends in."""
    at = 0
    while True:
        if state:
            if text.find(state * 3, at) < 0:  # most chunks hold no long string
                break
            if not (closed := _CLOSE[state].match(text, at)):
                break
            at, state = closed.end(), ""
        elif not (found := _SKIP.search(text, at)):
            break
        else:
            at = found.end()
            if found.lastgroup == "open":
                state = found[0][0]
            elif found.lastgroup:
                yield found
    yield state


def borders(text: str, state: str) -> tuple[list[int], str, list[str]]:
    """Where the first and the last statement that end in a text end (none: empty), the state
    after it, and the directives between these two places."""
    ends, after, keywords = [], "", []
    for found in scan(text, state):
        if isinstance(found, str):
            after = found
        elif found.lastgroup == "border":
            ends = [ends[0] if ends else found.end(), found.end()]
        elif ends:
            keywords.append(found)
    return ends, after, _told(text, (found for found in keywords if found.end() <= ends[1]))


def directives(text: str) -> list[str]:
    """The directives of whole statements, each as one statement; an absolute one is not repeated
    while it holds."""
    found = scan(text) if re.search("prefix|base", text, re.IGNORECASE) else ()
    return _told(text, (m for m in found if isinstance(m, re.Match) and m.lastgroup == "directive"))


def _told(text: str, keywords: Iterable[re.Match]) -> list[str]:
    out, holding = [], {}
    written = {}  # how those that hold are written: most that come again look the same
    for found in keywords:
        at = found.start()
        if any(text.startswith(same, at) for same in written.values()):
            continue
        tokens = turtle.tokens(text, at)
        wanted = 3 if found[0].lower().endswith("prefix") else 2
        try:
            kinds, parts = zip(*(next(tokens) for _ in range(wanted)), strict=True)
        except (ValueError, StopIteration):
            continue  # malformed: parsing tells
        if kinds[-1] != "iri":
            continue
        name, iri = f"@{parts[0].lower().lstrip('@')} {' '.join(parts[1:-1])}", f"<{parts[-1]}>"
        if holding.get(name) != parts[-1] or not turtle.is_absolute(parts[-1]):
            out.append(f"{name} {iri} .")
        holding[name] = parts[-1]
        written.pop(name, None)
        start = text.index(iri, at)
        if turtle.is_absolute(parts[-1]) and text.find("#", at, start) < 0:  # no comment on the way
            written[name] = text[at : start + len(iri)]
    return out


def _chunks(size: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines: list[str] = []
        key, n, held = None, 0, 0

        def chunk() -> pd.DataFrame:
            text = "".join(lines)
            found = [borders(text, s) for s in STATES]
            ends, after, told = (list(of) for of in zip(*found, strict=True))
            columns = ["path", "block", "n", "text", "after", "ends", "told"]
            return pd.DataFrame([(*key, n, text, after, ends, told)], columns=columns)

        for batch in batches:
            for path, block, value in zip(batch["path"], batch["block"], batch["value"], strict=True):
                if lines and (key != (path, block) or held >= size):
                    yield chunk()
                    n = n + 1 if key == (path, block) else 0
                    lines, held = [], 0
                elif key != (path, block):
                    n = 0
                key = path, block
                lines.append(value + "\n")
                held += len(value) + 1
        if lines:
            yield chunk()

    return pack


CHUNK = "path string, block long, n long, text string, after array<string>, ends array<array<int>>"
CHUNK += ", told array<array<string>>"
STATE = "path string, block long, n long, state string, statement long"


def _follow(chunks: pd.DataFrame) -> pd.DataFrame:
    """The state each chunk of a file begins in, and the number of chunks before it that hold a
    border: that of the statement it begins in."""
    out, state, statement = [], "", 0
    chunks = chunks.sort_values(["block", "n"])
    for path, block, n, after, ends in chunks[["path", "block", "n", "after", "ends"]].itertuples(index=False):
        out.append((path, block, n, state, statement))
        i = STATES.index(state)
        state, statement = after[i], statement + (len(ends[i]) > 0)
    return pd.DataFrame(out, columns=["path", "block", "n", "state", "statement"])


PIECE = "path string, block long, n long, kind int, statement long, text string, found array<string>"


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "block", "n", "kind", "statement", "text", "found"]
    for batch in batches:
        for row in batch.itertuples(index=False):
            state = STATES.index(row.state)
            ends, told = list(row.ends[state]), list(row.told[state])
            text = row.text.removeprefix("\ufeff") if row.block == row.n == 0 else row.text
            moved = len(row.text) - len(text)
            first, last = (ends[0] - moved, ends[1] - moved) if ends else (len(text), len(text))
            parts = [(0, row.statement, text[:first], [])]
            if ends:
                parts += [(1, -1, text[first:last], told), (2, row.statement + 1, text[last:], [])]
            rows = [(row.path, row.block, row.n, *part) for part in parts if part[2]]
            yield pd.DataFrame(rows, columns=columns)


def _environments(rows: pd.DataFrame) -> pd.DataFrame:
    """Prefixes and base after each piece of a file that has directives."""
    out, prefixes, base = [], {}, ""
    rows = rows.sort_values(["block", "n", "kind"])
    for number, (path, found) in enumerate(zip(rows["path"], rows["found"], strict=True), 1):
        document = turtle.Document("\n".join(found), path, prefixes, base)
        list(document.triples())
        prefixes, base = document.prefixes, document.base
        out.append((path, number, json.dumps([prefixes, base])))
    return pd.DataFrame(out, columns=["path", "number", "environment"])


def _parse(names: list[str]):
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                known = json.loads(r.environment) if r.environment else ({}, "")
                part = f"{r.block}.{r.n}.{r.kind}."
                for triple in turtle.Document(r.text, r.path, *known, part).triples():
                    rows.append(triple)
                    if len(rows) == BATCH:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return parse


def _beside(texts: DataFrame, rows: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``texts`` with what written rows say of them; the texts move only if these rows are too many."""
    return texts.join(F.broadcast(rows) if can_broadcast(size_of(rows)) else rows, on, how)


def pieces_of(lines: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``lines(path, block, value)``, in the order of their files within a block, as pieces of whole
    statements: (path, block, n, kind, text, found), with their directives."""
    spark, place = lines.sparkSession, ["path", "block", "n"]
    with small_batches(spark):
        chunks = lines.select("path", "block", "value").mapInPandas(_chunks(chunk_chars), CHUNK)
        chunks = stage(chunks, "turtle-chunks", group_rows=CHUNK_ROWS)
        states = chunks.select(*place, "after", "ends").groupBy("path").applyInPandas(_follow, STATE)
        states = stage(states, "turtle-states")
    with small_batches(spark), small_splits(spark):
        cut = _beside(chunks.select(*place, "text", "ends", "told"), states, place)
        cut = stage(cut.mapInPandas(_pieces, PIECE), "turtle-cut", group_rows=CHUNK_ROWS)
        # the rests of neighbouring chunks that are one statement
        parts = F.array_sort(F.collect_list(F.struct("block", "n", "kind", "text")))
        joined = cut.filter("kind <> 1").groupBy("path", "statement").agg(parts.alias("parts"))
        first = F.col("parts")[0]
        joined = joined.select(
            "path",
            *[first[c].alias(c) for c in ("block", "n", "kind")],
            F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        )

        @F.pandas_udf("array<string>")
        def found(texts: pd.Series) -> pd.Series:
            return texts.map(directives)

        joined = stage(joined.withColumn("found", found("text")), "turtle-joined", group_rows=REST_ROWS)
    return cut.filter("kind = 1").select(*joined.columns).unionByName(joined)


def parse_pieces(pieces: DataFrame, share: float = 1.0) -> DataFrame:
    """The triples of pieces, or of a share of them, by the prefixes that hold there."""
    spark, place = pieces.sparkSession, ["block", "n", "kind"]
    telling = F.when(F.size("found") > 0, 1).otherwise(0)
    before = Window.partitionBy("path").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    numbers = pieces.select("path", *place, F.coalesce(F.sum(telling).over(before), F.lit(0)).alias("number"))
    known = pieces.filter(F.size("found") > 0).select("path", *place, "found")
    known = known.groupBy("path").applyInPandas(_environments, "path string, number long, environment string")
    names = TRIPLE.names[:6]
    schema = ", ".join(f"{name} string" for name in names)
    with small_batches(spark), small_splits(spark):
        numbers, known = stage(numbers, "turtle-numbers"), stage(known, "turtle-known")
        if share < 1:
            pieces = pieces.sample(share, seed=7)
        pieces = _beside(pieces.drop("found"), numbers, ["path", *place])
        pieces = _beside(pieces, known, ["path", "number"], "left")
        return stage(pieces.mapInPandas(_parse(names), schema), "turtle-triples")


def read_turtle(
    spark: SparkSession, paths: list[str], options: dict[str, str], longer_than: int, share: float = 1.0
) -> DataFrame:
    """Triples of the Turtle files of more than some bytes, or of a share of their pieces."""
    lines = spark.read.options(**options).option("lineSep", "\n").text(paths)
    lines = lines.filter(F.col("_metadata.file_size") > longer_than)
    block = F.col("_metadata.file_block_start").alias("block")
    return parse_pieces(pieces_of(lines.select(F.col("_metadata.file_path").alias("path"), block, "value")), share)
