"""Groups of a sorted copy, made as it is read: no exchange, no sort.

A file of the subject-ordered copy holds whole subjects, but those the zone map calls cut. So a
task sees a subject's rows one after the other, in the order of the copy, and makes arrays of
them column by column, batch by batch. Cut subjects, which hold more than a range, go the long
way (``documents.with_parts``).

That a file was not read in pieces is checked, not trusted: every task counts the rows of its
files, before any filter, against the zone map, and fails if some are missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triples.schema import DOCUMENT, KEY_TAIL

# what tasks run travels with them: executors need not have this package installed
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))

#: What each triple adds to the weight of its row, besides its object's characters.
ROW_CHARS = 64
ENTRY = ["predicate", "object", *KEY_TAIL, "ts"]
NESTED = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in ("id", "uri", "context")],
        T.StructField("part", T.LongType()),
        T.StructField("n_parts", T.LongType()),
        T.StructField("properties", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("text", T.ArrayType(T.StringType())),
    ]
)


def file_name() -> Column:
    """The name of the file that a row of a scan comes from, as ``_file``."""
    return F.col("_metadata.file_name").alias("_file")


def _pieces(rows: pa.Table, key: str, budget: int, skip_null: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole groups, adjacent in ``rows``: where each piece of a group begins, the number of the
    piece, and how many its group has. A group is cut where its weight passes a multiple of
    the budget. With ``skip_null`` a row without an object weighs nothing, as in a sum."""
    keys = rows.column(key)
    new = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy()) + 1
    starts = np.concatenate([[0], new])
    length = pc.utf8_length(rows.column("object"))
    if skip_null:
        length = pc.fill_null(length, -ROW_CHARS)
    weight = length.to_numpy().astype(np.int64) + ROW_CHARS
    before = np.cumsum(weight) - weight
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    part = (before - np.repeat(before[starts], sizes)) // budget
    cuts = np.flatnonzero(np.diff(part) != 0) + 1
    pieces = np.union1d(starts, cuts)
    last = part[np.concatenate([starts[1:], [len(keys)]]) - 1] + 1
    return pieces, part[pieces], last[np.searchsorted(starts, pieces, "right") - 1]


def _listed(at: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([at, [n]]), pa.int32()), values)


def _triples(rows: pa.Table, budget: int, skip_null: bool = False) -> list[pa.Array]:
    """(subject, part, n_parts, triples) of whole groups."""
    at, part, parts = _pieces(rows, "subject", budget, skip_null)
    columns = [rows.column(c).combine_chunks() for c in ENTRY]
    entries = pa.StructArray.from_arrays(columns, ENTRY)
    subjects = rows.column("subject").combine_chunks().take(pa.array(at))
    return [subjects, pa.array(part), pa.array(parts), _listed(at, len(rows), entries)]


def _documents(rows: pa.Table, budget: int) -> list[pa.Array]:
    """The columns of NESTED, of whole groups of document values."""
    at, part, parts = _pieces(rows, "id", budget)
    first = pa.array(at)
    there = rows.column("value").is_valid().to_numpy()
    kept = np.flatnonzero(there)
    before = np.concatenate([[0], np.cumsum(there)])  # values before each row
    values = rows.column("value").combine_chunks().take(pa.array(kept))
    piece = np.searchsorted(at, kept, "right") - 1
    names = rows.column("predicate").combine_chunks().take(pa.array(kept))
    if len(kept):
        other = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
        fields = np.concatenate([[0], np.flatnonzero(other | (np.diff(piece) != 0)) + 1])
    else:
        fields = np.zeros(0, np.int64)
    field_names = rows.column("field").combine_chunks().take(pa.array(kept[fields]))
    maps = np.searchsorted(piece[fields], np.arange(len(at) + 1), "left")
    properties = pa.MapArray.from_arrays(
        pa.array(maps, pa.int32()), field_names, _listed(fields, len(kept), values)
    )
    columns = [rows.column(c).combine_chunks().take(first) for c in ("id", "uri", "context")]
    return [*columns, pa.array(part), pa.array(parts), properties, _listed(before[at], len(kept), values)]


def _grouped(
    rows: DataFrame,
    key: str,
    zones: DataFrame | None,
    schema: T.StructType,
    made: Callable[[pa.Table], list[pa.Array]],
) -> DataFrame:
    """``rows`` with the columns ``_file`` and ``_kept``, in the order of the files; without zones, rows
    of which each task has whole groups, one after the other."""
    expected = None
    if zones is not None:
        # a number per file of the table
        counted = {r["file"]: r["rows"] for r in zones.select("file", "rows").collect()}
        expected = rows.sparkSession.sparkContext.broadcast(counted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        seen: dict[str, int] = {}
        waiting: list[pa.RecordBatch] = []  # the rows of the last group so far
        target = to_arrow_schema(schema)

        def out(groups: list[pa.RecordBatch]) -> pa.RecordBatch:
            columns = made(pa.Table.from_batches(groups))
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

        for batch in batches:
            if expected is not None:
                for x in pc.value_counts(batch.column("_file")).to_pylist():
                    seen[x["values"]] = seen.get(x["values"], 0) + x["counts"]
                batch = batch.filter(batch.column("_kept"))
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            other = np.flatnonzero(pc.not_equal(keys, keys[-1]).to_numpy(zero_copy_only=False))
            last = int(other[-1]) + 1 if len(other) else 0  # where the last group begins
            if waiting and (last or waiting[-1].column(key)[-1].as_py() != keys[0].as_py()):
                done = [*waiting, batch.slice(0, last)] if last else waiting
                yield out(done)
                waiting = []
            elif last:
                yield out([batch.slice(0, last)])
            waiting.append(batch.slice(last))
        if waiting:
            yield out(waiting)
        short = [f for f, n in seen.items() if n != expected.value.get(f)]
        if short:
            raise RuntimeError(f"{short[0]} was not read as a whole: write the copy in smaller ranges")

    return rows.mapInArrow(run, schema)


def _groups_schema(triples: DataFrame) -> T.StructType:
    entry = T.StructType([triples.schema[c] for c in ENTRY])
    return T.StructType(
        [
            T.StructField("subject", T.StringType()),
            T.StructField("part", T.LongType()),
            T.StructField("n_parts", T.LongType()),
            T.StructField("triples", T.ArrayType(entry)),
        ]
    )


def stream_groups(triples: DataFrame, kept: Column, zones: DataFrame, part_chars: int) -> DataFrame:
    """(subject, part, n_parts, triples) as ``documents.group_by_subject`` makes them, of the rows
    that meet ``kept``. ``triples`` is a scan of the subject-ordered copy of one run, without a
    subject that is cut, and ``zones`` its zone map."""
    rows = triples.select("subject", *ENTRY, "_file", kept.alias("_kept"))
    return _grouped(rows, "subject", zones, _groups_schema(triples), lambda t: _triples(t, part_chars))


def sort_groups(triples: DataFrame, part_chars: int) -> DataFrame:
    """The same of distinct triples of which each task has whole subjects, in any order. A subject is
    held by one task, so this is for subjects of a bounded number of rows."""
    rows = triples.select("subject", *ENTRY).sortWithinPartitions("subject", "predicate", "object", *KEY_TAIL)
    return _grouped(rows, "subject", None, _groups_schema(triples), lambda t: _triples(t, part_chars, skip_null=True))


def stream_documents(values: DataFrame, kept: Column, zones: DataFrame, part_chars: int) -> DataFrame:
    """Nested documents as ``documents.nest_documents`` makes them, of the document values of such
    a scan."""
    names = [n for n in DOCUMENT.names if n in ("id", "uri", "context", "field", "value", "predicate", "object")]
    rows = values.select(*names, "_file", kept.alias("_kept"))
    return _grouped(rows, "id", zones, NESTED, lambda t: _documents(t, part_chars))
