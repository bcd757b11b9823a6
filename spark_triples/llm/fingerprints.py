"""Document fingerprints by winnowing.

1. A rolling hash of every run of GRAM code points (a polynomial modulo the prime 2^31 - 1).
2. Of every WINDOW neighbouring hashes the least is chosen, the rightmost of equal ones. A choice
   counts once, however many windows make it.
3. A fingerprint is the text's choices in order, ten hexadecimal digits each: eight of the
   hash, two of the distance from the choice before (the first counts from 1).

Two texts that share a passage of GRAM + WINDOW - 1 (50) code points share a choice within it, and
``parse`` gives its place in either; nothing shorter than GRAM is seen. ``likeness`` is the
number of distinct hashes two fingerprints share, divided by that of either (Jaccard).

For the likeness of neighbours the documents are sorted by descending doc_id. Sort keys alone
are ranged first, to find where each range begins. Every document then goes to its range, the
first one of a range to the range before as well, as its last one's neighbour: texts
move once, and one task holds two of them at a time.

Cases: null and empty texts have the empty fingerprint; two of these are alike (1), an empty
one and another are not (0). A text shorter than GRAM is one gram. Very long texts are hashed
in parts of bounded size. Null doc_ids come last. Rows of one doc_id are ordered by a hash of
their texts, equal rows as they are read, so a third of all rows may share an id. A single
document is its own neighbour. An empty table gives no rows. Other columns are ignored. ``docs``
is scanned twice and must give the same rows in the same partitions, as files do; if it does
not, the job fails.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triples.llm.common import map_batches, ship, slices, table, text_or_empty
from spark_triples.session import stage
from spark_triples.sinks.tables import ranges_for

GRAM, WINDOW = 20, 31
PRIME, BASE = (1 << 31) - 1, 1_103_515_245
#: Windows worked on at once.
PART = 1 << 20
_LAST = np.uint64((1 << 32) - 1)


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo PRIME, for x up to PRIME * (PRIME - 1)."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.minimum(x, x - np.uint64(PRIME))  # wraps where x is below


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The hash of every run of ``gram`` codes: runs are made of two runs of half the length."""
    h, length = codes.astype(np.uint64) + np.uint64(1), 1
    done, done_length = None, 0
    while True:
        if gram & length:
            done = h if done is None else _joined(done, h, done_length, length)
            done_length += length
        if done_length == gram:
            return done
        h, length = _joined(h, h, length, length), 2 * length


def _joined(a: np.ndarray, b: np.ndarray, a_length: int, b_length: int) -> np.ndarray:
    factor = np.uint64(pow(BASE, b_length, PRIME))
    n = len(b) - a_length
    return _mod(a[: max(n, 0)] * factor + b[a_length:])


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the chosen grams of a text."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    gram = min(gram, len(codes))
    if not gram:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    grams = len(codes) - gram + 1
    window = min(window, grams)
    hashes, places = [], []
    for start in range(0, grams - window + 1, PART):
        stop = min(start + PART, grams - window + 1) + window - 1
        h = gram_hashes(codes[start : stop + gram - 1], gram)
        least = (h << np.uint64(32)) | (_LAST - np.arange(len(h), dtype=np.uint64))
        span = 1  # the least of so many hashes from each on; two such spans overlap in a longer one
        while span < window:
            step = min(span, window - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        least = least[np.flatnonzero(np.diff(least, prepend=least[:1] + np.uint64(1)))]
        hashes.append((least >> np.uint64(32)).astype(np.uint32))
        places.append(start + (_LAST - (least & _LAST)).astype(np.int64))
    at = np.concatenate(places)
    first = np.flatnonzero(np.diff(at, prepend=-1))  # a part may choose again what ended the last
    return np.concatenate(hashes)[first], at[first]


_MARK = np.dtype([("hash", ">u4"), ("gap", "u1")])


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    marks = np.empty(len(hashes), _MARK)
    marks["hash"], marks["gap"] = hashes, np.diff(places, prepend=-1)
    return marks.tobytes().hex()


def parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places that a fingerprint was written from."""
    marks = np.frombuffer(bytes.fromhex(fingerprint), _MARK)
    return marks["hash"].astype(np.uint32), np.cumsum(marks["gap"].astype(np.int64)) - 1


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets of hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row. Nothing is shuffled."""

    def work(rows: dict) -> dict:
        texts = rows["text"]
        return {
            "doc_id": rows["doc_id"],
            "n_chars": list(map(len, texts)),
            "fingerprint": [written(*winnow(t)) for t in texts],
        }

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(source, work, "doc_id long, n_chars long, fingerprint string")


#: The sort order: null doc_ids last, descending doc_id, a hash of the text, the row as read.
_ORDER = ["_none", "_down", "_tie", "_row"]
_ORDER_TYPE = np.dtype([("_none", "i1"), ("_down", "i8"), ("_tie", "i8"), ("_row", "i8")])


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), text_or_empty()
    return docs.select(
        doc_id.alias("doc_id"),
        text.alias("text"),
        doc_id.isNull().cast("byte").alias("_none"),
        F.coalesce(F.bitwise_not(doc_id), F.lit(0).cast("long")).alias("_down"),
        F.xxhash64(text).alias("_tie"),
        F.monotonically_increasing_id().alias("_row"),
    )


def range_starts(keyed: DataFrame) -> np.ndarray:
    """The key that each range begins with: a few numbers per 256 MB of text."""
    spark = keyed.sparkSession
    keys = stage(keyed.select(*_ORDER, F.octet_length("text").alias("size")), "order-keys")
    size = keys.agg(F.sum("size")).first()[0] or 0
    ranges = ranges_for(spark, size) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = (
        keys.repartitionByRange(ranges, *_ORDER)
        .groupBy(F.spark_partition_id())
        .agg(F.min(F.struct(*_ORDER)).alias("start"))
    )
    return np.sort(np.array([tuple(r["start"]) for r in starts.collect()], _ORDER_TYPE), order=_ORDER)


def in_order(docs: DataFrame) -> DataFrame:
    """The documents in ranges of descending doc_id, sorted; the last row of a range
    (``_guest``) is the first one of the next, or, in the last range, of all."""
    spark = docs.sparkSession
    ship(spark)
    keyed = _keyed(docs)
    starts = range_starts(keyed)
    sent = spark.sparkContext.broadcast(starts)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ranges(none: pd.Series, down: pd.Series, tie: pd.Series, row: pd.Series) -> pd.Series:
        starts = sent.value
        keys = np.empty(len(none), _ORDER_TYPE)
        for name, column in zip(_ORDER, (none, down, tie, row), strict=True):
            keys[name] = column
        own = np.searchsorted(starts, keys, "right") - 1
        first = starts[own] == keys
        return pd.Series(
            [[k, (k - 1) % len(starts)] if is_first else [k] for k, is_first in zip(own, first, strict=True)]
        )

    placed = keyed.select("*", F.posexplode(ranges(*_ORDER)).alias("_guest", "_range"))
    n = max(len(starts), 1)
    return placed.repartitionById(n, "_range").sortWithinPartitions("_range", "_guest", *_ORDER)


def next_likeness(docs: DataFrame) -> DataFrame:
    """Per row its fingerprint, that of its edited text (its last half replaced by the
    beginning of the next document), and the likeness to that and to the next document."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    target = docs.sparkSession.createDataFrame([], schema).schema

    def compared(rows: Iterator[tuple]) -> Iterator[tuple]:
        before = None
        for doc_id, text, guest, part in rows:
            marks = winnow(text)
            now = (doc_id, text, guest, part, marks, np.unique(marks[0]))
            if before is not None and before[3] == part:
                yield _edited(before, now)
            elif before is not None and not before[2]:
                raise RuntimeError("a second scan gave other rows: write the documents first")
            before = now
        if before is not None and not before[2]:
            raise RuntimeError("a second scan gave other rows: write the documents first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for part in slices(batch):
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        out, size = [], 0
        for row in compared(rows()):
            out.append(row)
            size += len(row[3]) + len(row[4])
            if size > 4_000_000 or len(out) >= 5_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow
                )
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow
            )

    ordered = in_order(docs).select("doc_id", "text", "_guest", "_range")
    return ordered.mapInArrow(run, target)


def _edited(this: tuple, following: tuple) -> tuple:
    """The result of a document, given the next one."""
    doc_id, text, _, _, marks, own = this
    half = len(text) // 2
    edited = text[: len(text) - half] + following[1][:half]
    other = winnow(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        written(*marks),
        written(*other),
        likeness(own, np.unique(other[0])),
        likeness(own, following[5]),
    )


def op13_winnowing(spark, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and its likeness to its edited text and its neighbour."""
    return next_likeness(table(spark, sf_dir, "documents"))


def _doubled(source: str, target: str, length: int) -> str:
    """Hashes of runs of twice the length."""
    factor = pow(BASE, length, PRIME)
    return (
        f"{target} as (select *, (h{length} * {factor} + lead(h{length}, {length}) over w) % {PRIME} "
        f"as h{2 * length} from {source} window w as (partition by kind, r order by pos))"
    )


OP13_SQL = f"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id desc nulls last, text) as r
  from documents),
n as (select a.doc_id, a.r, a.text, b.text as following, length(a.text) as n, length(a.text) // 2 as half
  from d a join d b on b.r = a.r % (select count(*) from d) + 1),
t as (select 0 as kind, r, text from n union all
  select 1, r, substr(text, 1, n - half) || substr(following, 1, half) from n),
c as (select kind, r, greatest(length(text) - {GRAM - 1}, 0) as grams,
  unnest(list_transform(regexp_extract_all(text, '(?s).'), lambda x: unicode(x)::bigint + 1)) as h1,
  unnest(range(1, length(text) + 1)) as pos from t),
{_doubled("c", "c2", 1)}, {_doubled("c2", "c4", 2)}, {_doubled("c4", "c8", 4)}, {_doubled("c8", "c16", 8)},
g as (select kind, r, grams, pos, (h16 * {pow(BASE, 4, PRIME)} + lead(h4, 16) over
  (partition by kind, r order by pos)) % {PRIME} as h from c16),
least as (select kind, r, grams, pos, min(h * 4294967296 + 4294967295 - pos) over (partition by kind, r order by pos
  rows between current row and {WINDOW - 1} following) as m from g where pos <= grams),
chosen as (select distinct kind, r, m // 4294967296 as h, 4294967295 - m % 4294967296 as pos
  from least where pos <= greatest(grams - {WINDOW - 1}, 1)),
powers as (select list_transform(range(0, {GRAM}), lambda i: list_reduce(list_prepend(1::bigint,
  list_transform(range(0, i), lambda x: {BASE}::bigint)), lambda a, b: a * b % {PRIME})) as p),
short as (select kind, r, sum(h1 * p[n - pos + 1]) % {PRIME} as h, 1 as pos from
  (select *, count(*) over (partition by kind, r) as n from c where grams = 0), powers group by kind, r),
marks as (select kind, r, h::bigint as h, pos::bigint as pos from chosen union all
  select kind, r, h::bigint, pos::bigint from short),
gaps as (select *, pos - coalesce(lag(pos) over (partition by kind, r order by pos), 0) as gap from marks),
f as (select kind, r, string_agg(printf('%08x%02x', h, gap), '' order by pos) as f,
  count(distinct h) as n from gaps group by kind, r),
s as (select distinct kind, r, h from marks),
shared as (select a.r, 1 as other, count(*) as k from s a join s b on b.kind = 1 and b.r = a.r and b.h = a.h
  where a.kind = 0 group by a.r union all
  select a.r, 0, count(*) from s a join s b on b.kind = 0 and b.h = a.h
  and b.r = a.r % (select count(*) from d) + 1 where a.kind = 0 group by a.r),
k as (select n.r, o.other, coalesce(shared.k, 0) as shared_n, coalesce(f0.n, 0) as n0, coalesce(f1.n, 0) as n1
  from n cross join (values (0), (1)) o(other) left join shared on shared.r = n.r and shared.other = o.other
  left join f f0 on f0.kind = 0 and f0.r = n.r
  left join f f1 on f1.kind = o.other
    and f1.r = case o.other when 1 then n.r else n.r % (select count(*) from d) + 1 end),
near as (select r, other, case when n0 + n1 = 0 then 1.0::double else shared_n::double / (n0 + n1 - shared_n) end as near from k)
select n.doc_id, n.n::bigint as n_chars, sha256(e.text) as edited_sha256, coalesce(f0.f, '') as fingerprint,
  coalesce(f1.f, '') as edited_fingerprint, a.near as near_edited, b.near as near_next
from n join t e on e.kind = 1 and e.r = n.r
join near a on a.r = n.r and a.other = 1 join near b on b.r = n.r and b.other = 0
left join f f0 on f0.kind = 0 and f0.r = n.r left join f f1 on f1.kind = 1 and f1.r = n.r
"""
