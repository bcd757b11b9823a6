"""Importance resampling towards a target: documents whose n-grams look like the target's.

1. Every run of 1 to 3 consecutive words falls in one of BUCKETS buckets by the CRC of its
   bytes. Tasks count buckets in arrays, of which only sums leave them.
2. A bucket's gain is the logarithm of its share in the target against that in the corpus, in
   thousandths. An array of BUCKETS gains goes to the tasks; a document's weight is the sum of
   the gains of its runs. With a Gumbel number drawn from its id added that is its score.
3. Scores are written once. The score of the last document drawn is found by bisection: each
   job counts, exactly, how many documents reach each of 15 thresholds (four halvings), until one
   is left. Among those that tie there, the same search over doc_id finds the last id, and
   over row numbers the last row of an id that repeats. So what is drawn is a filter.
4. The rows drawn are range-partitioned by score and id; a row's rank is its place in its range
   and the rows of the ranges before. The others keep no rank and do not move.

CRCs of runs are joined from those of words: CRCs are linear, so that of a text that others
follow is moved by their length with four table lookups.

Cases: null texts and texts without words have no features, weight 0, and are never drawn
(``least`` words are needed). The id of a row with a null doc_id is ``null`` where it is
hashed; it ties as the largest id. Rows with equal score and doc_id are drawn in the order of a
frozen row number, so any number of rows may be equal. Very long texts are worked on whole. An
empty corpus gives no rows, an empty target gains that depend on the corpus alone. Other
columns of the inputs are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triples.llm.common import (
    REMEMBERED,
    map_batches,
    memory,
    ship,
    slices,
    table,
    terms_of,
    text_or_empty,
)
from spark_triples.session import stage
from spark_triples.sinks.tables import ranges_for

BUCKETS, RUN, SEED = 10_000, 3, 42
LEAST_WORDS, PERCENT = 20, 5
#: Thresholds that one job counts.
HALVINGS = 4
_POLYNOMIAL = 0xEDB88320
_NO_ID = (1 << 63) - 1
#: Bytes of a row that is drawn.
_ROW_BYTES = 64


@lru_cache(1)
def _zero_bytes() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables that move a CRC by 0 to 255 bytes, and by 256, 512, … bytes. A table has a row for
    each of the four bytes of a CRC."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & np.uint32(1), (one >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), one >> np.uint32(1))
    small = np.empty((256, 4, 256), np.uint32)
    for k in range(4):
        small[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(255):
        small[n + 1] = (small[n] >> np.uint32(8)) ^ one[small[n] & np.uint32(255)]
    last = small[255]
    large = [(last >> np.uint32(8)) ^ one[last & np.uint32(255)]]
    for _ in range(32):
        large.append(_looked_up(large[-1], large[-1]))
    return small, large


def _looked_up(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ tables[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def moved(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What the CRCs of some bytes add to the CRC of the bytes and ``length`` more."""
    small, large = _zero_bytes()
    flat, at = small.reshape(-1), (length & 255) << 10
    out = flat[at + (crc & np.uint32(255))]
    for k in range(1, 4):
        out ^= flat[at + 256 * k + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
    for k in range(int(length.max(initial=0)).bit_length() - 8):
        longer = np.flatnonzero(length >> (8 + k) & 1)
        out[longer] = _looked_up(large[k], out[longer])
    return out


def _word_codes(words: list[bytes]) -> np.ndarray:
    """CRC (high half) and bytes (low half) of each word, remembered per worker."""
    known = memory("word CRCs")
    new = set(words).difference(known)
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = set(words)
    for w in new:
        known[w] = zlib.crc32(w) << 32 | len(w)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def buckets_of(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text (in UTF-8); the bucket of every run of all texts, and its text's number."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = terms_of(text)
        counts[k] = len(found)
        words += found
    codes = _word_codes(words)
    crc, length = (codes >> np.uint64(32)).astype(np.uint32), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    # the CRC of a word and a space, which other words of a run follow
    spaced = moved(crc, np.ones(len(crc), np.int64)) ^ np.uint32(zlib.crc32(b" "))
    runs, owners = [crc], [owner]
    run, run_length = crc, length  # runs that begin at each word, one word longer each time
    for n in range(1, RUN):
        ahead = run_length[1:]
        run = moved(spaced[: len(ahead)], ahead) ^ run[1:]
        run_length = length[: len(ahead)] + 1 + ahead
        whole = owner[n:] == owner[: len(owner) - n]
        runs.append(run[whole])
        owners.append(owner[n:][whole])
    return counts, (np.concatenate(runs) % np.uint32(buckets)).astype(np.int64), np.concatenate(owners)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Runs of all texts in each bucket. A task sends at most ``buckets`` sums, the driver gets
    as many."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(buckets_of(part.column(0).to_pylist(), buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = docs.select(text_or_empty().cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of its (smoothed) share in the target against
    that in the corpus, rounded down."""
    n, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_s + n) / ((s + 1.0) * (all_t + n))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """The number a document draws, in thousandths."""
    name = f"{seed}:{'null' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, key, row) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def work(rows: dict) -> dict:
        gain = sent.value
        n, bucket, owner = buckets_of(rows["text"], len(gain))
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(n)))
        sums = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
        weight = sums[ends] - sums[np.concatenate([[0], ends[:-1]])] if len(n) else np.zeros(0, np.int64)
        drawn = np.array([gumbel(i, seed) for i in rows["doc_id"]], np.int64)
        return {
            "doc_id": rows["doc_id"],
            "n_words": n,
            "n_features": sum(np.maximum(n - k, 0) for k in range(RUN)),
            "weight": weight,
            "score": weight + drawn,
            "key": [_NO_ID if i is None else i for i in rows["doc_id"]],
            "row": rows["row"],
        }

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().cast("binary").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    schema = "doc_id long, n_words long, n_features long, weight long, score long, key long, row long"
    return map_batches(source, work, schema)


def nth_smallest(rows: DataFrame, value: Column, n: int) -> tuple[int, int]:
    """The ``n``-th smallest of some whole numbers (n from 1 to their count), and how many are
    smaller. Each job counts the numbers up to 15 thresholds; no rows move."""
    values = rows.select(value.alias("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    below = 0
    while low < high:
        step = max(1, (high - low) >> HALVINGS)
        marks = list(range(low + step - 1, high, step))[: 1 << HALVINGS]
        # numbers up to a mark; the answer is the first mark that n of them reach, or beyond
        counts = values.agg(*[F.count_if(F.col("v") <= F.lit(m)) for m in marks]).first()
        reached = next((k for k, c in enumerate(counts) if c >= n), len(marks))
        if reached:
            below, low = counts[reached - 1], marks[reached - 1] + 1
        if reached < len(marks):
            high = marks[reached]
    return low, below


def is_drawn(scores: DataFrame, n: int) -> Column:
    """The condition that the ``n`` rows of ``scores`` with the highest scores meet, of equal
    scores those with the smallest ids; n is at most their number."""
    score, key, row = F.col("score"), F.col("key"), F.col("row")
    if n < 1:
        return F.lit(False)
    lowest, above = nth_smallest(scores, -score, n)
    found, tied = score > -lowest, score == -lowest
    last, before = nth_smallest(scores.filter(tied), key, n - above)
    found = found | (tied & (key < last))
    tied = tied & (key == last)
    end, _ = nth_smallest(scores.filter(tied), row, n - above - before)
    return found | (tied & (row <= end))


def ranked(drawn: DataFrame, n: int) -> DataFrame:
    """``drawn`` with the place of each row by descending score and ascending id as ``rank``."""
    spark = drawn.sparkSession
    order = [F.col("score").desc(), F.col("key").asc(), F.col("row").asc()]
    names = [*drawn.columns, "part", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            place = np.arange(before + 1, before + batch.num_rows + 1)
            before += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=names)

    ranges = ranges_for(spark, n * _ROW_BYTES)
    ranged = drawn.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    placed = ranged.withColumn("part", F.spark_partition_id().cast("long"))
    schema = ", ".join(f"{c} long" for c in names)
    placed = stage(placed.mapInArrow(run, schema), "drawn")
    # one row per range, so this window is small whatever the input
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    ranks = placed.join(F.broadcast(sizes), "part")
    return ranks.select(*drawn.columns, (F.col("before") + F.col("place")).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): ``percent`` of the documents with ``least``
    words or more are drawn; the rank of the others is null."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scores = stage(scored(docs, gain, seed), "scores")
    enough = F.col("n_words") >= least
    n = percent * scores.filter(enough).count() // 100
    drawn = enough & is_drawn(scores.filter(enough), n)
    rest = scores.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))
    found = ranked(scores.filter(drawn), n).unionByName(rest)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Every document's weight and score towards the benchmark, and the ranks of those drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _nibbles() -> list[int]:
    """What four bits of a CRC add to it when they leave it."""
    out = list(range(16))
    for _ in range(4):
        out = [(c >> 1) ^ (_POLYNOMIAL * (c & 1)) for c in out]
    return out


OP11_SQL = f"""
with x as (select 0 as kind, doc_id, coalesce(text, '') as text from documents union all
  select 1, item_id, coalesce(text, '') from benchmark),
w as (select kind, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from x),
f as (select kind, doc_id, len(w) as n, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
  || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as f from w),
h as (select f, hex(encode(f)) as h from (select distinct f from f)),
b as (select f, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h)), lambda i:
  (strpos('0123456789ABCDEF', substr(h, xor(i, 1::bigint) + 1, 1)) - 1)::bigint)), lambda c, x:
  xor(c >> 4, list_extract({_nibbles()}::bigint[], (xor(c, x) & 15) + 1))), 4294967295::bigint) % {BUCKETS} as bucket from h),
fb as (select f.kind, f.doc_id, b.bucket from f join b using (f)),
counts as (select bucket, sum((kind = 0)::bigint) as s, sum((kind = 1)::bigint) as t from fb group by bucket),
totals as (select coalesce(sum(s), 0)::double as s, coalesce(sum(t), 0)::double as t from counts),
gains as (select bucket, floor(1000 * ln((counts.t + 1.0::double) * (totals.s + {BUCKETS})
  / ((counts.s + 1.0::double) * (totals.t + {BUCKETS}))))::bigint as gain from counts, totals),
weights as (select doc_id, count(*) as n_features, sum(gain)::bigint as weight
  from fb join gains using (bucket) where kind = 0 group by doc_id),
scores as (select doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features,
  coalesce(weight, 0)::bigint as weight,
  coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id::varchar), 1, 8))::bigint
  + 0.5::double) / 4294967296)))::bigint as score
  from w left join weights using (doc_id) where kind = 0),
ranked as (select *, case when n_words >= {LEAST_WORDS} then row_number() over
  (partition by n_words >= {LEAST_WORDS} order by score desc, doc_id) end as place from scores)
select doc_id, n_features, weight, score, case when place <= {PERCENT} *
  (select count(*) from scores where n_words >= {LEAST_WORDS}) // 100 then place end as rank from ranked
"""
