"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words a fixed mask selects in a window; the words it leaves out may
differ. Seeds of the benchmark are joined with the seeds of every document by hash. Around
each hit the item is laid over the document, and the best stretch of words that agree is
taken, where a difference costs as much as two agreements earn. A stretch of at least
MIN_WORDS agreeing words (or the whole of a shorter item) is a leak, so copies with some words
exchanged are found, and documents that share only common phrases with an item are not.

The masks are such that every stretch that counts as a leak holds the seed of one of them, so
none is missed. Words are compared without case and outer punctuation. Items of fewer than
MIN_WORDS words are matched as a whole, also those of one word; items without words are left out. The benchmark is a stated set, so it is taken in blocks of at most
BLOCK_CHARS characters or one item (broadcast, with that bound); each block meets all documents.

Cases: null and empty texts hold no leak; null items are left out; repeated items are found under
each of their ids, sorted; a text of one repeated word is laid at every place of an item of it; repeated rows give repeated results; an empty benchmark finds
nothing, an empty table gives an empty result. ``_leaks``, ``_row`` and ``_block`` are reserved, other columns are carried.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triples.llm.common import (
    core_hashes,
    mix,
    odd_numbers,
    ship,
    table,
    text_or_empty,
)
from spark_triples.session import stage

#: Selected words are 1. A best stretch has more than COST agreements for each difference before
#: any of its words, so up to its twelfth agreement it is one of 728 patterns. Each holds one of these masks.
MASKS = ("11101101", "11110001001", "11101000101")
SHORTEST, MIN_WORDS = 1, 12
#: What a difference costs, in agreements.
COST = 2
#: An index takes 80 bytes for each word of its items: 320 MB at most, where all words have one letter.
BLOCK_CHARS = 8_000_000
_FILTER_BITS = 22
#: Items of fewer words than the first mask agree as a whole or not at all.
_M = odd_numbers(max(map(len, MASKS)), 9)


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """The seed of every window of a mask's length."""
    n = len(h) - len(mask) + 1
    total = np.full(max(n, 0), np.uint64(int(mask, 2)))
    if n > 0:
        for k, bit in enumerate(mask):
            if bit == "1":
                total += h[k : k + n] * _M[k]
    return mix(total)


class Index:
    """The seeds of some benchmark items, sorted, with a bitmap before them. Items of equal
    words are one, with all their ids. Entries of one seed are sorted by the seed before them in
    their item, so that those which go on a run of hits are left out together."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]) -> None:
        equal: dict[bytes, tuple[list[int | None], np.ndarray]] = {}
        for item, h in items:
            equal.setdefault(h.tobytes(), ([], h))[0].append(item)
        self.items = list(equal.values())
        short = {len(h) for _, h in self.items if 0 < len(h) < len(MASKS[0])}
        self.masks = [*MASKS, *("1" * n for n in sorted(short))]
        none = np.zeros(0, np.uint64)
        keys, before, owners, places = [none], [none], [none.astype(np.int32)], [none.astype(np.int32)]
        for number, (_, h) in enumerate(self.items):
            for mask in MASKS if len(h) >= len(MASKS[0]) else ["1" * len(h)] * (len(h) > 0):
                found = seeds(h, mask)
                keys.append(found)
                # nothing is before the first one: a value that its own seed excludes
                before.append(np.concatenate([~found[:1], found[:-1]]))
                owners.append(np.full(len(found), number, np.int32))
                places.append(np.arange(len(found), dtype=np.int32))
        self.keys, self.before = np.concatenate(keys), np.concatenate(before)
        order = np.lexsort((self.before, self.keys))
        self.keys, self.before = self.keys[order], self.before[order]
        self.owners, self.places = np.concatenate(owners)[order], np.concatenate(places)[order]
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, h: np.ndarray) -> set[tuple[int, int]]:
        """(item, place of its first word in ``h``) for every pair of equal seeds. A pair whose
        words follow those of another pair has the same place, so only the first of such a
        run is looked at: repeated words cost the sum of both lengths, not the product."""
        out: set[tuple[int, int]] = set()
        for mask in self.masks:
            found = seeds(h, mask)
            at = np.flatnonzero(self.seen[found >> np.uint64(64 - _FILTER_BITS)])
            low = np.searchsorted(self.keys, found[at], "left")
            high = np.searchsorted(self.keys, found[at], "right")
            for p, a, b in zip(*(x[high > low].tolist() for x in (at, low, high)), strict=True):
                parts = [(a, b)]
                if p:
                    group, last = self.before[a:b], found[p - 1]
                    goes_on = a + np.searchsorted(group, last, "left"), a + np.searchsorted(group, last, "right")
                    parts = [(a, goes_on[0]), (goes_on[1], b)]
                for x, y in parts:
                    if x < y:
                        out.update(zip(self.owners[x:y].tolist(), (p - self.places[x:y]).tolist(), strict=True))
        return out


def best_stretch(agree: np.ndarray) -> tuple[int, int]:
    """Start and end of the shortest stretch with the most agreements less COST times the
    differences."""
    gain = np.concatenate([[0], np.cumsum(np.where(agree, 1, -COST))])
    low = np.minimum.accumulate(gain)
    end = int(np.argmax(gain - low))
    return end - int(np.argmin(gain[end::-1])), end


def leaks(h: np.ndarray, index: Index) -> list[list[int | None]]:
    """[item, start, end, agreeing words] of every leak in a document, in words, sorted."""
    out = set()
    for number, first in index.hits(h):
        items, words = index.items[number]
        begin, end = max(0, first), min(len(h), first + len(words))
        agree = h[begin:end] == words[begin - first : end - first]
        a, b = best_stretch(agree)
        same = int(agree[a:b].sum())
        if same >= min(MIN_WORDS, len(words)):
            out.update((item, begin + a, begin + b, same) for item in items)
    return [list(x) for x in sorted(out, key=lambda x: (x[1], x[2], x[0] is None, x[0] or 0, x[3]))]


def _blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS):
    """The benchmark's items as (item_id, text), in lists that are bounded in size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = total // (chars // 2) + 1
    for part in range(parts):
        block = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [(r[0], r[1]) for r in block.collect()]


def _finder(sent):
    @F.pandas_udf("array<array<bigint>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([leaks(core_hashes(t), sent.value) for t in texts], dtype=object)

    return found


def _index(block: list[tuple[int | None, str]]) -> Index:
    items = [(i, core_hashes(text)) for i, text in block]
    return Index([(i, h) for i, h in items if len(h) >= SHORTEST])


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``_leaks``: arrays [item, start, end, agreeing words], in words.

    With several blocks, ``docs`` is written once with row numbers; each block reads the texts
    and writes its leaks alone, and its index is released before the next one is made."""
    spark, kind = docs.sparkSession, "array<array<bigint>>"
    ship(spark)
    sent = spark.sparkContext.broadcast
    blocks = _blocks(benchmark, block_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.withColumn("_leaks", _finder(sent(_index(first)))(text_or_empty()))
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    leaky = None
    for number, block in enumerate(chain([first, second], blocks)):
        leaky = _with_block(rows, block, number, leaky)
    # a row has one entry per block at most
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_block", "_leaks"))), lambda x: x["_leaks"])
    leaky = leaky.groupBy("_row").agg(F.flatten(parts).alias("_leaks"))
    out = rows.join(leaky, "_row", "left").select(*docs.columns, "_leaks")
    return out.withColumn("_leaks", F.coalesce("_leaks", F.array().cast(kind)))


def _with_block(rows: DataFrame, block: list, number: int, leaky: DataFrame | None) -> DataFrame:
    """The leaks of one more block, by row number, beside those found before."""
    sent = rows.sparkSession.sparkContext.broadcast(_index(block))
    found = rows.select("_row", F.lit(number).alias("_block"), _finder(sent)(text_or_empty()).alias("_leaks"))
    found = stage(found.filter(F.size("_leaks") > 0), "leaks")
    sent.unpersist()
    return found if leaky is None else leaky.unionByName(found)


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with the columns of ``docs``."""
    return find_leaks(docs, benchmark).filter(F.size("_leaks") == 0).select(*docs.columns)


def op9_spaced_seeds(spark, sf_dir: str) -> DataFrame:
    """For every document, whether it holds passages of benchmark items, which and where."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.size("_leaks") > 0).alias("contaminated"),
        F.size(F.array_distinct(F.transform("_leaks", lambda x: x[0]))).cast("long").alias("n_items"),
        F.coalesce(F.array_max(F.transform("_leaks", lambda x: x[3])), F.lit(0)).alias("agreeing_words"),
        F.array_sort(F.array_distinct(F.transform("_leaks", lambda x: x[0]))).alias("items"),
        F.array_join(F.transform("_leaks", lambda x: F.concat_ws(":", x[0], x[1], x[2])), ",").alias("spans"),
    )
