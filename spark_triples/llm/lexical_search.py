"""Ranked lexical search: the best documents for each item, by exact search in ball trees.

A document is a sparse vector of impacts, one per term, that grow with the term's occurrences and
fall with the document's length; an item is one of term weights (rare terms weigh more), times
the term's occurrences in it. The score is their inner product, all in whole numbers.

1. Items come in blocks. One pass over the documents counts terms and keeps, per document, its
   length and the occurrences of the block's terms; no other term can add to a score. The
   number of documents with each of these terms is summed from that.
2. Each task builds ball trees over a bounded number of its documents: a node has a centroid and,
   per group of terms, the radius of its documents around it. A group has the terms that only
   one item has; a term of several items is a group of its own.
3. No document below a node scores more with an item than the product with the centroid, plus,
   group by group, the item's length times the radius (Cauchy-Schwarz). Each item
   visits nodes by descending bound and leaves the rest when a bound is below its worst kept
   score. Equal bounds are still visited, since a tie goes to the smaller doc_id.
4. Bounds are floating point numbers, rounded up by more than all their errors; leaves are
   scored in 64-bit whole numbers. Tasks send their best rows only, and these are cut
   to the best by item in two steps, so no task gets rows in proportion to the input.

Cases: null and empty texts have no terms and score with nothing; an item without terms, or
whose terms no document has, has no rows. Rows of one item_id are items of their own. Equal
scores are ranked by ascending doc_id, null last; equal rows are ranked one after the other.
Very long texts are counted whole. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_triples.llm.common import map_batches, memory, ship, slices, table, terms_of, text_or_empty
from spark_triples.session import stage

BEST = 20
#: Characters of the items of a block (a longer one is a block alone), and numbers of a tree.
BLOCK_CHARS, TREE_NUMBERS = 60_000, 16_000_000
LEAF = 32
#: What a radius, and then a bound, is raised by: sums of up to 10,000 numbers of 24 bits, and
#: sums of numbers of 53 bits, are nearer to the true value than this.
RADIUS_UP, BOUND_UP = 1 + 2e-3, 1 + 1e-6
SALTS = 64
_NO_ID = (1 << 63) - 1


class Items(NamedTuple):
    """A block of items: the place of each term, sorted by group; where groups begin; the places
    and occurrences of each item's terms."""

    terms: dict[bytes, int]
    groups: np.ndarray
    places: list[np.ndarray]
    times: list[np.ndarray]


def block_of(texts: list[bytes]) -> Items:
    counts = [Counter(terms_of(t)) for t in texts]
    holders = Counter(t for c in counts for t in c)
    terms, groups = {}, []
    for c in counts:
        own = [t for t in c if holders[t] == 1]
        groups += [len(terms)] if own else []
        for t in own:
            terms[t] = len(terms)
    for t, n in holders.items():
        if n > 1:
            groups.append(len(terms))
            terms[t] = len(terms)
    places = [np.array([terms[t] for t in c], np.int64) for c in counts]
    times = [np.array(list(c.values()), np.int64) for c in counts]
    return Items(terms, np.array(groups, np.int64), places, times)


def blocks(items: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, bytes]]]:
    """(item_id, text) of the items, a bounded number of characters at a time."""
    source = items.select(
        F.col("item_id").cast("long").alias("item_id"), text_or_empty().cast("binary").alias("text")
    )
    block, size = [], 0
    for row in source.toLocalIterator():
        text = bytes(row["text"])
        if block and size + len(text) > chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def term_counts(docs: DataFrame, block: Items) -> DataFrame:
    """(doc_id, n, places, times): terms of each document, and those of the block among them."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(block.terms)

    def work(rows: dict) -> dict:
        known = sent.value.get
        out: dict[str, list] = {"doc_id": rows["doc_id"], "n": [], "places": [], "times": []}
        for text in rows["text"]:
            terms = terms_of(text)
            found = np.array([p for p in map(known, terms) if p is not None], np.int32)
            places, times = np.unique(found, return_counts=True)
            out["n"].append(len(terms))
            out["places"].append(places.astype("<i4").tobytes())
            out["times"].append(times.astype("<i4").tobytes())
        return out

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text")
    )
    return map_batches(source, work, "doc_id long, n long, places binary, times binary")


def holders(counted: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term of the block. A task sends a sum per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total[np.frombuffer(raw, "<i4")] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "n"])

    sums = counted.select("places").mapInArrow(run, "place long, n long")
    out = np.zeros(terms, np.int64)
    for row in sums.groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[row["place"]] = row["n"]
    return out


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """What each term weighs that so many of the documents hold."""
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64
    )


def impacts(times: np.ndarray, length: int) -> np.ndarray:
    """Of terms that occur so often in a document; ``length`` is its length in hundredths of the
    average, a quarter of it counted."""
    return 1_000_000_000 * times // (1000 * times + 12 * length)


class Node(NamedTuple):
    start: int
    stop: int
    children: tuple[int, int] | None


class BallTree:
    """Documents (rows of impacts) in the order of the leaves, halved until LEAF of them are left.

    ``centers`` and ``radii`` have a row per node; radii a column per group of terms.
    """

    def __init__(self, rows: np.ndarray, keys: np.ndarray, groups: np.ndarray, leaf: int = LEAF) -> None:
        self.rows, self.keys = rows, keys
        self.nodes: list[Node] = []
        self.groups = groups
        centers, radii = [], []
        order = np.arange(len(rows))
        points = rows.astype(np.float32)  # exact: impacts are below 2^24
        open_nodes = [(0, len(rows), -1)]
        while open_nodes:
            start, stop, parent = open_nodes.pop()
            own = points[order[start:stop]]
            center = own.mean(axis=0, dtype=np.float64).astype(np.float32)
            apart = own - center
            squares = np.add.reduceat(apart * apart, groups, axis=1)
            at = len(self.nodes)
            centers.append(center)
            radii.append(np.sqrt(squares.max(axis=0)) * np.float32(RADIUS_UP))
            self.nodes.append(Node(start, stop, None))
            if parent >= 0:
                first = self.nodes[parent].children
                self.nodes[parent] = self.nodes[parent]._replace(children=(at, at) if first is None else (first[0], at))
            if stop - start > leaf:
                # along the line from one far point to the one farthest from it
                one = apart[np.argmax(squares.sum(axis=1))]
                other = apart[np.argmax(((apart - one) ** 2).sum(axis=1))]
                half = (stop - start) // 2
                split = np.argpartition(apart @ (one - other), half)
                order[start:stop] = order[start:stop][split]
                open_nodes += [(start + half, stop, at), (start, start + half, at)]
        self.centers, self.radii = np.array(centers), np.array(radii)
        self.rows, self.keys = rows[order], keys[order]

    def bounds(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Per query (places, weights) and node, a number that no score below the node passes."""
        out = np.empty((len(queries), len(self.nodes)))
        for k, (places, weight) in enumerate(queries):
            group = np.searchsorted(self.groups, places, "right") - 1
            own, first = np.unique(group, return_inverse=True)
            lengths = np.sqrt(np.bincount(first, weight.astype(float) ** 2, len(own)))
            near = self.centers[:, places].astype(float) @ weight.astype(float)
            out[k] = (near + self.radii[:, own].astype(float) @ lengths) * BOUND_UP + 1
        return out

    def search(self, query: tuple[np.ndarray, np.ndarray], bounds: np.ndarray, best: list[tuple[int, int]], n: int = BEST) -> int:
        """Put the documents among the ``n`` best of the query into ``best``: (-score, key), sorted.
        Returns the number of documents scored."""
        places, weight = query
        heap, visited = [(-bounds[0], 0)], 0
        while heap:
            bound, at = heapq.heappop(heap)
            worst = -best[-1][0] if len(best) >= n else 1
            if -bound < worst:
                break
            node = self.nodes[at]
            if node.children is not None:
                for child in node.children:
                    if bounds[child] >= worst:
                        heapq.heappush(heap, (max(bound, -bounds[child]), child))
                continue
            visited += node.stop - node.start
            score = self.rows[node.start : node.stop, places].astype(np.int64) @ weight
            keys = self.keys[node.start : node.stop]
            better = score >= worst
            if len(best) >= n:
                better &= (score > worst) | (keys < best[-1][1])
            if better.any():
                best += zip((-score[better]).tolist(), keys[better].tolist(), strict=True)
                best.sort()
                del best[n:]
        return visited


def block_best(counted: DataFrame, block: Items, n: int = BEST) -> DataFrame:
    """(item, score, key, salt): the best documents of each task for each item of a block."""
    spark = counted.sparkSession
    total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    documents, all_terms = int(total[0]), int(total[1])
    weight = weights(holders(counted, len(block.terms)), documents)
    sent = spark.sparkContext.broadcast((block.groups, [(p, weight[p] * t) for p, t in zip(block.places, block.times, strict=True)]))
    width = len(block.terms)
    most = max(LEAF, TREE_NUMBERS // max(width, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory("lexical search")  # empties what other operators remember
        groups, queries = sent.value
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        rows, keys = np.zeros((most, width), np.int32), np.zeros(most, np.int64)
        filled = 0

        def searched() -> None:
            tree = BallTree(rows[:filled], keys[:filled], groups)
            bounds = tree.bounds(queries)
            for query, own, found in zip(queries, bounds, best, strict=True):
                if len(query[0]):
                    tree.search(query, own, found, n)

        for batch in batches:
            for doc_id, length, places, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                places = np.frombuffer(places, "<i4")
                m = 100 - 25 + 25 * length * documents // all_terms
                rows[filled] = 0
                rows[filled, places] = impacts(np.frombuffer(times, "<i4").astype(np.int64), m)
                keys[filled] = _NO_ID if doc_id is None else doc_id
                filled += 1
                if filled == most:
                    searched()
                    filled = 0
        if filled:
            searched()
        found = [(k, -score, key) for k, own in enumerate(best) for score, key in own]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "score", "key"])

    held = counted.filter(F.length("places") > 0).select("doc_id", "n", "places", "times")
    found = held.mapInArrow(run, "item long, score long, key long")
    return found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))


def _first(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def search(docs: DataFrame, items: DataFrame, n: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``n`` documents with the highest scores above 0."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(items):
        prepared = block_of([text for _, text in block])
        if not prepared.terms:
            continue
        counted = stage(term_counts(docs, prepared), "term-counts")
        found = _first(block_best(counted, prepared, n), ["item", "salt"], n).drop("rank")
        found = _first(found, ["item"], n)
        ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "item long, item_id long")
        named = found.join(F.broadcast(ids), "item").select(
            "item_id",
            F.col("rank").cast("int").alias("rank"),
            F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"),
            "score",
        )
        out = out.unionByName(stage(named, "block-best"))
    return out


def op12_ball_tree_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

OP12_SQL = f"""
with d as (select doc_id, {_TERMS_SQL} as terms from documents where text is not null),
total as (select count(*) as n, sum(len(terms))::bigint as l from d where len(terms) > 0),
tf as (select doc_id, any_value(n) as n, t, count(*) as tf
  from (select doc_id, len(terms) as n, unnest(terms) as t from d) group by doc_id, t),
q as (select item_id, t, count(*) as times from (select item_id, unnest({_TERMS_SQL}) as t
  from benchmark where text is not null) group by item_id, t),
w as (select t, floor(1000 * ln((2 * total.n + 2)::double / (2 * df + 1)))::bigint as w
  from (select t, count(*) as df from tf group by t), total),
x as (select doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * tf.n * total.n) // total.l)) as x
  from tf, total),
s as (select item_id, doc_id, sum(times * w * x)::bigint as score
  from q join w using (t) join x using (t) group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, rank::integer as rank, doc_id, score from r where rank <= {BEST}
"""
