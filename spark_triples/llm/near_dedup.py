"""Near-duplicates by an inverted join over MinHash signatures, confirmed on full sets.

1. Texts with the same set of shingles form a class; from here on a class is one row.
2. A class is posted under each (coordinate, value) pair of its signature. Posts that no
   other class shares drop out. Two signatures that agree in at least T of K coordinates
   share one of the K - T + 1 rarest posts of either, so only these prefixes are joined, and
   classes with fewer than T shared posts are skipped.
3. First every class meets the smallest class of each of its posts (a star, not all pairs),
   then, where more than one component is left, one drawn for each post, twice. Pairs whose
   signatures agree in T coordinates are confirmed on their full sets, and linked classes
   become components. A pair that was compared is not compared again.
4. Posts that hold one component only are settled: a large group of copies has collapsed by
   then. In the others, shingles that no other component has bound what a class can share:
   a class that could not reach the limit with any class of the post leaves it. What is left is
   signed again, with BITS coordinates of one bit each, which tell similarities apart that the
   first signatures can't, and is compared in pairs from different components, so no link
   between components is missed.

T is the largest number that a pair at the limit misses with a probability below MISS, for
either signature. Links are
decided on the sets (64-bit hashes of shingles; sets are equal by a 128-bit hash).

Cases: null and empty texts have an empty set, are linked with nothing and stand for
themselves. With fewer words than a shingle, the whole sequence is the one shingle. A null
doc_id is never the smallest of a component unless all are null. Repeated rows belong
to one class. Very long texts are worked on whole. Empty tables give empty results.
Columns besides doc_id and text are ignored by ``link``, and carried by ``keep_one``
(``_key`` is reserved).
"""

from __future__ import annotations

from math import comb, exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triples.llm.common import (
    lower_ascii,
    map_batches,
    mix,
    odd_numbers,
    table,
    text_or_empty,
    word_hashes,
    words_of,
)
from spark_triples.llm.components import components
from spark_triples.session import stage

WORDS, PERCENT = 5, 80
K, MISS = 64, 1e-7
BITS = 8192
# Stars only have to merge most copies: a pair that they miss is met again.
STAR_MISS = 0.5
_PLACES = odd_numbers(WORDS, 5)
_COORDINATES = odd_numbers(K, 64)
_BIT_COORDINATES = odd_numbers(BITS, 65)


def least_agreement(percent: int, k: int = K, miss: float = MISS) -> int:
    """The largest T such that a pair of this similarity agrees in fewer than T of ``k``
    coordinates with a probability below ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(k):
        below += comb(k, t) * p**t * (1 - p) ** (k - t)
        if below > miss:
            return max(t, 1)
    return k


def most_unequal_bits(percent: int, bits: int = BITS, miss: float = MISS) -> int:
    """The least D such that a pair of this similarity differs in more than D of so many
    one-bit coordinates with a probability below ``miss``. Half of the coordinates that don't
    agree have equal bits."""
    p = (1 - percent / 100) / 2
    if p == 0:
        return 0
    rest = 1.0
    for d in range(bits):
        chance = lgamma(bits + 1) - lgamma(d + 1) - lgamma(bits - d + 1)
        rest -= exp(chance + d * log(p) + (bits - d) * log1p(-p))
        if rest < miss:
            return d
    return bits


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    found = words_of(lower_ascii(text))
    if not found:
        return np.zeros(0, np.uint64)
    h = word_hashes(found)
    n = len(h) - words + 1
    if n < 1:
        short = (h * _PLACES[: len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))
        return mix(np.array([short], np.uint64))
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total += h[k : k + n] * _PLACES[k]
    return np.unique(mix(total))


def signature(found: np.ndarray) -> np.ndarray:
    """Per coordinate the least of the hashes, multiplied by the coordinate's odd number."""
    least = np.full(K, np.iinfo(np.uint64).max)
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096, None] * _COORDINATES
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bit_signature(found: np.ndarray) -> np.ndarray:
    """A bit of the least hash of each of BITS coordinates, 64 of them to a number."""
    least = np.full(BITS, np.iinfo(np.uint64).max)
    for at in range(0, len(found), 256):
        part = found[at : at + 256, None] * _BIT_COORDINATES
        np.minimum(least, part.min(axis=0), out=least)
    return np.packbits((mix(least) & np.uint64(1)).astype(bool)).view("<i8")


def _set_name(found: np.ndarray) -> tuple[int, int]:
    name = xxhash.xxh3_128_intdigest(found.tobytes())
    signed = [(x ^ (1 << 63)) - (1 << 63) for x in (name >> 64, name & ((1 << 64) - 1))]
    return signed[0], signed[1]


def _key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), text_or_empty())


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, key, row, n, s1, s2, signature) of every document."""

    def work(rows: dict) -> dict:
        sets = [shingles(t, words) for t in rows["text"]]
        names = [_set_name(s) for s in sets]
        flat = np.concatenate([signature(s) for s in sets]) if sets else np.zeros(0, np.int32)
        offsets = np.arange(0, len(flat) + 1, K, dtype=np.int32)
        return {
            **{c: rows[c] for c in ("doc_id", "key", "row")},
            "n": [len(s) for s in sets],
            "s1": [n[0] for n in names],
            "s2": [n[1] for n in names],
            "signature": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
        }

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        _key().alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    schema = "doc_id long, key long, row long, n long, s1 long, s2 long, signature array<int>"
    return map_batches(source, work, schema)


def _prefixes(classes: DataFrame, least: int) -> DataFrame:
    """(cls, n, post): the rarest posts of classes that share at least ``least`` posts."""
    posts = classes.select("cls", "n", F.posexplode("signature").alias("k", "value"))
    post = F.shiftleft(F.col("k").cast("long"), 32) + F.col("value").bitwiseAND(F.lit((1 << 32) - 1))
    posts = posts.select("cls", "n", post.alias("post"))
    shared = posts.groupBy("post").agg(F.count("*").alias("often")).filter("often > 1")
    own = (
        posts.join(shared, "post")
        .groupBy("cls", "n")
        .agg(F.sort_array(F.collect_list(F.struct("often", "post"))).alias("posts"))
        .filter(F.size("posts") >= least)  # at most K posts a class
    )
    return own.select(
        "cls",
        "n",
        F.explode(F.expr(f"slice(posts, 1, size(posts) - {least} + 1)")["post"]).alias("post"),
    )


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cls, shingles) of the classes in ``wanted`` (key, s1, s2, cls)."""

    def work(rows: dict) -> dict:
        sets = [shingles(t, words) for t in rows["text"]]
        names = [_set_name(s) for s in sets]
        return {
            "s1": [n[0] for n in names],
            "s2": [n[1] for n in names],
            "shingles": [s.tobytes() for s in sets],
        }

    source = docs.select(_key().alias("key"), text_or_empty().alias("text"))
    source = source.join(wanted.select("key"), "key", "left_semi").select("text")
    made = map_batches(source, work, "s1 long, s2 long, shingles binary")
    return (
        made.join(wanted.select("s1", "s2", "cls"), ["s1", "s2"])
        .groupBy("cls")
        .agg(F.first("shingles").alias("shingles"))
    )


def _bits(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, bits) of the classes in ``wanted``."""

    def work(rows: dict) -> dict:
        signed = [bit_signature(np.frombuffer(x, np.uint64)).tolist() for x in rows["shingles"]]
        return {"cls": rows["cls"], "bits": signed}

    chosen = sets.join(wanted.select("cls").distinct(), "cls", "left_semi").select("cls", "shingles")
    return stage(map_batches(chosen, work, "cls long, bits array<long>"), "bits")


def _unequal_bits(a: str, b: str) -> Column:
    differing = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differing, F.lit(0), lambda n, x: n + x)


def _agreement(a: str, b: str) -> Column:
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x)


def _agreeing(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``least`` coordinates."""

    def side(name: str) -> DataFrame:
        return classes.select(F.col("cls").alias(name), F.col("signature").alias(f"s{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return stage(both.filter(_agreement("sa", "sb") >= least).select("a", "b"), "near-pairs")


def _confirmed(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike."""

    def alike(rows: dict) -> dict:
        out: dict[str, list] = {"a": [], "b": []}
        for a, b, x, y in zip(rows["a"], rows["b"], rows["xa"], rows["xb"], strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                out["a"].append(a)
                out["b"].append(b)
        return out

    full = near
    for name in ("b", "a"):
        full = full.join(
            sets.select(F.col("cls").alias(name), F.col("shingles").alias(f"x{name}")), name
        )
    return stage(map_batches(full, alike, "a long, b long"), "links")


def link(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(doc_id, key, row, n_shingles, component_id, first): ``first`` marks one row of each
    component, that with the smallest doc_id."""
    least, likely = least_agreement(percent), least_agreement(percent, miss=STAR_MISS)
    signed = stage(_signed(docs, words), "signatures")
    filled = signed.filter("n > 0")
    classes = stage(filled.groupBy("s1", "s2").agg(F.min("row").alias("cls")), "classes")
    reps = stage(
        filled.join(classes.select("cls"), F.col("row") == F.col("cls"), "left_semi")
        .withColumn("cls", F.col("row"))
        .select("cls", "key", "n", "s1", "s2", "signature"),
        "representatives",
    )
    prefixes = stage(_prefixes(reps, least), "prefixes")
    owners = prefixes.select("cls").distinct()
    wanted = stage(reps.join(owners, "cls", "left_semi"), "wanted")
    sets = stage(_sets(docs, wanted, words), "sets")

    links, roots, compared = None, None, None
    for draw in (F.lit(0), F.xxhash64("cls", "post"), F.xxhash64("post", "cls")):
        open_posts = _unsettled(prefixes, roots)
        middle = open_posts.groupBy("post").agg(
            F.min(F.struct(draw.alias("draw"), "cls", "n", "root")).alias("middle")
        )
        stars = open_posts.join(middle, "post").filter(
            (F.col("root") != F.col("middle.root")) & _like_sizes("n", "middle.n", percent)
        )
        pairs = stars.select(
            F.least("cls", "middle.cls").alias("a"), F.greatest("cls", "middle.cls").alias("b")
        ).distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        near = _agreeing(pairs, wanted, likely)
        compared = near if compared is None else compared.unionByName(near)
        found = _confirmed(near, sets, percent)
        links = found if links is None else links.unionByName(found)
        roots = components(links)

    left = _reachable(_unsettled(prefixes, roots), sets, percent)
    posts = left.groupBy("cls").agg(F.collect_set("post").alias("posts"))  # at most K
    signed_posts = left.join(posts, "cls").join(wanted.select("cls", "signature"), "cls")
    left = stage(signed_posts.join(_bits(sets, left), "cls"), "candidates")
    columns = ("cls", "n", "root", "shared", "posts", "signature", "bits")
    other = left.select("post", *[F.col(c).alias(f"{c}_b") for c in columns])
    most = F.least("shared", "shared_b")
    pairs = (
        left.join(other, "post")
        .filter(
            (F.col("root") < F.col("root_b"))
            & _like_sizes("n", "n_b", percent)
            & (100 * most >= percent * (F.col("n") + F.col("n_b") - most))
            # a pair is made at the least of its common posts only
            & (F.array_min(F.array_intersect("posts", "posts_b")) == F.col("post"))
            & (_agreement("signature", "signature_b") >= least)
            & (_unequal_bits("bits", "bits_b") <= most_unequal_bits(percent))
        )
        .select(F.least("cls", "cls_b").alias("a"), F.greatest("cls", "cls_b").alias("b"))
        .join(compared, ["a", "b"], "left_anti")
    )
    links = links.unionByName(_confirmed(stage(pairs, "near-pairs"), sets, percent))
    roots = components(links)

    member = signed.join(classes, ["s1", "s2"], "left").join(
        roots.select(F.col("a").alias("cls"), F.col("b").alias("root")), "cls", "left"
    )
    # an empty set stands for itself: its row is its component
    member = stage(
        member.select(
            "doc_id", "key", "row", "n", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("root")
        ),
        "members",
    )
    # written, so that the join below has plain exchanges that the skew join may split
    least_of = member.filter("n > 0").groupBy("root").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row"))["row"].alias("one"),
    )
    least_of = stage(least_of, "smallest")
    alone = F.col("n") == 0
    return member.join(least_of, "root", "left").select(
        "doc_id",
        "key",
        "row",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("one"))).alias("first"),
    )


def _like_sizes(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _unsettled(prefixes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(cls, n, post, root, …) of the posts that hold more than one component."""
    if roots is None:
        return prefixes.withColumn("root", F.col("cls"))  # a post has two classes at least
    rooted = prefixes.join(
        roots.select(F.col("a").alias("cls"), F.col("b").alias("root")), "cls", "left"
    ).withColumn("root", F.coalesce("root", "cls"))
    return _mixed(stage(rooted, "rooted"))


def _mixed(rooted: DataFrame) -> DataFrame:
    """The rows of posts with more than one component, with the least set size of the post."""
    mixed = (
        rooted.groupBy("post")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("smallest"))
        .filter("low < high")
        .select("post", "smallest")
    )
    return rooted.join(mixed, "post")


def _reachable(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cls, n, post, root, shared): what may still be linked across components.

    ``shared`` counts the shingles of a class that another component of ``left`` has; no class
    of another component shares more. A class leaves a post if even a class of the most
    favourable size there would stay below the limit; posts that are settled then go.
    """
    left = stage(left, "open-posts")

    def single(rows: dict) -> dict:
        found = [np.frombuffer(x, np.int64) for x in rows["shingles"]]
        sizes = [len(x) for x in found]
        return {
            "shingle": np.concatenate(found) if found else [],
            **{c: np.repeat(np.array(rows[c], np.int64), sizes) for c in ("cls", "root")},
        }

    owners = left.select("cls", "root").distinct()
    each = map_batches(sets.join(owners, "cls"), single, "cls long, root long, shingle long")
    across = (
        each.groupBy("shingle")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low < high")
        .select("shingle")
    )
    shared = each.join(across, "shingle").groupBy("cls").agg(F.count("*").alias("shared"))
    n, s = F.col("n"), F.col("shared")
    possible = 100 * s >= percent * (n + F.greatest("smallest", s) - s)
    kept = stage(left.join(shared, "cls").filter(possible).drop("smallest"), "reachable")
    return _mixed(kept).drop("smallest")


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of every component, with the columns of ``docs``. Rows that repeat both
    doc_id and text count as one."""
    kept = link(docs, percent).filter("first").select(F.col("key").alias("_key"))
    found = docs.withColumn("_key", _key()).join(kept, "_key", "left_semi")
    return found.dropDuplicates(["_key"]).select(*docs.columns)


def op3_signature_join(spark, sf_dir: str) -> DataFrame:
    """The component of every document, at a similarity of 0.85."""
    found = link(table(spark, sf_dir, "documents"), percent=85)
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
