"""Packing along a space-filling curve.

Every document is tokenised; the counts of its token ids, hashed to a vector, are projected
to a few dimensions; the place of that point on a Hilbert curve is its key. The documents
are range-sorted by key and laid end to end, so neighbours on the curve, documents of
like vocabulary, share sequences. The line is cut at every multiple of the sequence length.

Cases: null and empty texts are documents of the end id alone. Documents with equal keys,
repeated rows included, are ordered by ``doc_id`` (nulls first), then by a frozen row
number, so a third of all rows may share a key. An empty table gives no pieces. Other columns
of the input are ignored. A document of any length is cut into as many pieces as needed.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_triples.llm.common import map_batches, memory, table, text_or_empty
from spark_triples.session import stage

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
LENGTH = 4096
#: The hashed vectors, and the grid on which the curve runs (DIMS * BITS <= 62).
VECTOR, DIMS, BITS = 1024, 4, 15
SEED = 20_240_501

# Words that the tokenizer cuts into pieces by plain rules: ASCII and Latin letters that
# neither compose nor change their number in lower case. All others go to it whole.
_EASY = re.compile("[\x21-\x7eÀ-ÖØ-öø-įĲ-ňŊ-ſ]*").fullmatch
_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+"
).findall
_REMEMBERED = 1_200_000


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer on this machine, or ``name`` itself if it is a path."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokens:
    """Ids of texts, as bytes of 16 bits each, equal to the tokenizer's own on the whole text.

    The tokenizer drops white space, and none of its pieces crosses it, so a text is
    the join of its words. Each worker remembers words; new ones are encoded many at once.
    """

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.name = name
        self.model = Tokenizer.from_file(tokenizer_path(name))
        vocabulary = self.model.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError(f"{name}: ids must be below 65,536")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
    def encode(self, text: str) -> bytes:
        found = self.model.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u2").tobytes()

    def memory(self) -> dict[str, dict[str, bytes]]:
        """Ids of words, and of the pieces that words are made of."""
        held = memory(f"tokens of {self.name}")
        if not held:
            held.update(words={"": b""}, pieces={})
        return held

    def learn(self, new: set[str]) -> None:
        words, known, cut = self.memory()["words"], self.memory()["pieces"], []
        for w in new:
            if _EASY(w) and "<|" not in w:
                cut.append(w)
            else:
                words[w] = self.encode(w)
        pieces = {p for w in cut for p in _PIECES(w.lower())}
        fresh = list(pieces.difference(known))
        for at in range(0, len(fresh), 2000):
            part = fresh[at : at + 2000]
            raw = self.encode(" ".join(part))
            stops = 2 * np.flatnonzero(self.ends[np.frombuffer(raw, "<u2")]) + 2
            if len(stops) != len(part):
                raise AssertionError("the tokenizer cuts words otherwise than expected")
            start = 0
            for piece, stop in zip(part, stops.tolist(), strict=True):
                known[piece] = raw[start:stop]
                start = stop
        for w in cut:
            words[w] = b"".join([known[p] for p in _PIECES(w.lower())])

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.memory()["words"]) > _REMEMBERED:
            self.memory().clear()
        words = self.memory()["words"]
        self.learn({w for ws in cut for w in set(ws).difference(words)})
        return [b"".join([words[w] for w in ws]) for ws in cut]


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each grid point (rows of ``bits``-bit coordinates) on a Hilbert curve.

    The usual bitwise form: undo the turns from the highest bit down, take the Gray code,
    and interleave the bits.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:
        below = bit - 1
        for i in range(dims):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(set_, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = top
    while bit > 1:
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - 1), turn)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@lru_cache(1)
def _model(name: str) -> WordTokens:
    gc.disable()  # the remembered words are many and hold no cycles
    return WordTokens(name)


@lru_cache(1)
def _directions() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((VECTOR, DIMS))


def curve_keys(documents: list[bytes], directions: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents given as 16-bit ids."""
    vectors = np.zeros((len(documents), VECTOR), np.float32)
    for row, raw in zip(vectors, documents, strict=True):
        ids = np.frombuffer(raw, "<u2").astype(np.uint32)
        bucket = (ids * np.uint32(2_654_435_761)) >> np.uint32(22)
        row += np.bincount(bucket, minlength=VECTOR)
    vectors = np.log1p(vectors)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    place = 1 / (1 + np.exp(-1.702 * (vectors @ directions)))  # about the normal's share
    return hilbert_key((place * ((1 << BITS) - 1)).astype(np.int64), BITS)


def tokenise(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, n, key, row): ids with the end id, 16 bits each."""

    def work(rows: dict) -> dict:
        ids = _model(tokenizer)(rows["text"])
        keys = curve_keys(ids, _directions())
        end = np.array([end_id], "<u2").tobytes()
        ids = [x + end for x in ids]
        n = [len(x) // 2 for x in ids]
        return {"doc_id": rows["doc_id"], "ids": ids, "n": n, "key": keys, "row": rows["row"]}

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return map_batches(source, work, "doc_id long, ids binary, n long, key long, row long")


def _laid_out(tokens: DataFrame) -> DataFrame:
    """(doc_id, ids, part, before): the ids before each document in its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "ids", "n", "part")), pa.array(before)],
                names=["doc_id", "ids", "n", "part", "before"],
            )

    ranged = (
        tokens.repartitionByRange("key", "doc_id", "row")
        .sortWithinPartitions("key", "doc_id", "row")
        .withColumn("part", F.spark_partition_id().cast("long"))
    )
    return ranged.mapInArrow(run, "doc_id long, ids binary, n long, part long, before long")


def cuts(total: int, length: int) -> tuple[int, list[int]]:
    """Where the whole sequences end, and the starts of the last ones: what is left over is
    cut into lengths that are powers of two, which need no padding."""
    full = total - total % length
    at, starts = full, []
    for bit in range(length.bit_length() - 1, -1, -1):
        if (total - full) >> bit & 1:
            starts.append(at)
            at += 1 << bit
    return full, starts


def pack(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    length: int = LENGTH,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and with ``with_ids`` the ids themselves.

    All sequences are full but the last few, whose lengths are powers of two.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    tokens = stage(tokenise(docs, tokenizer, end_id), "pack-tokens")
    laid = stage(_laid_out(tokens), "pack-ranges")
    # One row per range of the sort, so this window is small whatever the input.
    totals = laid.groupBy("part").agg(F.sum("n").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0)))
    total = totals.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    full, rest = cuts(total, length)
    rest_array = np.array(rest, np.int64)

    def work(rows: dict) -> dict:
        out: dict[str, list] = {c: [] for c in names}
        for doc_id, raw, n, begin in zip(
            rows["doc_id"], rows["ids"], rows["n"], rows["begin"], strict=True
        ):
            ids = np.frombuffer(raw, "<u2").astype("<u4").tobytes()
            at = 0
            while at < n:
                place = begin + at
                if place < full:
                    number, first = divmod(place, length)
                    first, stop = place - first, (number + 1) * length
                else:
                    k = int(np.searchsorted(rest_array, place, "right")) - 1
                    number, first = full // length + k, rest[k]
                    stop = rest[k + 1] if k + 1 < len(rest) else total
                end = min(n, at + stop - place)
                piece = ids[4 * at : 4 * end]
                values = (doc_id, at, end - at, zlib.crc32(piece), n, number, place - first, piece)
                for c, v in zip(out, values, strict=False):
                    out[c].append(v)
                at = end
        return out

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids binary" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    placed = laid.join(F.broadcast(base.select("part", "base")), "part")
    placed = placed.select("doc_id", "ids", "n", (F.col("base") + F.col("before")).alias("begin"))
    return map_batches(placed, work, schema)


def op2_curve_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 tokens along a Hilbert curve."""
    return pack(table(spark, sf_dir, "documents"))
