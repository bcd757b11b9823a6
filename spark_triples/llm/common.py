"""Helpers that several operators share: Arrow batches, word hashes, row keys."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that ends a word: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
_TO_SPACE = str.maketrans({c: " " for c in SPACES})
#: Words whose hash a worker remembers; beyond that it starts anew (results don't change).
REMEMBERED = 500_000
#: Characters of text that are worked on at once, besides the text that passes them.
SLICE_CHARS = 4_000_000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str) -> list[str]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return [w for w in text.translate(_TO_SPACE).split(" ") if w]


def lower_ascii(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


#: Bytes of UTF-8 that belong to no term (ASCII but letters and digits) as spaces, A-Z as a-z.
_TERM_BYTES = bytes(
    b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower()
)


def terms_of(raw: bytes) -> list[bytes]:
    """The runs of letters, digits and characters beyond ASCII of a text in UTF-8, A-Z in lower
    case."""
    return raw.translate(_TERM_BYTES).split()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package to the executors once per application, so that tasks import it and
    what a worker remembers outlives a task."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="package-")  # on the driver; Spark sends the file
    archive = shutil.make_archive(
        f"{folder}/{package.name}", "zip", package.parent, package.name
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def map_batches(
    df: DataFrame, work: Callable[[dict], dict], schema: str
) -> DataFrame:
    """``work`` on the columns of each Arrow batch, as lists; it returns columns as lists
    or arrays, named as in ``schema``. Nothing is kept from one batch to the next."""
    ship(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            for part in slices(batch):
                columns = work(part.to_pydict())
                arrays = [pa.array(columns[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, target)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about SLICE_CHARS bytes each; a longer row is a part alone."""
    rows = batch.num_rows
    step = max(1, int(rows * SLICE_CHARS / max(batch.nbytes, 1))) if rows else 1
    for start in range(0, rows, step):
        yield batch.slice(start, step)


_memories: dict[str, dict] = {}
_in_use: list[str] = [""]


def memory(name: str, kind: type[dict] = dict) -> dict:
    """What a Python worker remembers under a name. Workers live on from stage to stage, so
    taking one memory empties the others: a worker holds one at a time."""
    if _in_use[0] != name:
        for other, held in _memories.items():
            if other != name:
                held.clear()
        _in_use[0] = name
    return _memories.setdefault(name, kind())


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, remembered per worker."""
    known = memory("words")
    new = set(words).difference(known)
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = set(words)
    for w in new:
        known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


_OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”«»„…¡¿"


class _Cores(dict):
    """The hash of a word without case and outer punctuation; 0 if nothing is left."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        core = word.lower().strip(_OUTER)
        value = xxhash.xxh3_64_intdigest(core.encode("utf-8", "surrogatepass")) if core else 0
        self[word] = value
        return value


def core_hashes(text: str) -> np.ndarray:
    """Hashes of a text's words without case and outer punctuation, where anything is left."""
    words = text.split()
    h = np.fromiter(map(memory("cores", _Cores).__getitem__, words), np.uint64, len(words))
    return h[h != 0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed random odd multipliers."""
    draw = np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64)
    return draw * np.uint64(2) + np.uint64(1)
