"""Secrets: known shapes, and strings that are new to what stands around them.

Known shapes are the base spans: assignments to sensitive names, access keys, long runs of
hex digits. Beyond them, every long token of a sensitive place is a candidate: of a line with a
sensitive word, before or after it, of the lines of one token each that go on from it, and
of the body of a PEM block, whose short last line counts with the one before. What a candidate adds to a zstandard frame is measured, with a dictionary primed by the text around it
and by the identifiers most common in such places over the whole corpus. An ordinary
name or a value repeated nearby costs a few bytes; a key drawn at random costs nearly all of
its own length. Candidates above a number of bits per character become ``novel`` spans,
of letters or figures alone too; only those of very few distinct characters are not measured.

Spans are ``kind:start:end`` in code points, end exclusive. Cases: null and empty texts have no
spans; a text of any length is scanned whole; repeated rows give repeated results; an
empty table gives an empty result, and its dictionary is empty. Other columns are
carried by ``scan``; ``_secrets`` is reserved.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triples.llm.common import map_batches, ship, table, text_or_empty

KINDS = ("assign", "access", "hex")
# \x20 and letters in either case; ASCII only, so that no other letter folds into them.
_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.I | re.A,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
#: Words that make a place sensitive.
_SENSITIVE = re.compile(
    r"key|token|secret|passw|pwd|credential|auth|bearer|private|signature", re.I | re.A
)
_PEM = re.compile(r"-----BEGIN [^\n-]*-----(?:(?!-----END)[\s\S])*+")
#: A further line of one token or none, and a line too short for a candidate that ends a body.
_GOES_ON = re.compile(r"[^\S\n]*+[^\s]*+[^\S\n]*+(?=\n|\Z)")
_TAIL = re.compile(r"[^\S\n]*\n[^\S\n]*([A-Za-z0-9+/_.=-]{1,15})(?=[^\S\n]*(?:\n|\Z))")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
#: Characters of a line from which a short line after it counts with it, outside PEM blocks.
WRAPPED = 40
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,31}(?![A-Za-z0-9_])")
#: Characters around a candidate that prime the compressor.
AROUND = 400
#: Bits per character from which a candidate counts as drawn at random, and distinct characters: so few
#: that random figures have them as well.
BITS, DISTINCT = 4.0, 5
#: Entries of the identifier dictionary (the most frequent ones; at most 32 characters each).
DICTIONARY = 1000


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, order of the kind, end) of the known shapes, sorted."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def places(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether in a PEM block) of the sensitive stretches of a text, in order."""
    blocks = [m.span() for m in _PEM.finditer(text)] if "-----BEGIN " in text else []
    blocks = [(a, b) for a, b in blocks if _SENSITIVE.search(text, a, text.index("-----", a + 5))]
    out: list[tuple[int, int, bool]] = []
    reach = 0

    def until(end: int) -> None:
        nonlocal reach
        for word in _SENSITIVE.finditer(text, reach, end):
            if word.start() < reach:
                continue
            start = text.rfind("\n", reach, word.start()) + 1 or reach
            stop = text.find("\n", word.end(), end)
            stop = end if stop < 0 else stop
            while stop < end and (line := _GOES_ON.match(text, stop + 1)) and line.end() <= end:
                stop = line.end()
            out.append((start, stop, False))
            reach = stop
        reach = end

    for a, b in blocks:
        until(a)
        out.append((a, b, True))
        reach = b
    until(len(text))
    return out


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """(start, end) of long tokens in sensitive places that no base span touches."""
    out: list[tuple[int, int]] = []
    at = 0
    for begin, stop, block in places(text):
        for m in _CANDIDATE.finditer(text, begin, stop):
            start, end = m.span()
            tail = _TAIL.match(text, end, stop) if block or end - start >= WRAPPED else None
            if tail:
                end = tail.end(1)
            while at < len(base) and base[at][2] <= start:
                at += 1
            if at == len(base) or base[at][0] >= end:
                out.append((start, end))
    return out


def around(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - AROUND) : start], text[end : end + AROUND]


def novelty(candidate: str, near: str, identifiers: bytes) -> float:
    """Bits per character that the candidate adds to a frame primed by its surroundings."""
    primed = identifiers + near.encode("utf-8", "replace")
    words = zstandard.ZstdCompressionDict(primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    options = zstandard.ZstdCompressionParameters.from_level(
        19, write_content_size=False, write_checksum=False, write_dict_id=False, window_log=18
    )
    packer = zstandard.ZstdCompressor(dict_data=words, compression_params=options)
    raw = candidate.encode()
    return 8 * (len(packer.compress(raw)) - len(packer.compress(b""))) / len(raw)


def identifier_counts(docs: DataFrame) -> DataFrame:
    """(identifier, n): how often each stands around candidates, over all documents."""

    def work(rows: dict) -> dict:
        counts: Counter = Counter()
        for text in rows["text"]:
            for start, end in candidates(text, base_spans(text)):
                for side in around(text, start, end):
                    counts.update(_IDENTIFIER.findall(side))
        return {"identifier": list(counts), "n": list(counts.values())}

    found = map_batches(docs.select(text_or_empty().alias("text")), work, "identifier string, n long")
    return found.groupBy("identifier").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, entries: int = DICTIONARY) -> bytes:
    """The most frequent identifiers, the most frequent last; at most 33 bytes an entry."""
    top = identifier_counts(docs).orderBy(F.desc("n"), "identifier").limit(entries)
    return " ".join(r[0] for r in reversed(top.collect())).encode() + b" "


def spans_of(text: str, identifiers: bytes) -> tuple[list, list]:
    """The base spans, and all spans: (start, order of the kind, end), novel ones last in order."""
    base = base_spans(text)
    novel = []
    for start, end in candidates(text, base):
        value = text[start:end]
        if len(set(value)) < DISTINCT:
            continue
        if novelty(value, "".join(around(text, start, end)), identifiers) >= BITS:
            novel.append((start, len(KINDS), end))
    return base, sorted(base + novel)


def written(spans: list) -> str:
    names = (*KINDS, "novel")
    return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list) -> str:
    """The text with every span replaced by ``<secret>``; spans that overlap, by one."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "<secret>"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


_FIELDS = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in (*KINDS, "novel")]
    + [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans", "redacted")]
)


def scan(docs: DataFrame, identifiers: bytes, redact: bool = False) -> DataFrame:
    """``docs`` with the struct ``_secrets``: counts per kind, base_sha256, spans and, if asked
    for, the redacted text (null where nothing was found)."""
    ship(docs.sparkSession)

    @F.pandas_udf(_FIELDS)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, spans = spans_of(text, identifiers)
            kinds = Counter(s[1] for s in spans)
            sha = hashlib.sha256(written(base).encode()).hexdigest()
            clean = redacted(text, spans) if redact and spans else None
            rows.append((*[kinds[k] for k in range(4)], sha, written(spans), clean))
        return pd.DataFrame(rows, columns=_FIELDS.names)

    return docs.withColumn("_secrets", scanned(text_or_empty()))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced, and ``n_chars`` as the text then has."""
    found = scan(docs, dictionary(docs), redact=True)
    clean = F.col("_secrets.redacted")
    changes = {"text": F.coalesce(clean, F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changes["n_chars"] = F.when(clean.isNull(), F.col("n_chars")).otherwise(
            F.length(clean).cast(kind)
        )
    return found.withColumns(changes).select(*docs.columns)


def op7_zstd_novelty(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, dictionary(docs))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(f"_secrets.{c}").alias(c) for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")],
    )
