"""Document fingerprints from Lempel-Ziv phrases.

A document is parsed into LZ78 phrases over its UTF-8 bytes: each phrase is the longest known one plus a byte.  The
set of phrase hashes is sketched by one-permutation minimum hashing: the hash names a bin, the bin keeps its least
hash, empty bins borrow from the next one.  The share of equal bins estimates how much of their dictionaries two
documents share, as compressing them together would.

`fingerprint_report` holds each document against an edited text and the next document by doc_id.  Rows are dealt by
ranges of doc_id, split at quantiles; each range also gets a copy of the next range's first document, so that every
pair meets in one pass, in constant memory, after one shuffle of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import texts

BINS, DIGITS = 128, 4
_MUL, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


@dataclass
class Phrases:
    """State of an LZ78 parse: it may go on with any bytes.  known: (phrase << 8 | byte) -> phrase; hashes by phrase."""

    known: dict[int, int] = field(default_factory=dict)
    hashes: list[int] = field(default_factory=lambda: [0])
    at: int = 0

    def copy(self) -> Phrases:
        return Phrases(self.known.copy(), self.hashes.copy(), self.at)

    def feed(self, data: bytes) -> Phrases:
        known, hashes, at = self.known, self.hashes, self.at
        get = known.get
        for c in data:
            key = at << 8 | c
            nxt = get(key)
            if nxt is None:
                known[key] = len(hashes)
                hashes.append((hashes[at] * 0x100000001B3 + c + 1) & _MASK)
                at = 0
            else:
                at = nxt
        self.at = at
        return self

    def sketch(self) -> np.ndarray:
        return sketch(np.array(self.hashes[1:], np.uint64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """BINS values of 16 bits; no phrases: all zero (a phrase's value is never zero)."""
    if not len(hashes):
        return np.zeros(BINS, np.uint16)
    h = hashes * np.uint64(_MUL)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h.sort()
    shift = np.uint64(64 - (BINS.bit_length() - 1))
    bins = (h >> shift).astype(np.int64)
    used, first = np.unique(bins, return_index=True)
    low = ((h[first] * np.uint64(_MUL)) >> np.uint64(48)).astype(np.int64)
    donor = np.searchsorted(used, np.arange(BINS)) % len(used)
    steps = (used[donor] - np.arange(BINS)) % BINS
    return ((low[donor] + steps * 40503) % 65535 + 1).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins, 0 to 1; two texts without phrases are alike."""
    return float((a == b).mean())


def text_of(s: np.ndarray) -> str:
    return s.astype(">u2").tobytes().hex()


def edit(text: str, other: str) -> str:
    """text with its last floor(n / 4) code points replaced by the first as many (or all) of other."""
    n = len(text) // 4
    return text[: len(text) - n] + other[:n]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [text_of(Phrases().feed((t.as_py() or "").encode()).sketch()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())],
                names=["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, the next range's first document behind them (tail); a result for each row that isn't tail."""
    names = [c.split()[0] for c in _OUT.split(", ")]
    held = None
    done = False
    for b in batches:
        rows = []
        for doc_id, t, tail in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            if done:
                continue
            text = t.as_py() or ""
            keep = len(text) - len(text) // 4
            state = Phrases().feed(text[:keep].encode())
            edited = state.copy() if keep < len(text) else state
            own = state.feed(text[keep:].encode()).sketch()
            if held is not None:
                rows.append(_result(*held, text, own))
            held = (doc_id, text, edited, own)
            done = bool(tail)
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def _result(doc_id, text, state, own, other, other_sketch) -> tuple:
    n = len(text) // 4
    changed = state.feed(other[:n].encode()).sketch() if n else own
    sha = hashlib.sha256(edit(text, other).encode()).hexdigest()
    return doc_id, len(text), sha, text_of(own), text_of(changed), likeness(own, changed), likeness(own, other_sketch)


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """For every row: its fingerprint, that of its edited text, and likeness to the edited text and the next document.

    Next is the next row by doc_id, nulls last, equal ids by text; after the last row comes the first, so a lone row
    is its own next.  Null text counts as empty.  Empty input: no rows.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = texts(docs)
    ids = docs.select("doc_id")
    splits = sorted(set(ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (8 * n)))) if n > 1 else []
    shared = spark.sparkContext.broadcast(np.array(splits, np.float64))  # as many as partitions

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series) -> pd.Series:
        at = np.searchsorted(shared.value, doc_id.fillna(0).to_numpy(np.float64), "right")
        return pd.Series(np.where(doc_id.isna(), len(shared.value), at), dtype="int32")

    heads = {r.b: r.head
        for r in ids.groupBy(range_of("doc_id").alias("b")).agg(F.min("doc_id").alias("head")).collect()}  # a row for each range
    used = sorted(heads)
    before = {b: used[k - 1] for k, b in enumerate(used)}  # the first range's head follows the last range
    head_of = spark.sparkContext.broadcast((heads, before))

    @F.pandas_udf("array<int>")
    def targets(doc_id: pd.Series) -> pd.Series:
        heads, before = head_of.value
        at = np.where(doc_id.isna(), len(shared.value),
            np.searchsorted(shared.value, doc_id.fillna(0).to_numpy(np.float64), "right"))
        own = [None if pd.isna(x) else int(x) for x in doc_id]
        return pd.Series([[int(b), -1 - before[int(b)]] if heads[int(b)] == x else [int(b)] for b, x in zip(at, own)],
            dtype=object)

    dealt = docs.select("doc_id", "text", F.explode(targets("doc_id")).alias("t"))
    placed = dealt.select("doc_id", "text", (F.col("t") < 0).alias("tail"),
        F.when(F.col("t") < 0, -1 - F.col("t")).otherwise(F.col("t")).cast("int").alias("part"))
    parts = placed.repartitionById(len(splits) + 1, F.col("part")).drop("part")
    return parts.sortWithinPartitions("tail", F.asc_nulls_last("doc_id"), "text").mapInArrow(_pairs, _OUT)
