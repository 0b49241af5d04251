"""Packing of documents into sequences of a fixed number of tokens, online and in bounded space.

Each partition keeps `WINDOWS` open windows.  A document's whole multiples of the length become sequences of their
own; the rest goes where it fits best.  When it fits nowhere, the fullest window takes as much of it as it can hold
and is emitted, and what is left opens a window.  The windows open at a partition's end are leftovers: these are
merged in groups of `FAN` partitions, and the groups' leftovers again, until one group remains.  Its last window,
shorter than a sequence, is cut into powers of two, which need no padding; so nothing is padded.

A merge reads at most FAN x WINDOWS windows, whatever the size of the corpus; only leftovers carry token ids, and
partitions are read without a shuffle.  A lost executor's partitions are read again and give the same sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import texts, written

LENGTH, END, WINDOWS, FAN = 2048, 1, 16, 64
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, ids binary"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


@dataclass
class Piece:
    """Ids of one document from start on."""

    doc_id: int | None
    start: int
    total: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.start, self.total, self.ids[:n]), Piece(self.doc_id, self.start + n, self.total,
            self.ids[n:])


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)


class Packer:
    """Bounded-space best fit over a stream of documents; emit gets each full window."""

    def __init__(self, emit: Callable[[Window], None], length: int = LENGTH, windows: int = WINDOWS) -> None:
        self.emit, self.length, self.windows, self.open = emit, length, windows, []

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.length:
            own, piece = piece.cut(self.length)
            self._close(own)
        if not len(piece.ids):
            return
        fits = [w for w in self.open if w.fill + len(piece.ids) <= self.length]
        if fits:
            best = max(fits, key=lambda w: w.fill)
            best.put(piece)
            if best.fill == self.length:
                self.open.remove(best)
                self.emit(best)
            return
        if len(self.open) == self.windows:
            fullest = max(self.open, key=lambda w: w.fill)
            head, piece = piece.cut(self.length - fullest.fill)
            fullest.put(head)
            self.open.remove(fullest)
            self.emit(fullest)
        self.open.append(w := Window())
        w.put(piece)

    def _close(self, piece: Piece) -> None:
        w = Window()
        w.put(piece)
        self.emit(w)


def chain(pieces: list[Piece], length: int, last: bool) -> tuple[list[Window], Window | None]:
    """Leftover pieces end to end in full windows, and the rest; the last rest is cut into powers of two instead."""
    full, now = [], Window()
    for p in pieces:
        while now.fill + len(p.ids) >= length:
            head, p = p.cut(length - now.fill)
            now.put(head)
            full.append(now)
            now = Window()
        if len(p.ids):
            now.put(p)
    if not last or not now.fill:
        return full, now if now.fill else None
    for bit in reversed(range(length.bit_length())):
        if now.fill >> bit & 1:
            own, rest = Window(), Window()
            for p in now.pieces:
                head, tail = p.cut(min(len(p.ids), (1 << bit) - own.fill))
                for w, x in ((own, head), (rest, tail)):
                    if len(x.ids):
                        w.put(x)
            full.append(own)
            now = rest
    return full, None


def _rows(window: Window, sequence: int | None, part: int | None) -> list[tuple]:
    out, at = [], 0
    for p in window.pieces:
        raw = p.ids.astype("<u4").tobytes()
        out.append((p.doc_id, p.start, len(p.ids), crc32(raw), p.total, sequence, at, part, raw if sequence is None
            else None))
        at += len(p.ids)
    return out


def load_encoder(ranks_path: str | None = None, json_path: str | None = None) -> Callable[[str], np.ndarray]:
    """text -> token ids as the JSON file's encoder gives them without added specials.

    The ranks file holds the same vocabulary; its encoder gives the same ids in a fifth of the time.  Added tokens of
    the JSON file, such as <|endoftext|>, are found in texts and have their own id, as in that encoder.  A text that
    the fast encoder can't take (its search for words gives up) goes to the JSON file's.
    """
    import base64
    import json

    import tiktoken

    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    with open(json_path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in added)
    special = {t["content"]: t["id"] for t in added}
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    ranks = {token: i for token, i in ranks.items() if i not in special.values()}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow: list = []

    def encode(text: str) -> np.ndarray:
        if plain or not any(t in text for t in special):
            try:
                return np.array(fast.encode(text, allowed_special="all"), np.uint32)
            except BaseException as e:  # a panic of the library is no Exception
                if type(e).__name__ != "PanicException" and not isinstance(e, Exception):
                    raise
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(json_path))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def pack(docs: DataFrame, length: int = LENGTH, windows: int = WINDOWS, fan: int = FAN, ranks_path: str | None = None,
        json_path: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone; repeated rows are packed each on its own; empty input: no rows.
    length must be a power of two.
    """
    assert length & (length - 1) == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = load_encoder(ranks_path, json_path), TaskContext.get().partitionId()
        rows: list[tuple] = []
        n = 0

        def emit(w: Window) -> None:
            nonlocal n
            rows.extend(_rows(w, part << 33 | n, part))
            n += 1

        packer = Packer(emit, length, windows)
        for b in batches:
            for doc_id, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode(t.as_py() or ""), np.uint32(END))
                packer.add(Piece(doc_id, 0, len(ids), ids))
            yield _batch(rows)
            rows.clear()
        for w in packer.open:
            rows.extend(_rows(w, None, part))
        yield _batch(rows)

    def merge(last: bool, level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def one(df: pd.DataFrame) -> pd.DataFrame:
            df = df.sort_values(["part", "window"], kind="stable")
            group = int(df.part.iloc[0]) // fan
            pieces = [Piece(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), int(r.doc_tokens),
                np.frombuffer(r.ids, "<u4")) for r in df.itertuples()]
            full, rest = chain(pieces, length, last)
            out = [r for k, w in enumerate(full) for r in _rows(w, level << 58 | group << 33 | k, group)]
            out += _rows(rest, None, group) if rest else []
            # by way of objects: a column of large integers and nulls must not pass through floating point
            return pd.DataFrame(out, columns=_NAMES, dtype=object).astype({c: "Int64" for c in _NAMES if c != "ids"})

        return one

    packed = written(texts(docs).mapInArrow(run, SCHEMA), "packed")
    out = [packed.where("sequence_id is not null")]
    left = packed.where("sequence_id is null")
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    level = 0
    while True:
        level += 1
        last = parts <= fan
        # start and doc_id tell the pieces of a partition apart: any fixed order will do
        ordered = left.withColumn("window", F.xxhash64("doc_id", "start", "ids_crc32", "offset"))
        merged = written(ordered.groupBy((F.col("part") / fan).cast("long").alias("group")).applyInPandas(merge(last,
            level), SCHEMA), f"merged-{level}")
        out.append(merged.where("sequence_id is not null"))
        if last:
            break
        left, parts = merged.where("sequence_id is null"), -(-parts // fan)
    result = out[0]
    for x in out[1:]:
        result = result.union(x)
    return result.drop("part", "ids")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if name == "ids" else pa.int64()) for name,
        c in zip(_NAMES, cols)], names=_NAMES)
