"""SimHash near-duplicate detection by bit-sliced comparison.

Fingerprints within two differing bits agree on two of any four fields of their open bits, so each distinct
fingerprint goes to six buckets (32 equal bits).  Buckets above `BUCKET` fingerprints are split in the same way
on the bits still open (48, then 56 equal bits); after that at most 256 distinct values remain, so no bucket is
ever capped and no link is lost.  Within a bucket fingerprints lie in blocks of 64 lanes, one 64-bit word per
bit plane; differences are counted for 64 lanes at once by carry-save counters, and a block is abandoned as soon
as all its lanes exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import texts, written
from foliant.llm.graph import components

SHINGLE, SEED, RADIUS, BUCKET = 3, 42, 2, 2048


def _hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        grams, n = [b" ".join(words)], 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))), len(words) - SHINGLE + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)


def fingerprint(text: str | None) -> int:
    """64-bit SimHash: a bit is set if over half of the shingle hashes have it; no words: 0."""
    h = _hashes(text)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):  # long texts in slices
        part = h[at : at + (1 << 16)].astype("<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0,
            dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * votes > len(h)).tolist())) if len(h) else 0


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row of docs; fp is the fingerprint as a signed long.  Null text: no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def _fields(level: int, fields: tuple[int, ...] = ()) -> list[list[int]]:
    """Open bits of a fingerprint at a level, as four fields of bit numbers."""
    open_bits = [b for b in range(64) if b not in fields]
    step = len(open_bits) // 4
    return [open_bits[i * step : (i + 1) * step] for i in range(4)]


def _choices(level: int) -> list[tuple[int, ...]]:
    """All sets of equal bits that a bucket of this level can stand for (6, 36, 216)."""
    sets: list[tuple[int, ...]] = [()]
    for _ in range(level):
        sets = [(*s, *fa, *fb) for s in sets for fa, fb in combinations(_fields(level, s), 2)]
    return sets


def _mask(bits: tuple[int, ...]) -> int:
    return _signed(sum(1 << b for b in bits))


def _keyed(fps: DataFrame, level: int) -> DataFrame:
    """(kind, key, fp): a row for each bucket; kind numbers the set of equal bits, key holds their values.

    From level 2 on, fps has the kind of the oversized bucket that its row comes from, and only its six refinements apply.
    """
    masks = [_mask(s) for s in _choices(level)]
    all_masks = F.array(*[F.lit(m) for m in masks])
    base = F.lit(0) if level == 1 else F.col("kind") * 6
    nth = F.posexplode(F.slice(all_masks, base + 1, 6)).alias("n", "mask")
    old = F.lit(0).alias("base") if level == 1 else (F.col("kind") * 6).alias("base")
    return fps.select("fp", old, nth).select((F.col("base") + F.col("n")).cast("int").alias("kind"),
        F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _planes(block: np.ndarray) -> np.ndarray:
    """64 words, one per bit, of up to 64 fingerprints: lane j of word b is bit b of fingerprint j."""
    lanes = np.zeros(64, "<u8")
    lanes[: len(block)] = block
    bits = np.unpackbits(lanes.view(np.uint8).reshape(64, 8), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").reshape(-1).view("<u8")


def bit_sliced_links(fps: np.ndarray, starts: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of rows of the same bucket within the radius.  starts: first row of each bucket, and the end.

    Counters saturate at 4, so the radius may be 1 or 2 (3 with all lanes of count 3 kept).
    """
    assert 0 <= radius <= 3
    sizes = np.diff(starts)
    firsts = np.concatenate([np.arange(s, s + n, 64) for s,
        n in zip(starts[:-1], sizes)]) if len(sizes) else np.empty(0, np.int64)
    bucket_of = np.repeat(np.arange(len(sizes)), -(-sizes // 64))
    widths = np.minimum(64, starts[1:][bucket_of] - firsts)
    planes = np.stack([_planes(fps[f : f + w]) for f, w in zip(firsts, widths)],
        axis=1) if len(firsts) else np.empty((64, 0), "<u8")
    # queries against the blocks at or after their own
    of_block, rows = [], []
    for k, (f, w, b) in enumerate(zip(firsts, widths, bucket_of)):
        q = np.arange(starts[b], f + w)
        rows.append(q)
        of_block.append(np.full(len(q), k))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if rows:
        rows, of_block = np.concatenate(rows), np.concatenate(of_block)
        for at in range(0, len(rows), 1 << 18):
            q, blk = rows[at : at + (1 << 18)], of_block[at : at + (1 << 18)]
            ones = np.zeros(len(q), np.uint64)
            twos, over = ones.copy(), ones.copy()
            full = np.uint64(0xFFFFFFFFFFFFFFFF)
            dead = full << widths[blk].astype(np.uint64)  # lanes without a fingerprint
            dead = np.where(widths[blk] == 64, np.uint64(0), dead)
            value = fps[q]
            for bit in range(64):
                if bit % 8 == 7:  # abandon the blocks whose lanes all exceed the radius
                    alive = (_exceed(ones, twos, over, radius) | dead) != full
                    if not alive.all():
                        q, blk, ones, twos, over, dead, value = (x[alive]
                            for x in (q, blk, ones, twos, over, dead, value))
                diff = planes[bit][blk] ^ (np.uint64(0) - ((value >> np.uint64(bit)) & np.uint64(1)))
                carry = ones & diff
                ones = ones ^ diff
                over = over | (twos & carry)
                twos = twos ^ carry
            near = ~(_exceed(ones, twos, over, radius) | dead)
            hit = np.flatnonzero(near)
            lanes = np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, lane = np.nonzero(lanes)
            i, j = q[hit][r], firsts[blk[hit][r]] + lane
            left.append(i[i < j])
            right.append(j[i < j])
    return np.concatenate(left), np.concatenate(right)


def _exceed(ones: np.ndarray, twos: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    return (over | (ones | twos), over | twos, over | (ones & twos), over)[radius]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the least row linked to it, over any number of links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets arrive in order; for each, the edges of a spanning forest of its links."""

    def edges(kind, key, fp):
        new = np.ones(len(fp), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (key[1:] != key[:-1])
        starts = np.append(np.flatnonzero(new), len(fp))
        many = np.diff(starts) > 1
        rows = np.concatenate([np.arange(a, b) for a,
            b in zip(starts[:-1][many], starts[1:][many])]) if many.any() else np.empty(0, np.int64)
        if not len(rows):
            return None
        own = fp[rows]
        root = _forest(len(own), *bit_sliced_links(own.view(np.uint64),
            np.concatenate([[0], np.cumsum(np.diff(starts)[many])])))
        moved = root != np.arange(len(own))
        return pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[root[moved]])], names=["a", "b"])

    held = [np.empty(0, np.int64)] * 3
    for batch in batches:
        now = [np.concatenate([h, batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for k,
            h in enumerate(held)]
        if not len(now[0]):
            continue
        last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])  # its bucket may go on in the next batch
        held = [x[last] for x in now]
        if (out := edges(*(x[~last] for x in now))) is not None:
            yield out
    if len(held[0]) and (out := edges(*held)) is not None:
        yield out


def links(classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) edges that connect exactly the fingerprints connected by links; classes has one row per distinct fp."""
    found = []
    part = classes.select("fp")
    for level in (1, 2, 3):
        keyed = written(_keyed(part, level), f"keys-{level}")
        if level < 3:
            large = written(keyed.groupBy("kind", "key").count().where(F.col("count") > bucket).select("kind", "key"),
                f"large-{level}")
            any_large = not large.isEmpty()
        else:
            any_large = False
        usual = keyed.join(large, ["kind", "key"], "left_anti") if any_large else keyed
        n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found.append(usual.select("kind", "key", "fp").repartition(n, "kind", "key").sortWithinPartitions("kind",
            "key").mapInArrow(_compare, "a long, b long"))
        if not any_large:
            break
        part = written(keyed.join(large, ["kind", "key"], "left_semi").select("kind", "fp"), f"dense-{level}")
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs; component_id is the least doc_id reachable by links.

    Null text counts as no words (fingerprint 0); rows with equal fingerprints are linked; a null doc_id gets a
    component as any other, and never names one unless all ids of its component are null.  Empty input: no rows.
    """
    fps = written(fingerprints(docs), "fps")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(links(classes, bucket))
    rooted = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "rep",
        F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = written(written(rooted, "rooted").join(written(least, "least"), "root").select("fp", "component_id"),
        "named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """docs with one row of each component: that of its least doc_id; columns as they came.

    Where that doc_id comes more than once, one of its rows stays.  A component whose ids are all null keeps one row.
    """
    found = near_duplicates(docs, bucket)
    own = found.where("doc_id <=> component_id")
    named = written(own.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")), "kept")
    mark = next(n for n in ("simhash_copies" + "_" * k for k in range(1000)) if n not in docs.columns)
    # the ids to keep grow with the corpus: they meet the texts in a shuffle at every size, never by broadcast
    kept = docs.join(named.withColumnRenamed("copies", mark).hint("merge"), "doc_id")
    out = kept.where(F.col(mark) == 1)
    if not named.where("copies > 1").isEmpty():
        out = out.union(kept.where(F.col(mark) > 1).dropDuplicates(["doc_id"]))
    out = out.select(*docs.columns)
    if not own.where("doc_id is null").isEmpty():  # their text tells such rows apart, by fingerprint
        lost = written(docs.where("doc_id is null").withColumn("doc_id", F.monotonically_increasing_id()), "unnamed")
        fps = fingerprints(lost).join(own.where("doc_id is null").select("fp").distinct(), "fp")
        alone = fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
        out = out.union(lost.join(alone, "doc_id").withColumn("doc_id",
            F.lit(None).cast(docs.schema["doc_id"].dataType)).select(*docs.columns))
    return out
