"""Sharding by extendible hashing, in DataFrame functions.

Rows are addressed by the leading bits of a 60-bit hash of their key.  A bucket of depth d holds the rows that agree
on d bits; only a bucket above the byte limit splits, on one more bit.  So the shard of a row is its shallowest
bucket that fits, or that holds a single hash.  Bytes are summed once in cells of a few more bits than the
limit needs (map-side combine; the cells are few against the rows); cells still too large are summed again, six
bits deeper, for their rows alone; all shallower buckets are sums of cells.

Equal keys cannot be told apart by their hash.  Rows of such a shard that is too large get a second hash, of key and
row number, and go through the same procedure together; only a single row above the limit stays `oversized`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import written

BITS, STEP, SHARD_BYTES = 60, 6, 256 << 20
QUERY_BYTES = 1 << 20  # of the query, whose tables are small


def hash60(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column) -> Column:
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def _cells(rows: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, n, lo, hi): disjoint cells that hold all rows; a cell above the limit has one hash."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    bits = min(BITS, max(0, math.ceil(math.log2(max(total / limit, 1)))) + 2)
    found, part = [], rows.select("h", "n_bytes")
    while True:
        at = F.lit(bits)
        cells = written(part.groupBy(_prefix(F.col("h"), at).alias("prefix")).agg(F.sum("n_bytes").alias("bytes"),
            F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).withColumn("depth", at),
            f"cells-{bits}")
        split = (F.col("bytes") > limit) & (F.col("lo") < F.col("hi"))
        large = cells.where(split)
        if bits >= BITS or large.isEmpty():
            found.append(cells)
            break
        found.append(cells.where(~split))
        part = written(part.withColumn("prefix", _prefix(F.col("h"), at)).join(large.select("prefix"), "prefix",
            "left_semi").drop("prefix"), f"dense-{bits}")
        bits = min(BITS, bits + STEP)
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def directory(cells: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, n, lo, hi) of the shards that hold the cells."""
    up = F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("d")
    over = cells.select("*", up).select(
        F.col("d").alias("depth"), F.call_function("shiftright", F.col("prefix"),
        (F.col("depth") - F.col("d")).cast("int")).alias("prefix"), "bytes", "n", "lo", "hi")
    nodes = written(over.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi")), "nodes")
    splits = (F.col("bytes") > limit) & (F.col("lo") < F.col("hi"))
    parents = nodes.where(splits).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    own = nodes.where(~splits)
    below = own.where("depth > 0").withColumn("parent", F.call_function("shiftright", "prefix", F.lit(1))).join(parents,
        ["depth", "parent"], "left_semi").drop("parent")
    return written(own.where("depth = 0").unionByName(below), "directory")


def _assign(rows: DataFrame, limit: int) -> DataFrame:
    """rows with depth, prefix, bytes, n, lo, hi of their shard.

    Cells, few against the rows, are joined to their shard first; a row then meets its cell.  Nearly all cells have one
    depth, so a row is looked up once, and once more for each depth at which dense cells were counted again.
    """
    cells = written(_cells(rows, limit), "cells")
    shards = directory(cells, limit)
    depths = sorted(r.depth for r in shards.select("depth").distinct().collect())  # at most 61
    if not depths:
        return rows.withColumns({"depth": F.lit(0), "prefix": F.lit(0).cast("long"), "bytes": F.lit(0).cast("long"),
            "n": F.lit(0).cast("long"), "lo": F.lit(0).cast("long"), "hi": F.lit(0).cast("long")})
    cell_depths = sorted(r.depth
        for r in cells.select("depth").distinct().collect())  # the first, and some six bits deeper each
    up = cells.select(F.col("depth").alias("cell_depth"), F.col("prefix").alias("cell"),
        F.explode(F.array(*[F.lit(d) for d in depths])).alias("depth")).where("depth <= cell_depth")
    placed = up.withColumn("prefix", F.call_function("shiftright", F.col("cell"),
        (F.col("cell_depth") - F.col("depth")).cast("int"))).join(shards, ["depth", "prefix"])
    named = written(placed, "cell-shards")
    keyed = rows.withColumn("cell_depth", F.explode(F.array(*[F.lit(d) for d in cell_depths]))).withColumn("cell",
        _prefix(F.col("h"), F.col("cell_depth")))
    return keyed.join(named, ["cell_depth", "cell"]).drop("cell_depth", "cell")


def shard(docs: DataFrame, key: str = "doc_id", limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes (UTF-8 bytes of text), shard, shard_depth, shard_bytes, shard_docs, oversized; for every row.

    Null text has 0 bytes; null keys hash as the word null; repeated keys share a shard while it fits.
    shard names its bits as depth:prefix, those of the second hash after salted/.  Empty input: no rows.
    """
    k = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    sized = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        hash60(k).alias("h"))
    rows = written(sized.withColumn("row", F.monotonically_increasing_id()), "sized")
    found = written(_assign(rows, limit), "sharded")
    name = lambda p="": F.concat_ws(":", F.col(f"{p}depth").cast("string"),
        F.col(f"{p}prefix").cast("string"))
    cols = lambda df, label, depth: df.select("doc_id", "n_bytes", label.alias("shard"), depth.alias("shard_depth"),
        F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_docs"),
        (F.col("bytes") > limit).alias("oversized"))
    stubborn = (F.col("bytes") > limit) & (F.col("n") > 1)
    out = cols(found.where(~stubborn), name(), F.col("depth"))
    same = found.where(stubborn).select("doc_id", "n_bytes", "h", "row")
    if not same.isEmpty():
        again = written(same, "stubborn").withColumn("h",
            hash60(F.concat_ws("#", F.col("h").cast("string"), F.col("row").cast("string"))))
        out = out.union(cols(_assign(again, limit), F.concat_ws("/", F.lit("salted"), name()), F.col("depth")))
    return out


SHARD_SQL = f"""
WITH r AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h FROM documents),
e AS (SELECT *, h >> (60 - d) AS p FROM r, (SELECT unnest(range(0, 61)) AS d) t),
n AS (SELECT d, p, sum(n_bytes) AS b, count(*) AS c, min(h) AS lo, max(h) AS hi FROM e GROUP BY d, p),
f AS (SELECT doc_id, n_bytes, h, min(e.d) AS d FROM e JOIN n ON e.d = n.d AND e.p = n.p
      WHERE n.b <= {QUERY_BYTES} OR n.lo = n.hi GROUP BY doc_id, n_bytes, h)
SELECT doc_id, n_bytes, concat(f.d, ':', h >> (60 - f.d)) AS shard, CAST(f.d AS INTEGER) AS shard_depth,
       CAST(n.b AS BIGINT) AS shard_bytes, n.c AS shard_docs, n.b > {QUERY_BYTES} AS oversized
FROM f JOIN n ON f.d = n.d AND h >> (60 - f.d) = n.p
"""
