"""Digests, deterministic ids, media types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(x: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)^\s+|\s+$", ""))


def document_id(checksum: Column, engine: Column, version: Column) -> Column:
    """A name-based id: SHA-256 of the three cleaned parts, first 128 bits, version 5 and the RFC variant set."""
    h = F.sha2(F.concat(F.lit("sha256:"), clean(checksum), F.lit("|engine:"), clean(engine), F.lit("|version:"),
        clean(version)), 256)
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def base62(digest: Column, digits: int = 22) -> Column:
    """First 128 bits of a hex digest in base 62, by long division in four 32-bit limbs."""
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    limbs = F.transform(F.array(*[F.lit(1 + 8 * i) for i in range(4)]),
        lambda p: F.conv(F.substring(digest, p, F.lit(8)), 16, 10).cast("long"))
    start = F.struct(limbs.alias("n"), F.lit("").alias("out"))

    def divide(state: Column, _: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("r"), F.array().cast("array<bigint>").alias("q"))
        step = F.aggregate(state.n, zero, lambda s, x: F.struct(((s.r * (1 << 32) + x) % 62).alias("r"),
            F.concat(s.q, F.array(F.expr("0L") + F.floor((s.r * (1 << 32) + x) / 62))).alias("q")))
        exact = lambda s: F.struct(s.q.alias("n"), F.concat(F.substring(F.lit(alphabet), (s.r + 1).cast("int"),
            F.lit(1)), state.out).alias("out"))
        return F.element_at(F.transform(F.array(step), exact), 1)

    done = F.aggregate(F.sequence(F.lit(1), F.lit(digits)), start, divide)
    return F.coalesce(F.nullif(F.regexp_replace(done.getField("out"), "^0+", ""), F.lit("")), F.lit("0"))


def mime(content: Column) -> Column:
    """Media type of an image by its first bytes; null if none fits."""
    h = F.hex(F.substring(content, 1, 12))
    return (F.when(h.startswith("89504E470D0A1A0A"), "image/png").when(h.startswith("FFD8FF"), "image/jpeg")
            .when(h.startswith("474946383761") | h.startswith("474946383961"), "image/gif").when(h.startswith("424D"),
            "image/bmp")
            .when(h.startswith("52494646") & (F.substring(h, 17, 8) == "57454250"), "image/webp"))


def size_of_image(content: Column) -> Column:
    """struct(width, height) from the header of PNG, GIF and BMP images; null for others."""
    number = lambda start, order: F.conv(F.concat(*[F.hex(F.substring(content, start + k, 1)) for k in order]), 16,
        10).cast("int")
    kind = mime(content)
    pair = lambda w, h: F.struct(w.alias("width"), h.alias("height"))
    return (F.when(kind == "image/png", pair(number(17, range(4)), number(21, range(4))))
            .when(kind == "image/gif", pair(number(7, (1, 0)), number(9, (1, 0))))
            .when(kind == "image/bmp", pair(number(19, (3, 2, 1, 0)), number(23, (3, 2, 1, 0)))))


def set_id(ids: Column) -> Column:
    """Digest of a set of ids in order, a line each."""
    return F.sha2(F.array_join(F.array_sort(ids), "\n"), 256)
