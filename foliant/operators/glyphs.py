"""Glyph tables: normalising, census, accounting, guarded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as t


def check_table(table: dict[str, str]) -> list[str]:
    """What is wrong with a glyph table: empty keys, keys mapped to themselves, values that hold a key."""
    out = [f"empty key -> {v!r}" for k, v in table.items() if not k] + [f"{k!r} maps to itself" for k,
        v in table.items() if k and k == v]
    return out + [f"value of {k!r} holds the key {x!r}" for k, v in sorted(table.items()) for x in sorted(table) if k
        and x and k != v and x in v]


def normalise(df: DataFrame, column: str, table: dict[str, str]) -> DataFrame:
    """df with the column normalised and n_changed, how many characters the text lost or gained."""
    mapped = t.map_chars(F.col(column), table)
    return df.withColumn("_m", mapped).withColumn("length_delta", F.length("_m") - F.length(column)).withColumn(column,
        F.col("_m")).drop("_m")


def idempotent(df: DataFrame, column: str, table: dict[str, str]) -> DataFrame:
    """Rows that a second pass would change."""
    once = df.withColumn("_a", t.map_chars(F.col(column), table))
    return once.withColumn("_b", t.map_chars(F.col("_a"), table)).where("_a <> _b").drop("_a", "_b")


def census(df: DataFrame, key: str, column: str, table: dict[str, str] | None = None) -> DataFrame:
    """(key, kind, code_point, n): private-use characters that the table lacks, and controls."""
    kinds = F.array(F.struct(F.lit("private").alias("kind"), t.private_use(F.col(column)).alias("cs")),
        F.struct(F.lit("control").alias("kind"), t.controls(F.col(column)).alias("cs")))
    rows = df.select(F.col(key).alias("_key"), F.explode(kinds).alias("_kind")).select("_key", "_kind.kind",
        F.explode("_kind.cs").alias("c"))
    known = [k for k in (table or {}) if len(k) == 1]
    left = rows.where(~F.col("c").isin(*known)) if known else rows
    return left.groupBy(F.col("_key").alias(key), "kind",
        F.ascii("c").alias("code_point")).agg(F.count(F.lit(1)).alias("n"))


def gate(df: DataFrame, key: str, column: str, batch: Column) -> DataFrame:
    """(batch, n_texts, n_artifacts, passed, failed): a batch passes if no text has an artifact; failed lists keys."""
    n = F.size(t.private_use(F.col(column))) + F.size(t.controls(F.col(column)))
    rows = df.select(batch.alias("batch"), F.col(key).alias("k"), n.alias("n"))
    return rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_artifacts"),
        (F.sum("n") == 0).alias("passed"), F.array_sort(F.collect_list(F.when(F.col("n") > 0,
        F.col("k")))).alias("failed"))


def accounting(df: DataFrame, column: str, table: dict[str, str]) -> DataFrame:
    """(glyph, kind, n): how often each key of the table is used, the longest key first as the normaliser takes them."""
    keys = sorted(table, key=lambda k: (-len(k), k))
    found = F.regexp_extract_all(F.col(column), F.lit("|".join(r"\Q" + k + r"\E" for k in keys)), F.lit(0))
    kind = F.when(F.length("glyph") > 1, "sequence").when(F.col("glyph").isin([k for k in keys if table[k] == ""]
        or [""]), "drop").otherwise("substitution")
    return df.select(F.explode(found).alias("glyph")).groupBy("glyph").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", kind)


def guarded_update(current: DataFrame, snapshot: DataFrame, update: DataFrame, key: str,
        column: str) -> tuple[DataFrame, DataFrame]:
    """(updated rows, conflicts): a row is updated only if it still has the content of the snapshot.

    update has key and new content.  Rows that no longer match are conflicts and stay as they are.
    """
    old = snapshot.select(key, F.col(column).alias("_old"))
    new = update.select(key, F.col(column).alias("_new"))
    joined = current.join(old.join(new, key), key, "left")
    same = F.col(column).eqNullSafe(F.col("_old"))
    out = joined.withColumn(column, F.when(F.col("_new").isNotNull() & same,
        F.col("_new")).otherwise(F.col(column))).select(*current.columns)
    return out, joined.where(F.col("_new").isNotNull() & ~same).select(key)


def control_group(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """n rows by a seeded hash of the key: the same rows on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def rendered(text: Column, table: dict[str, str], dropped: list[str], furniture: list[str] | None = None) -> Column:
    """struct(text, n_dropped, loss) of one block as it is shown: mapped, without the glyphs that cannot be.

    Blocks that are null, blank or furniture show nothing and lose nothing; loss tells that glyphs went.
    """
    bare = t.strip(F.coalesce(text, F.lit("")))
    shown = F.when(bare.isin(*(furniture or [""])), F.lit("")).otherwise(bare)
    quoted = "[" + "".join(rf"\x{{{ord(c):X}}}" for c in dropped) + "]" if dropped else "(?!)"
    n = F.regexp_count(shown, F.lit(quoted)).cast("int")
    kept = F.translate(F.regexp_replace(shown, quoted, ""), "".join(table),
        "".join(table.values())) if all(len(k) == len(v) == 1 for k,
        v in table.items()) else t.map_chars(F.regexp_replace(shown, quoted, ""), table)
    return F.struct(t.strip(kept).alias("text"), n.alias("n_dropped"), (n > 0).alias("loss"))


def post_gates(before: DataFrame, after: DataFrame, expected: DataFrame, control: DataFrame, key: str,
        column: str) -> DataFrame:
    """(key, problem) after an update: glyphs that are left, rows lost or come anew, rows that are not as expected, and
    rows of the control group (keys) that changed at all."""
    b, a = (df.select(key, F.col(column).alias(n)) for df, n in ((before, "old"), (after, "new")))
    both = b.withColumn("ib", F.lit(True)).join(a.withColumn("ia", F.lit(True)), key, "full_outer")
    want = expected.select(key, F.col(column).alias("want"), F.lit(True).alias("iw"))
    held = both.join(want, key, "left").join(control.select(key).distinct().withColumn("ic", F.lit(True)), key, "left")
    left = F.size(t.private_use(F.coalesce("new", F.lit("")))) + F.size(t.controls(F.coalesce("new", F.lit(""))))
    same = F.col("old").eqNullSafe(F.col("new"))
    checks = [
        (F.col("ia").isNull(), "lost"), (F.col("ib").isNull(), "new"),
        (F.col("ia").isNotNull() & (left > 0), "residual"),
        (F.col("iw") & ~F.col("want").eqNullSafe(F.col("new")), "unexpected"),
        (F.col("iw").isNull() & F.col("ia").isNotNull() & F.col("ib").isNotNull() & ~same, "unplanned"),
        (F.col("ic") & ~same, "control")]
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for c, n in checks]))
    return held.select(key, F.explode(found).alias("problem"))
