"""Gates and checks.  Each gives findings: (subject, check_id, severity, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.operators.shared import written

SEVERITIES = ("ok", "review", "fail")


def findings(df: DataFrame, subject: Column, check: str, severity: Column | str, detail: Column,
        *more: Column) -> DataFrame:
    """Findings, with more columns behind the four where a check has them."""
    s = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(subject.cast("string").alias("subject"), F.lit(check).alias("check_id"), s.alias("severity"),
        detail.cast("string").alias("detail"), *more)


def all_findings(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def roll_up(found: DataFrame, by: list[str]) -> DataFrame:
    """Worst severity and counts by severity: fail over review over ok."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    counts = [F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in SEVERITIES]
    return found.groupBy(*by).agg(F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]),
        F.max(rank).cast("int")).alias("status"), *counts)


def mark_sums(parts: DataFrame, printed: DataFrame, key: str, marks: str, total: str) -> DataFrame:
    """Sum of part marks against the printed total: fail if all are known and differ, review if some are null."""
    g = parts.groupBy(key).agg(F.sum(marks).alias("sum"), F.count(marks).alias("known"), F.count(F.lit(1)).alias("n"))
    joined = g.join(printed.select(key, total), key)
    severity = F.when(F.col("known") < F.col("n"), "review").when(F.col("sum") != F.col(total), "fail").otherwise("ok")
    return findings(joined, F.col(key), "mark_sum", severity, F.concat_ws("/", "sum", total))


def continuity(df: DataFrame, key: str, number: str) -> DataFrame:
    """Whether the numbers of a key are exactly 1 to n, each once."""
    g = df.groupBy(key).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.count(F.lit(1)).alias("n"),
        F.countDistinct(number).alias("d"))
    return g.select(key, "n", (F.col("n") - F.col("d")).alias("n_repeats"),
        (F.col("hi") - F.col("d")).alias("n_missing"),
        ((F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("d") == F.col("n"))).alias("continuous"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def dangling(df: DataFrame, keys: list[str], of: DataFrame) -> DataFrame:
    """Rows of df whose keys `of` lacks (rows with a null key are not dangling)."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).join(of.select(*keys).distinct(), keys, "left_anti")


def changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, change, columns): added, removed or changed rows, and which columns differ (null-safe)."""
    o = old.select(F.col(key), F.struct(*columns).alias("_o"))
    n = new.select(F.col(key), F.struct(*columns).alias("_n"))
    differ = F.array_compact(F.array(*[F.when(~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}")), F.lit(c))
        for c in columns]))
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").otherwise("changed")
    both = o.join(n, key, "full_outer").withColumn("change", change).withColumn("columns",
        F.when(F.col("change") == "changed", F.array_join(differ, ",")).otherwise(""))
    return both.where((F.col("change") != "changed") | (F.col("columns") != "")).select(key, "change", "columns")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def grounded(df: DataFrame, tokens: Column, allowed: Column) -> DataFrame:
    """df with the tokens that the allowed ones lack; grounded if there are none."""
    out = df.withColumn("ungrounded", F.array_sort(F.array_except(tokens, allowed)))
    return out.withColumn("grounded", F.size("ungrounded") == 0)


def bijection(left: DataFrame, right: DataFrame, key: str, order_left: str, order_right: str) -> DataFrame:
    """(key, n_matched, n_left, n_right): the i-th of one side meets the i-th of the other."""
    number = lambda df, o: df.withColumn("_i", F.row_number().over(W.partitionBy(key).orderBy(o))).select(key,
        "_i")
    a, b = number(left, order_left).withColumn("_a", F.lit(1)), number(right, order_right).withColumn("_b", F.lit(1))
    return a.join(b, [key, "_i"], "full_outer").groupBy(key).agg(F.count_if(F.col("_a").isNotNull()
        & F.col("_b").isNotNull()).alias("n_matched"), F.count_if(F.col("_b").isNull()).alias("n_left"),
        F.count_if(F.col("_a").isNull()).alias("n_right"))


def batches(df: DataFrame, key: list[str], order: str, size: int = 400) -> DataFrame:
    """df with batch: rows of a key numbered in order, `size` to a batch.

    Rows are dealt in ranges of key and order, so a key with many rows is spread over many partitions.  A row's number
    is its place in its partition, less the key's first place there, plus what earlier partitions hold of the key.
    """
    names = {c: f"_{c}_" + "_" * sum(x.startswith(f"_{c}_") for x in df.columns)
        for c in ("part", "at", "first", "before")}
    part, at, first, before = names.values()
    dealt = df.repartitionByRange(*key, order).sortWithinPartitions(*key, order)
    placed = written(dealt.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()),
        "dealt")
    held = placed.groupBy(*key, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(before))
    ahead = held.withColumn(before,
        F.coalesce(F.sum(before).over(W.partitionBy(*key).orderBy(part).rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0)))
    null_safe = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*key, part]]
    joined = placed.alias("a").join(ahead.alias("b"), null_safe)
    return joined.select(*[F.col(f"a.{c}") for c in df.columns],
        F.floor((F.col(f"b.{before}") + F.col(f"a.{at}") - F.col(f"b.{first}")) / size).cast("int").alias("batch"))


def capped_sum(df: DataFrame, key: str, marks: str, pool: Column, cap: int) -> DataFrame:
    """(key, closable): marks outside the pools plus, for each pool, the least of its marks and the cap."""
    g = df.groupBy(key, pool.alias("_pool")).agg(F.sum(marks).alias("_s"))
    own = F.when(F.col("_pool").isNull(), F.col("_s")).otherwise(F.least(F.col("_s"), F.lit(cap)))
    return g.groupBy(key).agg(F.sum(own).alias("closable"))


def recover_missing(df: DataFrame, printed: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """(key, recovered): where exactly one value of a key is null, the total less the others, if that is positive."""
    g = df.groupBy(key).agg(F.count_if(F.col(value).isNull()).alias("_m"),
        F.coalesce(F.sum(value), F.lit(0)).alias("_s")).where("_m = 1")
    return g.join(printed.select(key, total), key).select(key,
        (F.col(total) - F.col("_s")).alias("recovered")).where("recovered > 0")
