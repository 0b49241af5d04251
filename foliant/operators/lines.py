"""Lines of documents, islands of lines, and carry-forward."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def explode_lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    r"""(key, line_no, raw): a row for each \n-line, trailing empty ones kept, one \r at the end taken off."""
    return docs.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "raw")).withColumn("raw",
        F.regexp_replace("raw", "\r$", ""))


def carry_forward(df: DataFrame, key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The last value that is not null, of this row or an earlier one of the same key."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.last_value(value, F.lit(True)).over(w))


def islands(df: DataFrame, key: str, order: list[str], opens: Column, name: str = "island") -> DataFrame:
    """Number of rows so far that open an island; 0 before the first."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(opens, 1).otherwise(0)).over(w))


def split_lines(text: Column) -> Column:
    r"""Lines of a text as explode_lines gives them."""
    return F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, "\r$", ""))


def sections(docs: DataFrame, key: str, heading: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """(key, section, heading, first_line, n_lines, body): a heading opens a section, later lines belong to it.

    heading(line) tells headings.  Lines before the first heading and blank lines are left out; a heading without lines
    has an empty body.  A document's sections are made in its row: nothing is shuffled.
    """
    held = docs.select(key, split_lines(F.col(text)).alias("_lines")).withColumn("_at",
        F.filter(F.transform("_lines", lambda x, i: F.when(heading(x), i)), lambda i: i.isNotNull()))

    def one(at: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_at", k + 1), F.size("_lines"))
        body = F.filter(F.slice("_lines", at + 2, end - at - 1), lambda x: F.trim(x) != "")
        return F.struct((k + 1).cast("long").alias("section"), F.get("_lines", at).alias("heading"),
            at.alias("first_line"), F.size(body).cast("long").alias("n_lines"), F.array_join(body, "\n").alias("body"))

    return held.select(key, F.explode(F.transform("_at", one)).alias("s")).select(key, "s.*")


def greedy_sequence(df: DataFrame, key: str, order: list[str], number: str) -> DataFrame:
    """(key, accepted): the numbers that a gate lets through in order: first 1, then each the one after the last.

    An ordered fold per key; a key is one document's numbered lines.
    """
    rows = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(number).cast("long").alias("_n")))),
        lambda x: x._n)
    grouped = df.groupBy(key).agg(rows.alias("_all"))
    last = F.aggregate("_all", F.lit(0).cast("long"), lambda s, x: F.when(x == s + 1, x).otherwise(s))
    return grouped.select(key, F.size("_all").cast("long").alias("n_lines"), last.alias("accepted"))


def pack_chunks(df: DataFrame, key: str, order: list[str], tokens: Column, target: int = 300, most: int = 800,
        group: str | None = None) -> DataFrame:
    """df with chunk: rows of a key packed greedily in order.

    A row above `most` stands alone; a chunk is closed when the next row would take it past `target`, or, with a
    group column, when that changes (a null group never closes one).
    """
    g = F.col(group) if group else F.lit(0)
    whole = F.struct(*[F.col(c) for c in df.columns])
    items = F.array_sort(F.collect_list(F.struct(*order, tokens.cast("int").alias("_t"), g.alias("_g"),
        whole.alias("_row"))))
    grouped = df.groupBy(key).agg(items.alias("_items"))

    @F.pandas_udf("array<int>")
    def chunks(tokens: pd.Series, groups: pd.Series) -> pd.Series:
        def pack(ts, gs) -> list[int]:
            out, chunk, held, alone, last = [], 0, 0, False, None
            for n, own in zip(ts, gs):
                large = n > most
                opens = chunk == 0 or large or alone or held + n > target or (last is not None and own is not None
                    and last != own)
                chunk, held = chunk + opens, n if opens else held + n
                alone, last = large, own
                out.append(chunk)
            return out

        return pd.Series([pack(ts, gs) for ts, gs in zip(tokens, groups)])

    folded = grouped.withColumn("_chunks", chunks(F.transform("_items", lambda x: x._t),
        F.transform("_items", lambda x: x._g.cast("string"))))
    rows = folded.select(F.explode(F.arrays_zip(F.col("_items._row").alias("row"),
        F.col("_chunks").alias("chunk"))).alias("z"))
    return rows.select("z.row.*", "z.chunk")
