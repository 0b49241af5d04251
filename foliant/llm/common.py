"""Helpers that several training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.perdoc import portions
from foliant.operators.shared import shared_dir, written

__all__ = ["BLANK", "free", "let", "portions", "shared_dir", "table", "texts", "words", "written"]

#: White space of the word rule: space and the five ASCII controls 9 to 13.
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in the types that the Arrow functions declare."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def free(name: str, taken: list[str]) -> str:
    """The name, with as many underscores behind it as it takes to be none of the taken ones."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also where lambdas inside body mention it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text as an array (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")
