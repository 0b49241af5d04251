"""Parsers by media type: files in, elements of one shape out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import markdown, notes
from foliant.sources import readers

#: Columns that the elements of every parser have.
COLUMNS = ("doc_id", "ord", "element_id", "kind", "level", "text")


def _shaped(found: DataFrame) -> DataFrame:
    return found.select(F.col("doc_id").cast("string").alias("doc_id"), "ord", "element_id", "kind", "level", "text")


def _note_elements(docs: DataFrame) -> DataFrame:
    return notes.elements(readers.notes(docs, "doc_id"), "doc_id")


#: media type -> (doc_id, text) to elements.
PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "text/markdown": lambda docs: markdown.elements(docs),
    "application/json": lambda docs: readers.engine_json(docs, "doc_id", "text"),
    "text/x-revision-note": _note_elements,
}


def supports(mime: str) -> bool:
    return mime in PARSERS


def media_type(path: Column) -> Column:
    """By a file's ending; a markdown file in a folder named notes is a revision note."""
    ending = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    note = path.rlike(r"/notes/[^/]+$")
    return F.when(ending.isin("md", "markdown"),
        F.when(note, "text/x-revision-note").otherwise("text/markdown")).when(ending == "json",
        "application/json").otherwise("application/octet-stream")


def parse(files: DataFrame, parsers: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> tuple[DataFrame,
        DataFrame]:
    """(elements, files set aside) of (path, mime, content): each file goes to the parser of its media type.

    A document's id comes from its content, so copies are read once for each media type.
    """
    table = PARSERS if parsers is None else parsers
    docs = markdown.with_id(files)
    out = None
    for mime, f in table.items():
        own = docs.where(F.col("mime") == mime).select("doc_id", "text").dropDuplicates(["doc_id"])
        found = _shaped(f(own))
        out = found if out is None else out.union(found)
    return out, files.where(~F.coalesce(F.col("mime").isin(*table), F.lit(False))).select("path", "mime",
        F.lit("no parser").alias("reason"))


def identified(files: DataFrame, extracted_at: str | None = None) -> DataFrame:
    """files with their identity and extracted_at: now, or the time that is given, so that a run can be repeated to the byte."""
    at = F.current_timestamp() if extracted_at is None else F.lit(extracted_at).cast("timestamp")
    return markdown.with_id(files).withColumn("extracted_at", at)


def second_opinion(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, elements..) that another engine left as JSON files below path, one for each document, named by it."""
    found = readers.files(spark, path, "*.json")
    docs = found.select(F.regexp_replace(readers.base_name(F.col("path")), r"\.json$", "").alias("doc_id"),
        F.decode("content", "UTF-8").alias("json"))
    return readers.engine_json(docs, "doc_id")
