"""Bodies of revision notes: elements, pipe tables, inline mathematics."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import inline_math_count
from foliant.operators.perdoc import per_document

# Line formats of note bodies.
FORMATS = (
    ("heading", re.compile(r"(#{1,6})\s+(.+?)\s*")), ("figure", re.compile(r"!\[([^\]]*)\]\(([^)\s]+)\)\s*")),
    ("quote", re.compile(r">\s?(.*)")), ("list_item", re.compile(r"[-*]\s+(.+)")),
)
TABLE_ROW = re.compile(r"\|.*\|\s*")
TABLE_RULE = re.compile(r"\|(\s*:?-{3,}:?\s*\|)+\s*")
SPEC_POINT = "**Spec point**"

ELEMENTS = "doc_id string, ord int, element_id string, kind string, level int, text string, rows array<array<string>>, url string, alt string, source_name string, format string, spec_point boolean"


def parse(body: str | None) -> list[dict]:
    """Elements of a body: lines that are nothing else run on as a paragraph until a blank or another line."""
    out: list[dict] = []
    run: list[str] = []
    table: list[str] = []

    def add(kind: str, text: str | None = None, **more) -> None:
        out.append({"ord": len(out), "element_id": f"e{len(out):06d}", "kind": kind, "text": text, "spec_point": False} | more)

    def flush() -> None:
        if table:
            add("table", rows=[[c.strip() for c in t.strip().strip("|").split("|")] for t in table
                if not TABLE_RULE.fullmatch(t)])
            table.clear()
        if run:
            add("paragraph", "\n".join(run))
            run.clear()

    for raw in (body or "").split("\n"):
        line = raw.strip()
        if TABLE_ROW.fullmatch(line):
            if run:
                flush()
            table.append(line)
            continue
        if table or not line:
            flush()
        if not line:
            continue
        kind, m = next(((k, m) for k, rx in FORMATS if (m := rx.fullmatch(line))), ("", None))
        if m is None:
            run.append(line)
            continue
        flush()
        if kind == "heading":
            add("heading", m[2], level=len(m[1]))
        elif kind == "figure":
            name = re.split(r"[/\\]", m[2])[-1]
            add("figure", url=m[2], alt=m[1], source_name=name or m[2], format=name.rsplit(".", 1)[1] if "." in name
                and not name.endswith(".") else None)
        elif kind == "quote":
            add("paragraph", m[1], spec_point=SPEC_POINT in m[1])
        else:
            add("list_item", m[1])
    flush()
    return out


def elements(notes: DataFrame, key: str, body: str = "body") -> DataFrame:
    return per_document(notes, [F.col(key).cast("string"), body], lambda k, t: ({"doc_id": k} | r for r in parse(t)),
        ELEMENTS)


def statistics(notes: DataFrame, key: str, body: str = "body") -> DataFrame:
    """(key, inline_math, spec_points) of each body."""
    found = elements(notes, key,
        body).groupBy(F.col("doc_id").alias(key)).agg(F.count_if("spec_point").alias("spec_points"))
    return notes.select(F.col(key).cast("string").alias(key),
        inline_math_count(F.col(body)).alias("inline_math")).join(found, key, "left").withColumn("spec_points",
        F.coalesce("spec_points", F.lit(0)))
