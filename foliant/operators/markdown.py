"""Markdown with embedded HTML to elements: headings, list items, paragraphs, tables, figures, equations.

Blocks that lost their end do not swallow the rest: a table keeps its complete rows, an orphan opener is dropped and
what it covered is read as usual; each case is counted.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.identity import document_id
from foliant.functions.text import ENTITIES
from foliant.operators.perdoc import per_document

ENGINE, VERSION = "foliant-markdown", "1"

# The line formats of the source.
HEADING = re.compile(r"(#{1,6})\s+(.+?)\s*")
LIST_ITEM = re.compile(r"[-*]\s+(.+)")
IMAGE = re.compile(r"<div[^>]*>\s*<img\s+src='([^']+)'(?:\s+alt='([^']*)')?\s*/>\s*</div>\s*")
CENTER = re.compile(r"<div\s+align=[\"']center[\"']>\s*")
CENTER_END = re.compile(r"</div>\s*")
FENCE = re.compile(r"\$\$\s*")
SPAN = re.compile(r"\$\$(.+?)\$\$")
ROW = re.compile(r"<tr[^>]*>(.*?)</tr>", re.S)
CELL = re.compile(r"<t[dh][^>]*>(.*?)</t[dh]>", re.S)
TAG = re.compile(r"<[^>]+>")
BREAK = re.compile(r"<br\s*/?>", re.I)
ENTITY = re.compile(r"&#x([0-9a-fA-F]+);|&#(\d+);|&(gt|lt|amp|quot|apos);")
CELL_HTML = re.compile(r"<t[dhr]\b|</t[dhr]>")
OPERATORS = re.compile(r"[+=]|\\rightarrow|\\quad|\\mathrm|\\%")
LABEL = re.compile(r"\([a-h]\)\s|\([ivx]+\)\s")
STEM = re.compile(r"\d{1,2}\s+[A-Za-z]{3,}")
TOTAL = re.compile(r"\(?\s*Total for (question|paper)", re.I)

ELEMENTS = "doc_id string, ord int, element_id string, kind string, level int, text string, rows array<array<string>>, url string, alt string, source_name string, format string, line_no int"
_EMPTY = dict.fromkeys(c.split()[0] for c in ELEMENTS.split(", ")[1:])
COUNTERS = ("entity_lines", "signed_urls", "open_tables", "orphan_fences", "open_divs", "mixed_math_lines")


def decode(text: str) -> str:
    """Character references, once; those of no character stay."""

    def one(m: re.Match) -> str:
        if m[3]:
            return ENTITIES[m[3]]
        cp = int(m[1], 16) if m[1] else int(m[2])
        return chr(cp) if cp <= 0x10FFFF and not 0xD800 <= cp <= 0xDFFF else m[0]

    return ENTITY.sub(one, text)


def table_rows(html: str) -> list[list[str]]:
    """Cells of each row; breaks are line feeds, tags go, references are decoded; spans are not expanded."""
    return [[decode(TAG.sub("", BREAK.sub("\n", c))).strip() for c in CELL.findall(r)] for r in ROW.findall(html)]


def outside(line: str) -> bool:
    """Certainly not inside a table or an equation."""
    return line.startswith(("#", "<div", "<table")) or "<img" in line


def ends_math(line: str) -> bool:
    if not line or CELL_HTML.search(line):
        return False
    if outside(line):
        return True
    return not OPERATORS.search(line) and bool(LABEL.match(line) or STEM.fullmatch(line) or TOTAL.match(line))


@dataclass
class Elements:
    """Elements of one document in reading order, and counts of what was odd."""

    rows: list[dict] = field(default_factory=list)
    counts: Counter = field(default_factory=Counter)
    line_no: int = 0

    def add(self, kind: str, text: str | None = None, **more) -> None:
        n = len(self.rows)
        self.rows.append(_EMPTY | {"ord": n, "element_id": f"e{n:06d}", "kind": kind, "text": text,
            "line_no": self.line_no} | more)


def _until(lines: list[str], start: int, closes, stops) -> tuple[int, bool]:
    """First line from start that closes (True) or stops (False) a block; the end of the text stops it."""
    for k in range(start, len(lines)):
        if closes(lines[k]):
            return k, True
        if stops(lines[k]):
            return k, False
    return len(lines), False


def parse(text: str | None) -> Elements:
    """Elements of a text; null and empty texts have none."""
    out = Elements()
    lines = [x.strip() for x in (text or "").split("\n")]
    at = orphans = 0
    while at < len(lines):
        line = out_line = lines[at]
        out.line_no = at
        at += 1
        if not line:
            continue
        if orphans and CENTER_END.fullmatch(line):
            orphans -= 1
        elif m := IMAGE.fullmatch(line):
            out.counts["signed_urls"] += "Signature=" in m[1] and "Expires=" in m[1]
            path = unquote(urlsplit(m[1]).path) or m[1]
            name = path.rsplit("/", 1)[-1]
            out.add("figure", url=m[1], alt=m[2] or "", source_name=name, format=name.rsplit(".", 1)[-1].lower()
                if "." in name else None)
        elif line.startswith("<table"):
            end, closed = (at - 1, True) if "</table>" in line else _until(lines, at, lambda x: "</table>" in x,
                outside)
            last = end if closed else max((k for k in range(at - 1, end) if "</tr>" in lines[k]), default=-1)
            out.counts["open_tables"] += not closed
            if last >= 0:
                html = "\n".join(lines[at - 1 : last + 1])
                out.counts["entity_lines"] += len(ENTITY.findall(html)) > 0
                out.add("table", rows=table_rows(html))
                at = last + 1
        elif CENTER.fullmatch(line):
            end, closed = _until(lines, at, CENTER_END.fullmatch, CENTER.fullmatch)
            if closed:
                for k in range(at, end):
                    out.line_no = k
                    if h := HEADING.fullmatch(lines[k]):
                        out.add("heading", h[2], level=len(h[1]))
                    elif lines[k]:
                        out.add("paragraph", decode(lines[k]))
                at = end + 1
            else:
                out.counts["open_divs"] += 1
                orphans += 1
        elif FENCE.fullmatch(line):
            end, closed = _until(lines, at, FENCE.fullmatch, ends_math)
            if closed:
                out.add("equation", "\n".join(lines[at:end]).strip())
                at = end + 1
            else:
                out.counts["orphan_fences"] += 1
        elif SPAN.search(line) and not SPAN.sub("", line).strip():
            for span in SPAN.findall(line):
                out.add("equation", span.strip())
        else:
            out.counts["mixed_math_lines"] += bool(SPAN.search(line))
            if h := HEADING.fullmatch(line):
                out.add("heading", h[2], level=len(h[1]))
            elif i := LIST_ITEM.fullmatch(line):
                out.add("list_item", i[1])
            else:
                out.counts["entity_lines"] += bool(ENTITY.search(out_line))
                out.add("paragraph", decode(line))
    return out


def with_id(docs: DataFrame, content: str = "content") -> DataFrame:
    """docs with doc_id (from checksum, engine and version) and text (UTF-8) of a binary content column."""
    sha = F.sha2(content, 256)
    return docs.withColumn("checksum", sha).withColumn("doc_id",
        document_id(sha, F.lit(ENGINE), F.lit(VERSION))).withColumn("text", F.decode(content, "UTF-8"))


def elements(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each element of each document, in reading order (ord from 0, element_id of the same number)."""
    return per_document(docs, [F.col(key).cast("string"), text], lambda k,
        t: ({"doc_id": k} | r for r in parse(t).rows), ELEMENTS)


def provenance(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, source_lines, counters): what the parser met in each document."""

    def make(k: str, t: str | None) -> list[dict]:
        return [{"doc_id": k, "source_lines": (t or "").count("\n") + 1} | dict.fromkeys(COUNTERS, 0) | parse(t).counts]

    return per_document(docs, [F.col(key).cast("string"), text], make,
        "doc_id string, source_lines int, " + ", ".join(f"{c} int" for c in COUNTERS))


def sections(found: DataFrame, kinds: tuple[str, ...] = ("paragraph", "list_item"),
        with_heading: bool = False) -> DataFrame:
    """(doc_id, section, heading, level, element_ids): a heading opens a section of the elements up to the next one.

    with_heading also lists the heading, and elements of every kind when kinds is empty.
    """
    from pyspark.sql import Window as W

    w = W.partitionBy("doc_id").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    is_heading = F.col("kind") == "heading"
    member = (F.col("kind").isin(*kinds) if kinds else ~is_heading) | (F.lit(with_heading) & is_heading)
    marked = found.withColumn("section", F.sum(is_heading.cast("int")).over(w)).where("section > 0")
    ids = F.transform(F.array_sort(F.collect_list(F.when(member, F.struct("ord", "element_id")))),
        lambda x: x.element_id)
    return marked.groupBy("doc_id", "section").agg(F.max(F.when(is_heading, F.col("text"))).alias("heading"),
        F.max(F.when(is_heading, F.col("level"))).alias("level"), ids.alias("element_ids"))


def violations(found: DataFrame) -> DataFrame:
    """(doc_id, check_id, detail): repeated ids or orders, gaps, and elements without what their kind needs."""
    repeats = lambda c: found.groupBy("doc_id", c).count().where("count > 1").select("doc_id",
        F.lit(f"repeated_{c}").alias("check_id"), F.col(c).cast("string").alias("detail"))
    gaps = found.groupBy("doc_id").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"),
        F.countDistinct("ord").alias("n")).where("lo <> 0 or hi + 1 <> n").select("doc_id", F.lit("order_gap"),
        F.concat_ws("-", "lo", "hi"))
    empty = found.where("(kind = 'table' and rows is null) or (kind = 'figure' and url is null) or (kind in ('heading', 'paragraph', 'list_item') and coalesce(text, '') = '') or (kind = 'heading' and level is null)")
    return repeats("ord").union(repeats("element_id")).union(gaps).union(empty.select("doc_id",
        F.concat(F.lit("incomplete_"), "kind"), "element_id"))
