"""Atoms of a paper: segmentation by printed totals, alignment, closure of marks, gates and renderings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.operators import gates
from foliant.operators.perdoc import per_document

# Furniture of layout pages, printed identity, and thresholds of page kinds.
FURNITURE = ("do not write in this area", "answer all questions.", "answer all questions", "turn over", "blank page", "pmt")
FURNITURE_STARTS = ("do not write in this area", "some questions must be answered with a cross in a box",
    "if you change your mind, put a line through the box")
TOTAL_ROW = r"(?i)^\(?total for question \d+\b.*\bmarks?\s*\.?\)?$"
FOOTER_Y, SCANNED_COVERAGE, SCANNED_CHARS = 780.0, 0.55, 250
REFERENCE = r"\b((?:W[A-Z]{2}[0-9]{2}|[0-9][A-Z]{2}[0-9])/[0-9]{1,2}[A-Z]{0,2})\b"


def drop_overlaps(blocks: DataFrame, key: list[str], share: float = 0.5) -> DataFrame:
    """Tables of a page less those that cover over `share` of the smaller of two, the later one going; and lines inside.

    blocks have kind, y0, x0, x1, y1 and an id; a page's blocks are few, and only they meet.
    """
    area = lambda a: (F.col(f"{a}.x1") - F.col(f"{a}.x0")) * (F.col(f"{a}.y1") - F.col(f"{a}.y0"))
    tables = blocks.where("kind = 'table'")
    a, b = tables.alias("a"), tables.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
    width = F.least("a.x1", "b.x1") - F.greatest("a.x0", "b.x0")
    height = F.least("a.y1", "b.y1") - F.greatest("a.y0", "b.y0")
    before = F.struct("a.y0", "a.x0", "a.id") < F.struct("b.y0", "b.x0", "b.id")
    cover = (width > 0) & (height > 0) & (width * height > share * F.least(area("a"), area("b")))
    gone = a.join(b, [*same, before & cover]).select("b.id").distinct()
    kept = tables.join(gone, "id", "left_anti")
    t = kept.alias("t")
    lines = blocks.where("kind <> 'table'").alias("l")
    inside = (F.col("l.x0") >= F.col("t.x0")) & (F.col("l.x1") <= F.col("t.x1")) & (F.col("l.y0") >= F.col("t.y0")) & (F.col("l.y1") <= F.col("t.y1")) & ~F.coalesce(F.col("l.text").rlike(TOTAL_ROW),
        F.lit(False))
    free = lines.join(t, [*[F.col(f"l.{k}") == F.col(f"t.{k}") for k in key], inside], "left_anti")
    return kept.unionByName(free)


def furniture(text: Column) -> Column:
    """exact, prefix or total for furniture lines, null for content."""
    low = F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
    starts = F.lit(False)
    for p in FURNITURE_STARTS:
        starts = starts | low.startswith(p)
    return F.when(low.isin(*FURNITURE) | F.regexp_replace(low, r"\.+$", "").isin(*FURNITURE), "exact").when(starts,
        "prefix").when(F.trim(text).rlike(TOTAL_ROW), "total")


def furniture_image(width: Column, height: Column) -> Column:
    """A rule or a bar: at least 200 long and eight times as long as high."""
    long, short = F.greatest(width, height), F.least(width, height)
    return (short > 0) & (long >= 200) & (long / short >= 8)


def page_kinds(pages: DataFrame) -> DataFrame:
    """(doc_id, n_pages, n_scanned, scanned): a page is scanned if images cover most of it and it has few characters."""
    one = (F.col("coverage") > SCANNED_COVERAGE) & (F.col("n_chars") < SCANNED_CHARS)
    return pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"),
        F.count_if(one).alias("n_scanned")).withColumn("scanned", F.col("n_scanned") * 2 > F.col("n_pages"))


def _segments(doc_id: str, lines: list[dict]) -> list[dict]:
    out, expected, open_, orphans = [], 1, None, {}
    for x in lines:
        text = (x["text"] or "").strip()
        if m := re.match(r"\(?Total for Question\s*(\d{1,2})\s*(?:=|is)\s*(\d{1,3})\s*marks?\)?", text, re.I):
            if open_ and open_["number"] == int(m[1]):
                open_ |= {"total": int(m[2]), "last_page": x["page"]}
                open_ = None
            else:
                orphans[int(m[1])] = int(m[2])
        elif (m := re.match(r"\*?(\d{1,2})\s+\S", text)) and int(m[1]) == expected:
            open_ = {"doc_id": doc_id, "number": expected, "first_page": x["page"], "last_page": x["page"],
                "total": None, "n_lines": 1}
            out.append(open_)
            expected += 1
        elif open_:
            open_ |= {"n_lines": open_["n_lines"] + 1, "last_page": x["page"]}
    for q in out:
        if q["total"] is None:
            q["total"] = orphans.get(q["number"])
    return out


def segments(lines: DataFrame) -> DataFrame:
    """Questions of layout lines (doc_id, page, y0, x0, text): the expected number opens, its printed total closes.

    Lines of the footer band are left out; totals met outside their question are given to it at the end.
    """
    row = F.struct("page", "y0", "x0", "text")
    docs = lines.where(F.col("y0") <= FOOTER_Y).groupBy("doc_id").agg(F.sort_array(F.collect_list(row)).alias("lines"))
    return per_document(docs, ["doc_id", "lines"], _segments,
        "doc_id string, number int, first_page int, last_page int, total int, n_lines int")


def cross_check(a: DataFrame, b: DataFrame) -> DataFrame:
    """(doc_id, number, problem): where two segmentations of the same papers disagree."""
    both = a.select("doc_id", "number", F.col("total").alias("ta"),
        F.lit(1).alias("ia")).join(b.select("doc_id", "number", F.col("total").alias("tb"), F.lit(1).alias("ib")),
        ["doc_id", "number"], "full_outer")
    problem = F.when(F.col("ib").isNull(), "first_only").when(F.col("ia").isNull(),
        "second_only").when(~F.col("ta").eqNullSafe(F.col("tb")), "total")
    return both.withColumn("problem", problem).where("problem is not null").select("doc_id", "number", "problem")


def close_parts(parts: DataFrame, points: DataFrame) -> DataFrame:
    """parts (key, part, sub, marks) with null marks filled from the points: the exact subpart, else the letter, else 1.

    A letter that has subparts is their sum.
    """
    exact = points.groupBy("key", "part", "sub").agg(F.sum("marks").alias("_exact"))
    letter = points.groupBy("key", "part").agg(F.sum("marks").alias("_letter"), F.countDistinct("sub").alias("_subs"))
    p, e = parts.alias("p"), exact.alias("e")
    joined = p.join(e, (F.col("p.key") == F.col("e.key")) & (F.col("p.part") == F.col("e.part"))
        & F.col("p.sub").eqNullSafe(F.col("e.sub")), "left").select("p.*", "_exact").join(letter, ["key", "part"], "left")
    filled = joined.withColumn("marks", F.coalesce("marks", "_exact", F.when(F.col("_subs") == 0, F.col("_letter")),
        F.when(F.col("sub").isNotNull(), F.lit(1)).otherwise(F.coalesce("_letter", F.lit(1)))))
    subs = filled.where("sub is not null").groupBy("key", "part").agg(F.sum("marks").alias("_sum"))
    out = filled.join(subs, ["key", "part"], "left")
    return out.withColumn("marks", F.when(F.col("sub").isNull() & F.col("_sum").isNotNull(),
        F.col("_sum")).otherwise(F.col("marks"))).select(*parts.columns)


def pool_sum(points: DataFrame, pools: DataFrame) -> DataFrame:
    """(key, closable): marks of points outside all pools, and each pool's cap (its members' marks if less).

    points: key, id, part, sub, marks; pools: key, pool, part, sub (null: the whole part), cap.  A point counts in
    the first pool that it fits.
    """
    a, b = points.alias("a"), pools.alias("b")
    fits = (F.col("a.key") == F.col("b.key")) & (F.col("a.part") == F.col("b.part")) & (F.col("b.sub").isNull()
        | F.col("a.sub").eqNullSafe(F.col("b.sub")))
    member = a.join(b, fits, "left").groupBy("a.key", "a.id").agg(F.first("a.marks").alias("marks"),
        F.min("b.pool").alias("pool"), F.min_by("b.cap", "b.pool").alias("cap"))
    g = member.groupBy("key", "pool").agg(F.sum("marks").alias("s"), F.max("cap").alias("cap"))
    return g.groupBy("key").agg(F.sum(F.when(F.col("pool").isNull(),
        F.col("s")).otherwise(F.least("s", "cap"))).alias("closable"))


def align_pages(texts: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, ord, page): each text on the first page, not before the last one found, that holds it or that it holds.

    texts: doc_id, ord, text; pages: doc_id, page, text.
    """
    t = texts.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", "text"))).alias("texts"))
    p = pages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page", "text"))).alias("pages"))

    def make(doc_id: str, ts: list[dict], ps: list[dict] | None) -> list[dict]:
        flat = [(x["page"], " ".join((x["text"] or "").split())) for x in ps or []]
        at, out = 0, []
        for x in ts:
            own = " ".join((x["text"] or "").split())
            hit = next((k for k in range(at, len(flat)) if own
                and (own in flat[k][1] or (flat[k][1] and flat[k][1] in own))), None)
            at = at if hit is None else hit
            out.append({"doc_id": doc_id, "ord": x["ord"], "page": flat[hit][0] if hit is not None else None})
        return out

    return per_document(t.join(p, "doc_id", "left"), ["doc_id", "texts", "pages"], make,
        "doc_id string, ord int, page int")


def identity_gate(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """(doc_id, status): printed references of the first pages against the expected one.

    fail: other references only; ok: it is printed; flag: printed beside others; indeterminate: none is readable.
    """
    found = pages.where("page <= 2").groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list(F.regexp_extract_all("text",
        F.lit(REFERENCE), F.lit(1))))).alias("refs"))
    has = F.array_contains("refs", F.col("reference"))
    status = F.when(F.coalesce(F.size("refs"), F.lit(0)) <= 0, "indeterminate").when(has & (F.size("refs") == 1),
        "ok").when(has, "flag").otherwise("fail")
    return expected.join(found, "doc_id", "left").select("doc_id", status.alias("status"))


def integrity_gate(questions: DataFrame, points: DataFrame, witnesses: DataFrame) -> DataFrame:
    """Findings of a parsed scheme: sums by question, numbers 1 to n, the paper's total among its witnesses, empty texts.

    questions: doc_id, question, total; points: doc_id, question, marks, text; witnesses: doc_id, total.
    """
    at = F.concat_ws("/", "doc_id", F.col("question").cast("string"))
    sums = questions.join(points.groupBy("doc_id", "question").agg(F.sum("marks").alias("s")), ["doc_id", "question"], "left")
    out = [gates.findings(sums, at, "question_sum",
        F.when(F.col("total").isNull(), "review").when(F.col("s").eqNullSafe(F.col("total")), "ok").otherwise("fail"),
        F.concat_ws("/", "s", "total"))]
    order = gates.continuity(questions, "doc_id", "question")
    out.append(gates.findings(order, F.col("doc_id"), "continuity", F.when(F.col("continuous"), "ok").otherwise("fail"),
        F.col("n")))
    whole = questions.groupBy("doc_id").agg(F.sum("total").alias("sum")).join(witnesses.groupBy("doc_id").agg(F.collect_set("total").alias("seen")),
        "doc_id", "left")
    out.append(gates.findings(whole, F.col("doc_id"), "witness",
        F.when(F.col("seen").isNull(), "review").when(F.array_contains("seen", F.col("sum")), "ok").otherwise("fail"),
        F.col("sum")))
    out.append(gates.findings(points.where("coalesce(trim(text), '') = '' or marks is null"), at, "incomplete_point",
        "fail", F.col("text")))
    return gates.all_findings(out)


def label_accounting(pages: DataFrame, points: DataFrame, other: DataFrame) -> DataFrame:
    """(doc_id, printed, used, accounted): mark labels on the pages against those in points and in other buckets."""
    label = r"(?:^|\s)[MA]\d{1,2}(?=[\s(]|$)"
    printed = pages.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(f"(?m){label}"))).alias("printed"))
    used = points.where("label is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("a"))
    rest = other.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(f"(?m){label}"))).alias("b"))
    out = printed.join(used, "doc_id", "left").join(rest, "doc_id", "left").select("doc_id", "printed",
        (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("used"))
    return out.withColumn("accounted", F.col("printed") == F.col("used"))


def merge_alternatives(points: DataFrame) -> DataFrame:
    """Points without marks join the first one with marks of the same part and subpart, as its alternatives.

    points: key, part, sub, ord, marks, text.  A group without marks stays as it is.
    """
    w = W.partitionBy("key", "part", "sub")
    first = F.min(F.when(F.col("marks") > 0, F.col("ord"))).over(w)
    marked = points.withColumn("_o", F.when((F.coalesce("marks", F.lit(0)) == 0) & first.isNotNull(),
        first).otherwise(F.col("ord")))
    texts = F.sort_array(F.collect_list(F.when(F.col("ord") != F.col("_o"), F.struct("ord", "text"))))
    return marked.groupBy("key", "part", "sub", F.col("_o").alias("ord")).agg(
        F.max(F.when(F.col("ord") == F.col("_o"), F.col("marks"))).alias("marks"),
        F.max(F.when(F.col("ord") == F.col("_o"), F.col("text"))).alias("text"),
        F.transform(texts, lambda x: x.text).alias("alternatives"))


def render_points(points: DataFrame) -> DataFrame:
    """(key, markdown): a line for each point with its label, marks and notes, in order."""
    at = F.concat_ws("", F.when(F.col("part").isNotNull(), F.concat(F.lit("("), "part", F.lit(")"))),
        F.when(F.col("sub").isNotNull(), F.concat(F.lit("("), "sub", F.lit(")"))))
    notes = F.when(F.size("notes") > 0, F.concat(F.lit(" — "), F.array_join("notes", "; "))).otherwise("")
    line = F.concat(F.lit("- "), F.when(at != "", F.concat(at, F.lit(" "))).otherwise(""), "text",
        F.when(F.col("marks").isNotNull(), F.concat(F.lit(" ["), F.col("marks").cast("string"),
        F.lit("]"))).otherwise(""), notes)
    return points.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord",
        line.alias("l")))), lambda x: x.l), "\n").alias("markdown"))


def flat_diff(a: DataFrame, b: DataFrame, key: str, content: str = "json") -> DataFrame:
    """(key, path, expected, actual): leaves of two JSON texts that differ, by path."""
    import json

    def leaves(k, text):
        def walk(path, v):
            if isinstance(v, dict):
                for n in sorted(v):
                    yield from walk(f"{path}.{n}", v[n])
            elif isinstance(v, list):
                yield f"{path}.length", str(len(v))
                for i, x in enumerate(v):
                    yield from walk(f"{path}[{i}]", x)
            else:
                yield path, json.dumps(v)

        return [{"k": k, "path": p, "v": v} for p, v in walk("$", json.loads(text))] if text else []

    flat = lambda df, name: per_document(df, [F.col(key).cast("string"), content], leaves,
        "k string, path string, v string").withColumnRenamed("v", name)
    both = flat(a, "expected").join(flat(b, "actual"), ["k", "path"], "full_outer")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual"))).withColumnRenamed("k", key)
