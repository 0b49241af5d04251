"""Outlines: units, topics and subtopics of a syllabus, and trees from heading levels."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.papers import _collected
from foliant.operators.perdoc import per_document

# Printed forms of outline headings.
UNIT = re.compile(r"Unit\s+(\d{1,2})\s*[:–—-]?\s*(.*)", re.I)
TOPIC = re.compile(r"Topic\s+(\d{1,2})\s*[:–—-]?\s*(.*)", re.I)
SUBTOPIC = re.compile(r"(\d{1,2})([A-Z])\s*[:–—.-]?\s+(.*)")

_OUT = "doc_id string, level int, code string, number string, parent string, title string, confidence double"


def _title(text: str) -> str:
    return " ".join(text.split())[:200].strip(" .:–—-")


def _printed(doc_id: str, elements: list[dict]) -> list[dict]:
    out, units, topics, subs = [], set(), set(), set()
    unit = topic = None
    for e in elements:
        text = (e["text"] or "").strip()
        if m := UNIT.fullmatch(text):
            unit, topic = m[1], None
            if unit not in units and _title(m[2]):
                units.add(unit)
                out.append((1, f"U{unit}", unit, None, _title(m[2]), 0.95))
        elif m := TOPIC.fullmatch(text):
            topic = m[1]
            if unit and topic not in topics and _title(m[2]):
                topics.add(topic)
                out.append((2, f"U{unit}-T{topic}", topic, f"U{unit}", _title(m[2]), 0.95))
        elif (m := SUBTOPIC.fullmatch(text)) and unit and m[1] == topic and m[1] + m[2] not in subs:
            subs.add(m[1] + m[2])
            out.append((3, f"U{unit}-T{topic}-S{m[1]}{m[2]}", m[1] + m[2], f"U{unit}-T{topic}", _title(m[3]), 0.85))
    return [dict(zip(("doc_id", "level", "code", "number", "parent", "title", "confidence"), (doc_id, *r)))
        for r in out]


def printed_outline(elements: DataFrame) -> DataFrame:
    """Units, topics and subtopics by their printed numbers.

    The first of each number counts, topics in the whole document; a subtopic must cite the topic it stands in.
    """
    return per_document(_collected(elements), ["doc_id", "elements"], _printed, _OUT)


def _levels(doc_id: str, elements: list[dict], levels: dict[str, int]) -> list[dict]:
    out, counts, stack = [], {}, []
    for e in elements:
        if e["kind"] != "heading":
            continue
        level = min(levels.get(e["element_id"]) or 1, 3, len(stack) + 1)
        stack = stack[: level - 1]
        parent = stack[-1] if stack else None
        counts[parent] = counts.get(parent, 0) + 1
        code = (f"{parent}-" if parent else "") + "UTS"[level - 1] + str(counts[parent])
        stack.append(code)
        out.append({"doc_id": doc_id, "level": level, "code": code, "number": str(counts[parent]), "parent": parent,
            "title": _title(e["text"] or ""), "confidence": 0.5})
    return out


def heading_outline(elements: DataFrame) -> DataFrame:
    """A tree of three levels from heading levels; a deeper heading goes below the last one, one level at a time."""
    with_level = elements.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", "element_id", "kind",
        "text", "level"))).alias("elements"))
    return per_document(with_level, ["doc_id", "elements"], lambda k,
        es: _levels(k, es, {e["element_id"]: e["level"] for e in es}), _OUT)
