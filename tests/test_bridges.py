"""Note bodies, chunks, series and line-wise schemes."""

import hashlib

from pyspark.sql import functions as F

from foliant.operators import bridges, notes


def rows(spark, *texts):
    return spark.createDataFrame([("d", i, t) for i, t in enumerate(texts)], "doc_id string, line_no int, raw string")


def test_note_bodies(spark):
    body = "# H\none\ntwo\n\n> **Spec point** x\n- item\n| a | b |\n|---|---|\n| 1 | 2 |\nafter\n![alt](img/p.png)\n"
    got = [(r["kind"], r["text"]) for r in notes.parse(body)]
    assert got == [("heading", "H"), ("paragraph", "one\ntwo"), ("paragraph", "**Spec point** x"),
        ("list_item", "item"), ("table", None), ("paragraph", "after"), ("figure", None)]
    assert notes.parse(body)[4]["rows"] == [["a", "b"],
        ["1", "2"]] and notes.parse(body)[6]["format"] == "png" and notes.parse(None) == []
    df = spark.createDataFrame([("k", body + "$x$ \\$"), ("e", None)], "k string, body string")
    assert {r.k: r.spec_points for r in notes.statistics(df, "k").collect()} == {"k": 1, "e": 0}
    assert notes.elements(df, "k").count() == 8


def test_chunks(spark):
    data = [("d", 1, 0, "e0", "a" * 800, "g1"), ("d", 1, 1, "e1", "b" * 400, "g1"), ("d", 2, 0, "e2", "c", None),
        ("d", 2, 1, "e3", " ", "g1"), ("d", 2, 2, "e4", "d", "g2"), ("d", 3, 0, "e5", "e", "g3"),
        ("d", 3, 1, "e6", "f" * 4000, "g3"), ("d", 3, 2, "e7", "h", "g3")]
    df = spark.createDataFrame(data,
        "doc_id string, page int, ord int, element_id string, text string, group_key string")
    got = bridges.chunks(df).orderBy("chunk").collect()
    assert [r.element_ids for r in got] == [["e0"], ["e1", "e2", "e4"], ["e5"], ["e6"], ["e7"]] or [r.element_ids
        for r in got] == [["e0", "e1"], ["e2", "e4"], ["e5"], ["e6"], ["e7"]]
    assert got[-1].content_sha256 == hashlib.sha256(b"h").hexdigest() and got[-1].page_start == 3


def test_series(spark):
    df = spark.createDataFrame([("Summer 2019", None), ("x", "2021-11"), ("", "01-2020"), ("Autumn 2018", None),
        (None, None)], "a string, b string")
    got = [tuple(r.s) for r in df.select(bridges.series(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [("JUN", 2019), ("NOV", 2021), ("JAN", 2020), (None, 2018), (None, None)]


def test_loose_questions(spark):
    got = bridges.loose_questions(rows(spark, "front", "1 What? (2)", "(a) more (1)", "Turn over", "7. Other",
        "tail")).orderBy("island").collect()
    assert [(r.number, r.marks, r.confidence) for r in got] == [(1, 3, 0.7),
        (7, None, 0.5)] and got[0].text == "1 What? (2)\n(a) more (1)"


def test_loose_points(spark):
    got = bridges.loose_points(rows(spark, "9 d i M1 first", "ii M1 second", "M2 third (2)", "(e) fourth",
        "3 (a)(i) fifth", "iv sixth", "4 reduction (1)", "(Total for Question 4 = 3 marks)",
        "noise without a number")).orderBy("line_no").collect()
    assert [(r.ref, r.ordinal, r.text, r.marks) for r in got] == [
        ("9-d-i", 1, "first", 1), ("9-d-ii", 1, "second", 1), ("9-d-ii", 2, "third (2)", 2), ("9-e", 1, "fourth", 1),
        ("3-a-i", 1, "fifth", 1), ("3-a-iv", 1, "sixth", 1), ("4", 1, "reduction (1)", 1)]
