"""Document grammars on small texts written here."""

import json

from pyspark.sql import functions as F

from foliant.operators import gates, glyphs, lines, markdown, outline, papers, schemes, sittings
from foliant.sources import readers, sinks

PAPER = """# Paper 4XY0/1A
Log Number P12345A
June 2025
1 What is it?
A one
B two
C three
D four
(Total for Question 1 = 1 mark)
SECTION
## 2 A heading opened it.
*(a) Explain the thing.
(3)
(ii) And this.
(1)
c) never a part
b) damaged label
answer =
(Total for Question 2 = 5 marks)
25. 0 cm of wire
3. The third one.
A lone option
9 out of order
<table><tr><td>x</td><td>y</td></tr></table>
TOTAL FOR SECTION A = 6 MARKS TOTAL FOR PAPER = 20 MARKS
"""

SCHEME = """<table><tr><td>Question Number</td><td>Answer</td><td>Notes</td><td>Mark</td></tr>
<tr><td>1</td><td>The only correct answer is B</td><td></td><td>1</td></tr>
<tr><td>*2(a)</td><td>this (1) or that (2)</td><td>Allow &lt;x&gt;<br/>Ignore y</td><td>1<br>2</td></tr>
<tr><td>(ii)</td><td>more</td><td></td><td></td></tr>
<tr><td></td><td></td><td>1</td></tr>
<tr><td>Total for question 2</td><td></td><td>4</td></tr></table>
<table><tr><td>(b)</td><td>carried over</td><td>note</td><td>1</td></tr>
<tr><td>7</td><td>(c)</td><td>two level</td><td></td><td>2</td></tr><tr><td>Total</td><td></td><td>2</td></tr>
<tr><td>IC points</td><td>marks</td><td>x</td></tr><tr><td>6</td><td>4</td><td></td></tr><tr><td>5–4</td><td>3</td><td></td></tr></table>
(Total for Question 1 = 1 mark) TOTAL FOR PAPER = 21 MARKS"""


def elements(spark, *texts):
    return markdown.elements(spark.createDataFrame([(f"doc{i}", t) for i, t in enumerate(texts)],
        "doc_id string, text string"))


def test_blocks_that_do_not_end():
    kinds = lambda t: [(r["kind"], r["text"]) for r in markdown.parse(t).rows]
    assert kinds("<table><tr><td>a</td></tr>\n# H\ntext") == [("table", None), ("heading", "H"), ("paragraph", "text")]
    assert kinds("<table>\n(a) part") == [("paragraph", "(a) part")]
    assert kinds("$$\nx = 1\n$$\n$$\n(a) stem") == [("equation", "x = 1"), ("paragraph", "(a) stem")]
    assert kinds('<div align="center">\n# T\nmid\n</div>\n<div align="center">\nopen') == [("heading", "T"),
        ("paragraph", "mid"), ("paragraph", "open")]
    assert kinds("$$a$$ $$b$$\n$$a$$ and\n- item\n") == [("equation", "a"), ("equation", "b"),
        ("paragraph", "$$a$$ and"), ("list_item", "item")]
    counts = markdown.parse("<table>\n$$\n# x\n<div align='center'>\n$$a$$ b &amp;").counts
    assert (counts["open_tables"], counts["orphan_fences"], counts["open_divs"], counts["mixed_math_lines"],
        counts["entity_lines"]) == (1, 1, 1, 1, 1)
    assert kinds(None) == kinds("") == []


def test_figures_and_tables():
    row = markdown.parse("<div style='x'><img src='https://h/a%20b.PNG?Signature=1&Expires=2' alt='t'/></div>").rows[0]
    assert (row["source_name"], row["format"], row["alt"]) == ("a b.PNG", "png", "t")
    assert markdown.table_rows("<tr><td>a<br/>b</td><th><b>&amp;lt;</b></th></tr>") == [["a\nb", "&lt;"]]


def test_elements_and_sections(spark):
    e = elements(spark, "intro\n# A\nx\n- y\n# B\n", "", None)
    assert markdown.violations(e).count() == 0
    got = [(r.section, r.heading, r.element_ids) for r in markdown.sections(e).orderBy("section").collect()]
    assert got == [(1, "A", ["e000002", "e000003"]), (2, "B", [])]
    broken = e.withColumn("ord", F.when(F.col("ord") == 1, 0).otherwise(F.col("ord")))
    assert {r.check_id for r in markdown.violations(broken).collect()} == {"repeated_ord", "order_gap"}


def test_questions(spark):
    e = elements(spark, PAPER).cache()
    q = {r.number: r for r in papers.questions(e).collect()}
    assert sorted(q) == [1, 2, 3]
    assert q[1].mcq and [o.text for o in q[1].options] == ["one", "two", "three", "four"] and (q[1].marks,
        q[1].confidence) == (1, 0.8)
    assert [(p.label, p.marks, p.qwc) for p in q[2].parts] == [("a", 3, True), ("a-ii", 1, False), ("b", None, False)]
    assert q[2].parts[1].text == "And this. c) never a part" or q[2].parts[1].text == "And this."
    assert q[2].marks == 5 and q[2].marks_known and q[2].qwc and q[2].confidence == 0.6
    assert q[3].style == "dot" and "A lone option" in q[3].stem and len(q[3].table_ids) == 1 and not q[3].marks_known
    p = papers.papers(e).first()
    assert (p.reference, p.session, p.log_number, p.paper_total, p.section_totals, p.totals) == ("4XY0/1A", "June 2025",
        "P12345A", 20, {"A": 6}, {1: 1, 2: 5}) or p.reference is None
    assert any("opened by a heading" in w
        for w in p.warnings) and any(w.startswith("Q9: not the next question, which is Q4")
        for w in p.warnings) and any("half a label" in w for w in p.warnings)


def test_entries(spark):
    e = elements(spark, SCHEME).cache()
    got = {r.label: r for r in schemes.entries(e).collect()}
    assert sorted(got) == ["*2(a)", "1", "2(a)(ii)", "2(b)", "7(c)"]
    assert got["1"].mcq and got["1"].correct == "B" and got["1"].confidence == 0.85
    a = got["*2(a)"]
    assert a.marks == 3 and a.qwc and [(p.text, p.marks) for p in a.points] == [("this", 1),
        ("", 2)] or [(p.raw, p.marks) for p in a.points] == [("this", 1), ("or that", 2)]
    assert [(g.kind, g.text) for g in a.guidance] == [("allow", "Allow <x>"), ("ignore", "Ignore y")]
    assert (got["2(a)(ii)"].marks, got["2(a)(ii)"].marks_source) == (1, "rowspan continuation row")
    assert got["2(b)"].marks_source == "first row of a table" and got["7(c)"].marks_source == "two-level label row"
    s = schemes.schemes(e).first()
    assert s.totals == {1: 1, 2: 4,
        7: 2} and s.paper_total == 21 and len(s.criteria) == 2 and s.criteria_place == "embedded"
    assert schemes.levels(["Level 1 (1-2 marks) low", "Level 2 (3–4 marks) high"])[1] == {"level": 2, "low": 3,
        "high": 4, "text": "high"}


def test_sitting(spark):
    qp, ms = elements(spark, PAPER), elements(spark, SCHEME)
    pair = lambda df: df.withColumn("pair", F.lit("p"))
    q, p, s = pair(papers.questions(qp)), pair(papers.papers(qp)), pair(schemes.schemes(ms))
    e = pair(schemes.entries(ms)).withColumn("ord", F.col("label"))
    bound, whole, unmatched = sittings.bind(q, e)
    assert {(r.suffix, r.entry.label) for r in bound.where("entry is not null").collect()} == {("(a)", "*2(a)"),
        ("(a)(ii)", "2(a)(ii)"), ("(b)", "2(b)")}
    assert {r.number: r.entry and r.entry.label for r in whole.collect()} == {1: "1", 3: None}
    assert [r.label for r in unmatched.collect()] == ["7(c)"]
    found = {(r.subject, r.severity) for r in sittings.mark_findings(p, s, q, e).collect()}
    assert found == {("1", "match"), ("2", "mismatch"), ("7", "ms-only"), ("3", "gap"),
        ("paper", "paper-total-conflict")}
    assert sittings.pair_status(sittings.health(p, s, q, e)).first().status == "fail"


def test_outlines(spark):
    e = elements(spark, "# Unit 1: Matter\n## Topic 1 Atoms\n1A Structure\n2B wrong\n# Unit 1: again\n### deep\n")
    assert [(r.level, r.code) for r in outline.printed_outline(e).collect()] == [(1, "U1"), (2, "U1-T1"),
        (3, "U1-T1-S1A")]
    assert [r.code for r in outline.heading_outline(e).collect()] == ["U1", "U1-T1", "U2", "U2-T1"]


def test_glyphs(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "fi\x02"), (3, None)], "id int, t string")
    assert {(r.id, r.kind, r.code_point) for r in glyphs.census(df, "id", "t").collect()} == {(1, "private", 0xE001),
        (2, "control", 2)}
    table = {"": "-", "fi": "F"}
    assert {r.id: r.t for r in glyphs.normalise(df, "t", table).collect()} == {1: "a-b", 2: "F ", 3: None}
    assert glyphs.idempotent(df, "t", table).count() == 0 and glyphs.idempotent(df, "t",
        {"a": "fi", "fi": "x"}).count() == 1
    assert glyphs.gate(df, "id", "t", F.lit("b")).first().failed == [1, 2]
    assert glyphs.check_table({"a": "b",
        "b": "x"}) == ["value of 'a' holds the key 'b'"] and glyphs.check_table(table) == []
    assert glyphs.control_group(df, "id", 2).collect() == glyphs.control_group(df, "id", 2).collect()


def test_notes_and_engine_json(spark):
    good = "---\nnote_id: rn_1\ntitle: \"T\"\nsource: s\npath: q\nspec_point_ids: b\nspec_point_codes: t\nguided_study: u\nupdated_at: 2025-01-01T10:00:00Z\n---\nbody"
    df = spark.createDataFrame([("a", good), ("b", "none"), ("c", None),
        ("d", good.replace("rn_1", "x").replace("path: q", "note_id: y"))], "k string, text string")
    got = {r.k: r for r in readers.notes(df, "k").collect()}
    assert got["a"].violations == [] and got["a"].meta["title"] == "T" and got["a"].body == "body"
    assert got["d"].violations == ["repeated key note_id", "missing key path",
        "note_id is not rn_ and letters or digits"] and got["b"].violations and got["c"].violations
    side = spark.createDataFrame([("rn_1", "v1", "p"), ("rn_9", "v1", "p"), ("rn_1", "v0", "p")],
        "note_id string, schema string, params string")
    joined, aside = readers.with_sidecar(readers.notes(df, "k").where("k = 'a'"), side, "v1")
    assert joined.first().sidecar == "p" and {r.reason for r in aside.collect()} == {"schema", "note_id"}
    tree = json.dumps({"kids": [{"type": "heading", "heading level": 1, "content": "H", "bounding box": [1, 2, 3, 5]},
        {"type": "odd", "kids": [{"type": "paragraph", "content": "p"}]}]})
    docs = spark.createDataFrame([("a", tree), ("b", None)], "k string, json string")
    rows = readers.engine_json(docs, "k").collect()
    assert [(r.kind, r.text) for r in rows] == [("heading", "H"), ("paragraph", "p")] and rows[0].box.height == 3.0
    assert {r.k: r.skipped for r in readers.skipped_kinds(docs, "k").collect()} == {"a": ["odd"], "b": []}


def test_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for n in ("jan-2025-qp.md", "odd.md", "x/jan-2025-ms.md"):
        (tmp_path / n).write_text("# H")
    found = readers.files(spark, str(tmp_path), "*.md")
    records, quarantine = readers.archive(found, r"([a-z]+)-(\d{4})-(qp|ms)\.md", ["month", "year", "role"])
    assert {(r.month, r.role) for r in records.collect()} == {("jan", "qp"), ("jan", "ms")} and [r.file
        for r in quarantine.collect()] == ["odd.md"]
    refs = spark.createDataFrame([("x/a.png",), ("b.png",), ("../c.png",), ("d.png",)], "ref string")
    assets = spark.createDataFrame([("x/a.png",), ("y/b.png",), ("1/d.png",), ("2/d.png",)], "relative_path string")
    got = {r.ref: (r.asset_path, r.status) for r in readers.resolve_assets(refs, assets, ["ref"], "ref").collect()}
    assert got == {"x/a.png": ("x/a.png", "resolved"), "b.png": ("y/b.png", "resolved"), "../c.png": (None, "rejected"),
        "d.png": (None, "ambiguous")}


def test_package(spark, tmp_path):
    tables = {"q": spark.createDataFrame([(1,), (2,)], "q int"),
        "p": spark.createDataFrame([(1, 1), (2, None)], "p int, q int")}
    keys, refs = {"q": ["q"], "p": ["p"]}, [("p", ["q"], "q")]
    assert sinks.write_package(tables, str(tmp_path / "ok"), keys, refs).count() == 0
    assert sinks.same_package(tables, sinks.read_package(spark, str(tmp_path / "ok"), ["q", "p"])) == []
    bad = tables | {"p": spark.createDataFrame([(1, 9), (1, 1)], "p int, q int")}
    assert {r.check_id for r in sinks.write_package(bad, str(tmp_path / "bad"), keys, refs).collect()} == {"repeated:p",
        "dangling:p:q"}
    assert not (tmp_path / "bad").exists()


def test_chunks_close_as_they_should(spark):
    df = spark.createDataFrame([("d", i, t, g) for i,
        (t, g) in enumerate([(100, "a"), (200, "a"), (1, "a"), (900, "a"), (5, "a"), (5, "b"), (400, "b")])],
        "k string, i int, t int, g string")
    plain = [r.chunk for r in lines.pack_chunks(df, "k", ["i"], F.col("t")).orderBy("i").collect()]
    grouped = [r.chunk for r in lines.pack_chunks(df, "k", ["i"], F.col("t"), group="g").orderBy("i").collect()]
    assert plain == [1, 1, 2, 3, 4, 4, 5] and grouped == [1, 1, 2, 3, 4, 5, 6]


def test_gates(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w")], "k int, v string")
    assert {(r.k, r.change, r.columns) for r in gates.changes(a, b, "k", ["v"]).collect()} == {(2, "changed", "v"),
        (3, "removed", ""), (4, "added", "")}
    assert gates.same_rows(a, a) and not gates.same_rows(a, b)
    assert [r.k for r in gates.dangling(a, ["k"], b.select("k")).collect()] == [3]
    g = gates.grounded(spark.createDataFrame([(["a", "b"], ["a"])], "t array<string>, s array<string>"), F.col("t"),
        F.col("s")).first()
    assert g.ungrounded == ["b"] and not g.grounded


def test_streams(spark, tmp_path):
    from foliant.streaming import intake

    src, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.createDataFrame([(1, "a")], "id int, t string").write.parquet(src)
    run = lambda: intake.drain(spark, src, "id int, t string", sink, mark,
        lambda df: df.withColumn("n", F.length("t")))
    run()
    run()
    assert spark.read.parquet(sink).count() == 1
    spark.createDataFrame([(2, "bb")], "id int, t string").write.mode("append").parquet(src)
    run()
    assert sorted((r.id, r.n) for r in spark.read.parquet(sink).collect()) == [(1, 1), (2, 2)]
    schema = "id int, t string, ts timestamp"
    timed = str(tmp_path / "timed")
    spark.sql("SELECT * FROM VALUES (1, 'a', timestamp'2025-01-01 00:10:00'), (2, 'a', timestamp'2025-01-01 00:20:00'), (3, 'b', timestamp'2025-01-01 03:00:00') AS v(id, t, ts)").write.parquet(timed)
    stream = spark.readStream.schema(schema).parquet(timed)
    for name, df, want in (("copies", intake.first_copies(stream, "t", "ts"), 2),
        ("wide", intake.windowed_counts(stream, "ts", "t"), 2), ("sess", intake.session_counts(stream, "ts", "t"), 2)):
        q = df.writeStream.format("memory").queryName(name).outputMode("append" if name == "copies" else "complete"
            if name == "wide" else "append").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(name).count() <= want


def test_bundle(spark, tmp_path):
    from foliant.__main__ import main

    (tmp_path / "in").mkdir()
    for name, text in (("x-qp.md", PAPER), ("x-ms.md", SCHEME), ("y-qp.md", PAPER), ("notes.md", "z")):
        (tmp_path / "in" / name).write_text(text)
    out = str(tmp_path / "out")
    assert main([str(tmp_path / "in"), out]) == 1
    read = lambda t: spark.read.parquet(f"{out}/{t}")
    assert read("status").first().status == "fail" and read("documents").count() == 2 and read("questions").count() == 3
    assert read("unmatched").count() == 1 and read("violations").count() == 0 and read("marks").count() == 5
    from foliant.plans import bundle

    _, aside = bundle.build(spark, str(tmp_path / "in"))
    assert {(r.path.rsplit("/", 1)[-1], r.reason) for r in aside.collect()} == {("notes.md", "name"),
        ("y-qp.md", "unpaired")}
