"""Grids, atoms and corpus keeping on small inputs written here."""

from foliant.operators import atoms, corpus, grid
from foliant.sources import connectors

PAGE = """Question  Answer                                                     Notes                Marks
number
1  (a)       an answer that is right                                     accept this             1
             second line of it
   (b)  (i)  M1  first step                                              ignore units            1
             M2  second step                                                                     1
        (ii)                                                                                     2
             the late answer
Total 5
2  a   one thing                                                                                 1
       another                                                                                   1
       a third                                                                                   1
       Any two for 1 each
   b   a long answer
                                                                                                 3
       allow alternative method
       M1  other way                                                                             3
Total for question = 5
stray line
The total marks for this paper is 60
"""

CODES = """Question   Working            Answer        Mark   Notes
1 (a)      x = 2              2             2      M1 for setting up
                                                   A1 dep on M1
  (b)      y                                1      B1 ft
OR
           z                                       B1
Total 3 marks
2          w                  5             3      M2 A1 (M1 for one)
Total 3 marks
"""


def pages(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, pages array<string>")


def test_points_of_a_grid(spark):
    df = pages(spark, [PAGE], None, [""])
    got = [(r.question, r.part, r.sub, r.label, r.marks, r.alternative, r.grp) for r in grid.points(df).collect()]
    assert got == [
        (1, "a", None, None, 1, False, None), (1, "b", "i", "M1", 1, False, None), (1, "b", "i", "M2", 1, False, None),
        (1, "b", "ii", None, 2, False, None),
        (2, "a", None, None, 1, False, 0), (2, "a", None, None, 1, False, 0), (2, "a", None, None, 1, False, 0),
        (2, "b", None, None, 3, False, None), (2, "b", None, "M1", 3, True, None)]
    q = {r.question: r for r in grid.questions(df).collect()}
    assert {n: (r.total, r.sum, r.arithmetic_ok) for n, r in q.items()} == {1: (5, 5, True), 2: (5, 5, True)}
    assert q[1].unclassified == ["stray line"] and q[1].witnesses == [60] and q[2].groups[0].cap == 2
    printed = spark.createDataFrame([("d0", 1, 9)], "doc_id string, question int, total int")
    assert grid.questions(df, printed).where("arithmetic_ok").count() == 2


def test_marks_stand_in_their_column():
    assert grid.tail("number of the group that   2", 80) == ("number of the group that   2", None)
    assert grid.tail("x" + " " * 78 + "3", 80) == ("x", 3)
    assert grid.tail("x" + " " * 78 + "30", 80)[1] is None and grid.tail("ratio  2 : 4 :" + " " * 66 + "1",
        80)[1] is None


def test_code_grids(spark):
    df = pages(spark, [CODES], [PAGE])
    got = [(r.question, r.labels, r.code, r.marks, r.alternative, r.total) for r in grid.code_points(df).collect()]
    assert got == [(1, "(a)", "M1", 1, False, 3), (1, "(a)", "A1", 1, False, 3), (1, "(b)", "B1", 1, False, 3),
        (1, "(b)", "B1", 1, True, 3), (2, "", "M2", 2, False, 3), (2, "", "A1", 1, False, 3)]
    assert {r.doc_id: r.dialect for r in grid.route(df).collect()} == {"d0": "a", "d1": "points"}


def test_segments(spark):
    texts = ["1 first question", "more", "(Total for Question 1 = 2 marks)", "3 not yet", "2 second"]
    rows = [("d", 1, 10.0 * i, 0.0, t) for i, t in enumerate(texts)] + [("d", 1, 790.0, 0.0, "3 footer"),
        ("d", 2, 1.0, 0.0, "Total for Question 3 = 4 marks"), ("d", 2, 2.0, 0.0, "3 third")]
    got = atoms.segments(spark.createDataFrame(rows,
        "doc_id string, page int, y0 double, x0 double, text string")).collect()
    assert [(r.number, r.first_page, r.total) for r in got] == [(1, 1, 2), (2, 1, None), (3, 2, 4)]
    other = spark.createDataFrame([("d", 1, 2), ("d", 2, 9)], "doc_id string, number int, total int")
    a = spark.createDataFrame([("d", r.number, r.total) for r in got], "doc_id string, number int, total int")
    assert {(r.number, r.problem) for r in atoms.cross_check(a, other).collect()} == {(2, "total"), (3, "first_only")}


def test_closing_marks(spark):
    parts = spark.createDataFrame([("k", "a", None, None), ("k", "b", "i", None), ("k", "b", "ii", 2),
        ("k", "b", None, None)], "key string, part string, sub string, marks int")
    points = spark.createDataFrame([("k", 1, "a", None, 2), ("k", 2, "a", None, 1), ("k", 3, "b", "i", 4)],
        "key string, id int, part string, sub string, marks int")
    assert {(r.part, r.sub): r.marks for r in atoms.close_parts(parts, points).collect()} == {("a", None): 3,
        ("b", "i"): 4, ("b", "ii"): 2, ("b", None): 6}
    pools = spark.createDataFrame([("k", "p1", "a", None, 2)],
        "key string, pool string, part string, sub string, cap int")
    assert atoms.pool_sum(points, pools).first().closable == 6
    merged = spark.createDataFrame([("k", "a", None, 1, 1, "main"), ("k", "a", None, 2, 0, "alt"),
        ("k", "b", None, 3, 2, "x")], "key string, part string, sub string, ord int, marks int, text string")
    assert {(r.ord, r.marks, r.text, tuple(r.alternatives))
        for r in atoms.merge_alternatives(merged).collect()} == {(1, 1, "main", ("alt",)), (3, 2, "x", ())}


def test_alignment_goes_forward(spark):
    texts = spark.createDataFrame([("d", 0, "alpha  beta"), ("d", 1, "gamma"), ("d", 2, "alpha")],
        "doc_id string, ord int, text string")
    at = spark.createDataFrame([("d", 1, "x alpha beta y"), ("d", 2, "gamma")], "doc_id string, page int, text string")
    assert [(r.ord, r.page) for r in atoms.align_pages(texts, at).orderBy("ord").collect()] == [(0, 1), (1, 2),
        (2, None)]


def test_overlaps(spark):
    rows = [("d", 1, "a", "table", 0.0, 0.0, 10.0, 10.0, None), ("d", 1, "b", "table", 1.0, 1.0, 9.0, 9.0, None),
        ("d", 1, "c", "text", 2.0, 2.0, 3.0, 3.0, "in"),
        ("d", 1, "t", "text", 2.0, 2.0, 3.0, 3.0, "Total for question 1 = 2 marks"),
        ("d", 1, "e", "text", 20.0, 2.0, 23.0, 3.0, "out")]
    df = spark.createDataFrame(rows,
        "doc string, page int, id string, kind string, x0 double, y0 double, x1 double, y1 double, text string")
    assert {r.id for r in atoms.drop_overlaps(df, ["doc", "page"]).collect()} == {"a", "t", "e"}


def test_identity_and_integrity(spark):
    p = spark.createDataFrame([("a", 1, "4CH1/1C here"), ("b", 1, "4CH1/1C and 4SD0/1C"), ("c", 1, "none"),
        ("e", 1, "4SD0/1C")], "doc_id string, page int, text string")
    want = spark.createDataFrame([(x, "4CH1/1C") for x in "abce"], "doc_id string, reference string")
    assert {r.doc_id: r.status for r in atoms.identity_gate(p, want).collect()} == {"a": "ok", "b": "flag",
        "c": "indeterminate", "e": "fail"}
    q = spark.createDataFrame([("a", 1, 3), ("a", 2, 4)], "doc_id string, question int, total int")
    points = spark.createDataFrame([("a", 1, 3, "x"), ("a", 2, 3, "")],
        "doc_id string, question int, marks int, text string")
    found = atoms.integrity_gate(q, points, spark.createDataFrame([("a", 7)], "doc_id string, total int")).collect()
    assert {(r.check_id, r.severity) for r in found} == {("question_sum", "ok"), ("question_sum", "fail"),
        ("continuity", "ok"), ("witness", "ok"), ("incomplete_point", "fail")}
    a = spark.createDataFrame([("1", '{"a":[1,{"b":2}]}')], "k string, json string")
    b = spark.createDataFrame([("1", '{"a":[1,{"b":3}],"c":null}')], "k string, json string")
    assert {(r.path, r.expected, r.actual) for r in atoms.flat_diff(a, b, "k").collect()} == {("$.a[1].b", "2", "3"),
        ("$.c", None, "null")}


def test_corpus_edits(spark):
    docs = spark.createDataFrame([("k",
        "text\n![x](http://a/b.png)\n<div><img src='http://c.png'/></div>\nsee ![y](http://a/b.png) end")],
        "k string, text string")
    assert {r.url for r in corpus.image_urls(docs, "k").collect()} == {"http://a/b.png", "http://c.png"}
    mapped = corpus.rewrite_urls(docs, spark.createDataFrame([("k", "http://a/b.png", "img/b.png")],
        "k string, url string, path string"), "k").first().text
    assert mapped.count("img/b.png") == 2 and "http://c.png" in mapped
    edited, broken = corpus.plan_removal(docs, spark.createDataFrame([("k", "http://a/b.png"), ("k", "http://c.png")],
        "k string, url string"), "k")
    assert edited.first().text == "text\nsee ![y](http://a/b.png) end" and [r.line
        for r in broken.collect()] == ["see ![y](http://a/b.png) end"]
    files = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4")], "path string, sha256 string")
    manifest = spark.createDataFrame([("a", "1"), ("b", "2"), ("z", "9")], "path string, sha256 string")
    assert {(r.path, r.problem) for r in corpus.verify_files(manifest, files).collect()} == {("b", "changed"),
        ("c", "stray"), ("z", "missing")}
    one = corpus.batch_id(files, "path").first()
    assert one == corpus.batch_id(files.orderBy(files.path.desc()), "path").first() and one.n == 3


def test_intake_pairs(spark):
    rows = [("x", "qp", "1", "a"), ("x", "qp", "1", "b"), ("x", "ms", "2", "c"), ("y", "qp", "3", "d"),
        ("z", "insert", "4", "e"), ("w", "qp", "5", "f"), ("w", "qp", "6", "g"), ("w", "ms", "7", "h")]
    pairs, aside = corpus.intake_pairs(spark.createDataFrame(rows,
        "key string, kind string, sha256 string, file string"), ["key"])
    assert [tuple(r) for r in pairs.collect()] == [("x", "a", "c")]
    assert {(r.file, r.reason) for r in aside.collect()} == {("d", "UNPAIRED"), ("e", "INSERT"), ("f", "DUAL_COPY"),
        ("g", "DUAL_COPY"), ("h", "DUAL_COPY")}


def test_calls_are_tried_again():
    waits, answers = [], [(429, {"Retry-After": "2"}, ""), (503, {}, ""), (200, {}, "ok")]
    assert connectors.call(lambda r: answers.pop(0), {}, sleep=waits.append) == (200, "ok", 3) and waits == [2.0, 2.0]
    assert connectors.call(lambda r: (404, {}, "no"), {}, sleep=waits.append) == (404, "no", 1)
    assert connectors.call(lambda r: (500, {}, "x"), {}, attempts=2, sleep=lambda s: None) == (500, "x", 2)
    assert connectors.page_ranges(250) == [(1, 100), (101, 200), (201, 250)]
    now = [0.0]
    assert list(connectors.paced("abc", 60, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))) == ["a", "b",
        "c"] and now[0] == 2.0


def test_fetch_keeps_failures(spark):
    def transport():
        def send(r):
            if r["key"] == "2":
                raise OSError("down")
            return 200, {}, r["payload"].upper()

        return send

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    assert {(r.key, r.status, r.body) for r in connectors.fetch(df, "id", "p", transport,
        per_minute=1e6).collect()} == {("1", 200, "A"), ("2", -1, "OSError: down")}
