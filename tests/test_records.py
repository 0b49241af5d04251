from pyspark.sql import functions as F

from foliant.operators import records


def test_flags_and_records(spark):
    q = spark.createDataFrame([("d", 1, 5), ("d", 2, None), ("d", 3, 4)], "doc_id string, number int, total int")
    s = spark.createDataFrame([("d", 1, 5, 5), ("d", 2, 3, 2), ("d", 4, 6, 6)],
        "doc_id string, number int, ms_total int, sum int")
    got = {r.number: (r.marks, r.verified, r.flags) for r in records.paper_records(q, s).collect()}
    assert got == {1: (5, True, []), 2: (3, False, ["paper-total-missing", "points-do-not-close"]),
        3: (4, False, ["scheme-missing"]), 4: (6, False, ["no-paper"])}


def test_bindings(spark):
    parts = spark.createDataFrame([("k", "a"), ("k", "b-ii"), ("k", "c")], "key string, label string")
    points = spark.createDataFrame([("k", "a", "i", "p1"), ("k", "a", None, "p2"), ("k", "b", "i", "p3"),
        ("k", "b", "ii", "p4")], "key string, part string, sub string, id string")
    assert {(r.label, r.point_id) for r in records.part_points(parts, points).collect()} == {("a", "p1"), ("a", "p2"),
        ("b-ii", "p4"), ("c", None)}
    atoms = spark.createDataFrame([("k", None, None), ("k", "a", "i")], "key string, part string, sub string")
    answers = spark.createDataFrame([("k", None, None, "B"), ("k", "a", None, "C")],
        "key string, part string, sub string, letter string")
    assert {(r.part, r.letter) for r in records.correct_options(atoms, answers).collect()} == {(None, "B"), ("a", None)}
    figures = spark.createDataFrame([("d", "x/fig1.png"), ("d", "qp-p3_fig2.png"), ("d", "none.png")],
        "doc_id string, source_name string")
    reports = spark.createDataFrame([("d", "FIG1.png", "one"), ("d", "other_fig2.png", "two")],
        "doc_id string, name string, description string")
    assert {r.source_name: r.description for r in records.attach_descriptions(figures,
        reports).collect()} == {"x/fig1.png": "one", "qp-p3_fig2.png": "two", "none.png": None}


def test_canonical_and_markdown(spark):
    blocks = spark.createDataFrame([("d", 2, None, 0, "paragraph", "stem 2", 2, None),
        ("d", 1, "a", 1, "paragraph", "part", 1, None), ("d", 1, None, 0, "paragraph", "stem", 1, None),
        ("d", 1, "a", 2, "figure", "f.png", 1, "alt")],
        "doc_id string, number int, part string, ord int, kind string, text string, page int, alt string")
    e = records.canonical(blocks).orderBy("ord")
    assert [(r.element_id, r.section, r.group_key, r.text)
        for r in e.collect()] == [("e000000", "Question 1", "q01", "stem"), ("e000001", "Question 1", "q01-a", "part"),
        ("e000002", "Question 1", "q01-a", "f.png"), ("e000003", "Question 2", "q02", "stem 2")]
    assert records.page_counts(e).first().page_count == 2
    assert {r.number: r.markdown
        for r in records.bank_markdown(blocks).collect()} == {1: "stem\n\n**(a)** part\n\n![alt](f.png)", 2: "stem 2"}


def test_validation(spark):
    docs = spark.createDataFrame([("a", "JUN", 2020, 3), ("b", "MAY", 1900, 1)],
        "doc_id string, series string, year int, page_count int")
    e = spark.createDataFrame([("a", "e0", 0, "paragraph", 1, 0.5), ("b", "e0", 0, "odd", 4, 2.0),
        ("b", "e0", 1, "table", 1, None)],
        "doc_id string, element_id string, ord int, kind string, page int, confidence double")
    s = spark.createDataFrame([("a", 1, ["e0", "e9"])], "doc_id string, section int, element_ids array<string>")
    assert {(r.subject, r.check_id) for r in records.validate(docs, e, s).collect()} == {("b", "series"), ("b", "year"),
        ("b/e0", "kind"), ("b/e0", "confidence"), ("b/e0", "page"), ("b/e0", "repeated_id"),
        ("a/e9", "section_reference")}


def test_slices_and_logs(spark):
    rows = spark.createDataFrame([("d", i, t) for i, t in enumerate(["x", "Q1", "a", "b", "Q2"])],
        "k string, line_no int, raw string")
    assert {(r.slice, r.first_line, r.last_line)
        for r in records.slices(rows, "k", F.col("raw").startswith("Q")).collect()} == {(1, 1, 3), (2, 4, 4)}
    log = spark.createDataFrame([("b1", "x")], "batch_id string, op string")
    more = spark.createDataFrame([("b1", "x"), ("b2", "y")], "batch_id string, op string")
    assert sorted(r.batch_id for r in records.append_log(log, more).collect()) == ["b1", "b2"]
    up = records.upgrade_manifest(log, {"op": F.lit("z"), "version": F.lit(2)}).first()
    assert up.op == "x" and up.version == 2


def test_embeddings_are_taken_whole_or_not(spark):
    bank = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, None, 1)], "id int, embedding array<double>, embed_rev int")
    good = spark.createDataFrame([(2, [1.0, 1.0])], "id int, embedding array<double>")
    out, found = records.apply_embeddings(bank, good, "id", 2, 2)
    assert found.count() == 0 and {r.id: (r.embedding, r.embed_rev) for r in out.collect()} == {1: ([0.0, 1.0], 1),
        2: ([1.0, 1.0], 2)}
    bad = spark.createDataFrame([(2, [1.0]), (9, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])],
        "id int, embedding array<double>")
    out, found = records.apply_embeddings(bank, bad, "id", 2, 2)
    assert {(r.subject, r.check_id) for r in found.collect()} == {("2", "dimension"), ("9", "unknown"),
        ("1", "repeated")} and out.exceptAll(bank).count() == 0
