"""Entry points and plans on inputs where they went wrong."""

import random

import pytest

from foliant.operators import corpus, gates, grid, lines, perdoc, shared, vectors
from foliant.sources import connectors, readers

PAPER = "# Paper\n\n1 Name a thing.\n(1)\n(Total for Question 1 = 1 marks)\n\nTOTAL FOR PAPER = 1 MARKS"
SCHEME = "# Mark Scheme\n<table><tr><td>1</td><td>a thing</td><td>Allow all</td><td>1</td></tr><tr><td>Total for question 1</td><td></td><td>{}</td></tr></table>"


def test_pairs_in_two_folders(spark, tmp_path):
    from foliant.__main__ import main
    from foliant.plans import bundle

    for folder, total in (("one", 1), ("two", 2)):
        (tmp_path / "in" / folder / "deep").mkdir(parents=True)
        (tmp_path / "in" / folder / "deep" / "x-qp.md").write_text(PAPER + f"\n{folder}")
        (tmp_path / "in" / folder / "deep" / "x-ms.md").write_text(SCHEME.format(total))
    tables, _ = bundle.build(spark, str(tmp_path / "in"))
    status = {r.pair.split("/")[-3]: r.status for r in tables["status"].collect()}
    assert set(status) == {"one", "two"} and status["two"] == "fail" and status["one"] != "fail"
    assert main([str(tmp_path / "in" / "two"), str(tmp_path / "out")]) == 1 and main([str(tmp_path / "in" / "one"),
        str(tmp_path / "out")]) == 0


def test_names_are_unique(spark):
    assert readers.reserve(["a.png", "a.png", "a-2.png"]) == ["a.png", "p2_a.png", "a-2.png"]
    assert readers.reserve(["a", "a", "p2_a", "a"]) == ["a", "p2_a", "p3_p2_a", "p4_a"]
    assert readers.reserve(["p2_a", "a", "a", "p3_a"]) == ["p2_a", "a", "p3_a", "p4_p3_a"]
    assert readers.reserve(["p2_a", "a", "a", "a"])[2:] == ["p3_a", "p4_a"]
    rng = random.Random(1)
    names = [rng.choice(["a", "p2_a", "p3_a", "p5_p2_a", "crop_4.bin"]) for _ in range(60)]
    assert len(set(readers.reserve(names))) == 60
    df = spark.createDataFrame([(f, i, n) for f in (1, 2) for i, n in enumerate(["a", "a", "b"])],
        "folder int, place int, name string")
    got = readers.unique_names(df, "folder", "name", "place").collect()
    assert {(r.folder, r.place): r.unique_name for r in got} == {(f, i): n for f in (1, 2) for i,
        n in enumerate(["a", "p2_a", "b"])}


def test_one_sidecar_a_note(spark):
    notes = spark.createDataFrame([({"note_id": "rn_1"},)], "meta map<string,string>")
    side = spark.createDataFrame([("rn_1", "b", "v1"), ("rn_1", "a", "v1")],
        "note_id string, params string, schema string")
    joined, aside = readers.with_sidecar(notes, side, "v1")
    assert [(r.note_id, r.sidecar) for r in joined.collect()] == [("rn_1", "a")] and [(r.params, r.reason)
        for r in aside.collect()] == [("b", "repeated")]


def test_shared_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Spark:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "a"})

    with pytest.raises(RuntimeError):
        shared.shared_dir(Spark)
    Spark.sparkContext.master = "local[2]"
    assert shared.shared_dir(Spark).startswith("file:")


def test_fetch_paces_and_keeps_failures(spark, tmp_path):
    def transport():
        def send(request):
            if request["key"] == "2":
                raise ValueError("bad")
            return 200, {}, request["payload"].upper()

        return send

    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "x" * 99)], "id string, p string").repartition(3)
    got = {r.key: (r.status, r.body) for r in connectors.fetch(df, "id", "p", transport, per_minute=1e6).collect()}
    assert got["1"] == (200, "A") and got["2"] == (-1, "ValueError: bad") and got["3"][0] == 200
    assert connectors.fetch(df, "id", "p", transport, per_minute=1e6).rdd.getNumPartitions() == 1
    naps, now = [], [0.0]

    def sleep(s):
        naps.append(s)
        now[0] += s

    list(connectors.paced(range(4), 60, lambda: now[0], sleep))
    assert naps == [1.0, 1.0, 1.0]


def test_documents_are_taken_a_few_at_a_time(spark):
    assert list(perdoc.portions([3, 3, 3, 9, 1], 6, 100)) == [(0, 2), (2, 1), (3, 1),
        (4, 1)] and list(perdoc.portions([1] * 5, 100, 2)) == [(0, 2), (2, 2),
        (4, 1)] and list(perdoc.portions([])) == []
    df = spark.createDataFrame([("x" * 10, "k"), (None, "l")], "text string, c0 string")
    got = perdoc.per_document(df, ["c0", "text", "text"], lambda k, t, u: [{"k": k, "n": len(t or ""), "same": t == u}],
        "k string, n int, same boolean").collect()
    assert {(r.k, r.n, r.same) for r in got} == {("k", 10, True), ("l", 0, True)}


@pytest.mark.parametrize("size", [1, 3, 400])
def test_batches_of_hot_keys(spark, size):
    rng = random.Random(size)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), i, "x")
        for i in rng.sample(range(5000), 1500)] + [(None, i, "y") for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o int, batch_of string").repartition(7)
    got = {(r.k, r.o): r.batch for r in gates.batches(df, ["k"], "o", size).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        for n, o in enumerate(sorted(o for k, o, _ in rows if k == key)):
            want[key, o] = n // size
    assert got == want


def test_passages(spark):
    words = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(words[:20])), (2, "Two  Words"), (3, ""), (4, None),
        (5, " ".join(words[10:18]))], "item_id int, text string")
    docs = spark.createDataFrame([(1, "\n".join(words[5:13]).upper()), (2, "say two\twords, two words"), (3, None),
        (4, " ".join(words[3:30])), (5, "two")], "doc_id int, text string")
    for sent in (10**6, 0):
        old, corpus.SENT = corpus.SENT, sent
        got = {(r.doc_id, r.item_id): r.n_hits for r in corpus.shared_passages(docs, items, "doc_id",
            "item_id").collect()}
        corpus.SENT = old
        assert got == {(1, 1): 1, (2, 2): 1, (4, 1): 10, (4, 5): 1}
    assert corpus.shared_passages(docs, items.limit(0), "doc_id", "item_id").count() == 0


def test_sections_and_chunks(spark):
    docs = spark.createDataFrame([(1, "a\n# x\r\none\n\ntwo\n# y\n# z\nend"), (2, ""), (3, None), (4, "# only")],
        "k int, text string")
    got = sorted((r.k, r.section, r.heading, r.first_line, r.n_lines, r.body)
        for r in lines.sections(docs, "k", lambda x: x.startswith("#")).collect())
    assert got == [(1, 1, "# x", 1, 2, "one\ntwo"), (1, 2, "# y", 5, 0, ""), (1, 3, "# z", 6, 1, "end"),
        (4, 1, "# only", 0, 0, "")]


def test_nearest_in_small_blocks(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(0)
    vecs = [rng.normal(size=4).round(1).tolist() for _ in range(60)]
    ids = [*range(55), 7, 7, 9, None, None]
    df = spark.createDataFrame(list(zip(ids, vecs)), "id long, v array<double>").repartition(5)
    queries = spark.createDataFrame([(i, v) for i, v in zip(ids, vecs) if i is None or i % 3 == 0 or i == 7],
        "id long, v array<double>")
    monkeypatch.setattr(vectors, "BLOCK", 3)
    monkeypatch.setattr(vectors, "SENT", 0)
    unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-300)
    got = {}
    for r in vectors.nearest(df, queries.dropDuplicates(["id"]), "id", "v", 4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.distance, r.neighbour_id))
    for q in queries.where("id is not null").dropDuplicates(["id"]).collect():
        near = sorted((round(float(1 - unit(q.v) @ unit(v)), 12), i) for i, v in zip(ids, vecs) if i is not None
            and i != q.id)[:4]
        assert [(d, n) for _, d, n in sorted(got[q.id])] == near
    assert vectors.nearest(df, queries, "id", "v", 4).where("query_id = 7").count() == 4
    assert vectors.nearest(df, queries.limit(0), "id", "v").count() == 0


def test_drift_by_rank(spark):
    import statistics

    rng = random.Random(5)
    for n in (1, 2, 9, 10, 11, 200):
        xs = [round(rng.uniform(-1, 1), rng.choice([1, 3, 6])) for _ in range(n)]
        r = vectors.drift(spark.createDataFrame([(x,) for x in xs] + [(None,)], "s double"), "s").first()
        assert (r.n, r.median_similarity, r.min_similarity, r.p10) == (n, round(statistics.median(xs), 6), min(xs),
            sorted(xs)[n // 10])
    assert vectors.drift(spark.createDataFrame([], "s double"), "s").first().n == 0


def test_drift_rounds_a_median_between_places_as_sql_does(spark):
    import duckdb

    for a, b in ((0.766123, 0.766124), (0.5, 0.500001), (-0.766124, -0.766123), (-0.000003, -0.000002)):
        r = vectors.drift(spark.createDataFrame([(a,), (b,)], "s double"), "s").first()
        want = duckdb.execute(f"SELECT round(list_median([{a}::DOUBLE, {b}::DOUBLE]), 6)").fetchone()[0]
        assert r.median_similarity == want


@pytest.mark.parametrize("made", ["given", "nulls", "no length", "no rows", "only nulls"])
def test_drift_gate_equals_sql(spark, tmp_path, made):
    import duckdb

    from foliant.plans import catalog

    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")  # its median lies between six places
    odd = {"given": "embedding", "nulls": "IF(vec_id % 3 = 0, NULL, embedding)",
        "no length": "IF(vec_id % 5 < 3, transform(embedding, x -> 0f), embedding)", "no rows": "embedding",
        "only nulls": "IF(vec_id < 0, embedding, NULL)"}[made]
    e = e.selectExpr("vec_id", f"{odd} AS embedding", "label").where("false" if made == "no rows" else "true")
    e.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = [tuple(r) for r in catalog.QUERIES["drift_gate"](spark, str(tmp_path)).collect()]
    assert repr(got) == repr(con.execute(catalog.ORACLES["drift_gate"]).fetchall())


def nearest_by_sql(folder):
    import duckdb

    from foliant.plans import catalog

    con = duckdb.connect()
    for name in ("customer", "supplier"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    con.execute("CREATE VIEW orders AS SELECT * FROM '/root/testdata/sf0.001/orders.parquet'")
    return con.execute(catalog.ORACLES["nearest_supplier"]).fetchall()


@pytest.mark.parametrize("partitions", [1, 7])
def test_nearest_supplier_equals_sql_on_odd_rows(spark, tmp_path, partitions):
    from foliant.plans import catalog

    rng = random.Random(partitions)
    odd = [None, float("nan"), float("inf"), float("-inf"), 1e17, -1e17, 1e300, -1e300, 1.7e308, -1.7e308, 0.0, 5e-324,
        2.0**53, 2.0**53 + 2, 1.0]
    supplier, customer = [], []
    for nation in [*range(12), None]:
        pool = {0: odd[:2], 1: odd[3:4], 2: odd[:1], 3: [], 4: odd[2:4], 5: odd[8:10], 6: odd[1:4]}.get(nation,
            rng.sample(odd, 6) + rng.sample(range(-30, 30), 20) + [x / 7e14 for x in rng.sample(range(99), 9)])
        supplier += [(x, nation) for x in {repr(x): x for x in map(lambda x: x if x is None else float(x) or 0.0,
            pool)}.values()]
        customer += [(x if x is None else float(x), nation) for x in odd + [i / 2 for i in range(-70, 70)] + [3.0, 3.0]]
    rng.shuffle(supplier)
    for name, rows, c in (("supplier", supplier, "s"), ("customer", customer, "c")):
        df = spark.createDataFrame([(i // 2 if c == "c" else i, n, x) for i, (x, n) in enumerate(rows)],
            f"{c}_{'supp' if c == 's' else 'cust'}key long, {c}_nationkey int, {c}_acctbal double")
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in catalog.QUERIES["nearest_supplier"](spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = nearest_by_sql(tmp_path)
    assert len(got) == len(customer) and sorted(map(str, got)) == sorted(map(str, want))


def test_nearest_makes_no_pairs_of_a_key(spark):
    from threading import Timer

    from foliant.operators import reconcile

    n = 60_000  # of one key: 3,600,000,000 pairs, minutes of work
    left = spark.range(n).selectExpr("id", "1 AS k", "CAST(id AS DOUBLE) * 3 AS at")
    right = spark.range(n).selectExpr("id AS v", "1 AS k", "CAST(id AS DOUBLE) * 2 + 0.5 AS at")
    late = Timer(100, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        got = {r.id: r.v for r in reconcile.nearest(left, right, ["k"], "at", "v").collect()}
    finally:
        late.cancel()
    about = lambda i: {min(max(j, 0), n - 1) for j in (3 * i // 2 - 1, 3 * i // 2, 3 * i // 2 + 1)}
    assert got == {i: min(about(i), key=lambda j: (abs(2 * j + 0.5 - 3 * i), j)) for i in range(n)}


HEAD = "Question  Answer                                              Notes                   Marks\n"


def cell(text, marks):
    return f"{text:<84}{marks}\n"


def test_reprints_are_settled_by_the_total():
    first, divider = HEAD + cell("1  (a)  main", 2) + cell("   (b)  more", 1), "Alternative Method\n"
    read = lambda *pages: grid.read(list(pages)).questions[0]
    q = read(first, divider + cell("   (a)  again", 2) + "Total 3")
    assert (q.total, q.sum(), len(q.points), q.guidance) == (3, 3, 2, ["other method: again"])
    for again in (cell("   (a)  again", 3), cell("   (b)  again", 2),
        cell("   (a)  again", 2) + cell("   (a)  again", 2)):  # no twin, or over by another sum
        q = read(first, divider + again + "Total 3")
        assert q.sum() > 3 and not q.guidance
    assert read(first, divider + cell("   (c)  real", 2) + "Total 5").sum() == 5


def test_rows_without_marks_become_notes():
    g = grid.read([HEAD + cell("1  (a)  main",
        2) + "   (b)  lost cell\n" + "   (c)  lost too\n" + cell("   (d)  Reject other words", 1) + "Total 3"])
    q = g.questions[0]
    assert [(p.part, p.marks, p.text, p.notes) for p in q.points] == [("a", 2, "main", ["lost cell", "lost too"]),
        ("d", 1, "", ["Reject other words"])]
    one_block = grid.read([HEAD + cell("1  (a)  main",
        2) + "   (b)  M1  x\n" + "        M2  y\n" + "Total 4"]).questions[0]
    assert one_block.sum() == 4


def test_labels_parted_from_their_digit():
    g = grid.read([HEAD + "1  (a)  M\n" + "1      first step\n" + cell("", 1) + "2  (a)  M\n" + cell("2  (b)  other",
        1) + "Total 1"])
    assert [(p.part, p.label) for p in g.questions[0].points][0] == ("a", "M1")
    assert grid._whole_labels([(0, "1 (a)  M"), (1, "2  (b) x")]) == [(0, "1 (a)  M"), (1, "2  (b) x")]


CODES = "Question   Working            Answer     Mark   Notes\n"


def code_row(label, value, codes):
    return f"{label:<41}{value:<7}{codes}\n"


def test_codes_are_staged_for_the_next_opener():
    text = CODES + code_row("1 x", 1, "M1") + "Total 1 marks\n" + code_row("   w", 2, "M1") + code_row("2 z", "",
        "A1") + "Total 2 marks\n" + code_row("  v", "", "B1 lost") + "Total 9 marks\n"
    c = grid.read_codes([text])
    assert [(r["question"], r["code"], r["ordinal"]) for r in c.rows] == [(1, "M1", 1), (2, "M1", 2), (2, "A1", 3)]
    assert c.problems[2][-1] == "no question for B1" and c.totals == {1: 1, 2: 2}


def test_codes_in_large_brackets():
    top, spine, bottom = "\uf0e6", "\uf0e7", "\uf0e8"
    rows = code_row("", "", f"{top}M1 for one") + code_row("", "", f"{spine} or M1 for two") + code_row("", "",
        f"{bottom}M1 last")
    c = grid.read_codes([CODES + code_row("1 x", 3, "M2") + rows + code_row("", "", "A1 behind") + "Total 3 marks\n"])
    assert [r["code"] for r in c.rows] == ["M2", "A1"] and sum("bracket" in p
        for p in c.problems[1]) == 3 and len(c.problems[1]) == 3
    inline = grid.read_codes([CODES + code_row("1 x", 3, f"M1 {top} 1 2 \uf0f6 A2")])
    assert [r["code"] for r in inline.rows] == ["M1", "A2"]


def test_pages_that_are_no_grid_are_passed_over():
    cover = "Mark Scheme\nEdexcel is one of the largest bodies\nA box. If you change your mind\n2019"
    g = grid.read([cover, HEAD + cell("1  (a)  main", 2) + "Total 2", "Publications\nCode 2"])
    assert g.unclassified == [] and [(q.number, q.total) for q in g.questions] == [(1, 2)]
    for page in ("(ii)   D yellow   1", "c   change is small", "5 marks", "x M1", HEAD):
        assert grid.is_grid(page.split("\n"))
    split = grid.read([HEAD + cell("1  (a)  main", 2) + "reject all   Total\n" + cell("", 2)]).questions[0]
    assert split.total == 2 and split.points[0].notes == ["reject all"]
