"""Packages, manifests, parsers by media type, gate suites and the command line."""

import json

import pytest

from foliant.operators import glyphs, suites
from foliant.sources import engines, package, readers


def minimal(spark):
    """One row for each table, whole."""
    rows = {
        "package_metadata": ("k", "v"), "resource": ("r", "note", "ok"), "resource_version": ("r", "1", "ok", "c", "t"),
        "resource_provenance": ("p", "web"), "specification_point": ("s", "x"),
        "revision_note": ("n", "r", "1", "t", "path", "00", "ok"),
        "revision_note_specification_point": ("n", "s", "ok"), "paper": ("p", "ok"),
        "paper_question": ("q", "p", "1", "ok"), "question_part": ("a", "q", "a", "1", "ok"),
        "mark_scheme": ("m", "p", "00", "ok"), "mark_point": ("x", "m", "1", "ok"),
        "parser_run": ("u", "00", "p", "1", "t", "ok"), "validation_finding": ("f", "e", "i", "s", "c", "m", "ok")}
    out = {}
    for name, rules in package.TABLES.items():
        columns = list(dict.fromkeys([*rules["key"], *rules["required"]]))
        assert len(columns) == len(rows[name])
        out[name] = spark.createDataFrame([rows[name]], ", ".join(f"`{c}` string" for c in columns))
    return out


def test_a_whole_package_is_written(spark, tmp_path):
    tables = minimal(spark)
    assert len(tables) == 14
    tables["mark_point"] = tables["mark_point"].selectExpr("*", "cast(null as string) as question_part_id")
    assert package.write(tables, str(tmp_path / "p")).count() == 0
    assert sorted(x.name for x in (tmp_path / "p").iterdir()) == sorted(package.TABLES)


def test_what_stops_a_package(spark, tmp_path):
    tables = minimal(spark)
    tables["paper"] = tables["paper"].selectExpr("'other' as paper_id", "cast(null as string) as status")
    tables["resource"] = tables["resource"].union(tables["resource"])
    tables["paper_question"] = tables["paper_question"].union(tables["paper_question"].selectExpr("'q2' as question_id",
        "paper_id", "ordinal", "status"))
    tables["mark_point"] = tables["mark_point"].selectExpr("*", "'lost' as question_part_id")
    del tables["parser_run"]
    found = {(r.check_id, r.subject) for r in package.write(tables, str(tmp_path / "p")).collect()}
    assert found == {
        ("missing_table", "parser_run"), ("required:paper", "other"), ("repeated:resource", "r"),
        ("repeated:paper_question", "p/1"), ("dangling:paper_question:paper", "p"),
        ("dangling:mark_scheme:paper", "p"), ("dangling:mark_point:question_part", "lost")}
    assert not (tmp_path / "p").exists()


def test_manifest(spark):
    docs = spark.createDataFrame([("d", "qp", "00", 2), ("e", "ms", "11", 1)],
        "doc_id string, role string, sha256 string, n_pages int")
    assets = spark.createDataFrame([("d", 2, "b.png", None, None, "gone"), ("d", 1, "a.png", "aa", 5, None)],
        "doc_id string, ord int, name string, sha256 string, bytes long, reason string")
    got = {r.doc_id: json.loads(r.manifest) for r in package.manifest(docs, assets, "layout", "1.2").collect()}
    assert got["d"]["assets"] == [{"name": "a.png", "sha256": "aa",
        "bytes": 5}] and got["d"]["unfetched"] == [{"name": "b.png",
        "reason": "gone"}] and got["d"]["engine_version"] == "1.2"
    assert got["e"]["assets"] == [] and got["e"]["manifest_version"] == 2


def test_parsers_by_media_type(spark, tmp_path):
    assert engines.supports("text/markdown") and not engines.supports("application/pdf")
    rows = [("/x/a.md", b"# T"), ("/x/copy.md", b"# T"), ("/x/notes/n.md", b"- i"),
        ("/x/e.json", b'{"kids": [{"type": "paragraph", "content": "p"}]}'), ("/x/z.pdf", b"%PDF")]
    files = spark.createDataFrame([(p, bytearray(c)) for p, c in rows], "path string, content binary")
    files = files.withColumn("mime", engines.media_type(files.path))
    found, aside = engines.parse(files)
    assert sorted((r.kind, r.text) for r in found.collect()) == [("heading", "T"), ("list_item", "i"),
        ("paragraph", "p")] and found.columns == list(engines.COLUMNS)
    assert [(r.path, r.reason) for r in aside.collect()] == [("/x/z.pdf", "no parser")]
    at = {str(r.extracted_at) for r in engines.identified(files, "2025-01-01T00:00:00Z").collect()}
    assert at == {"2025-01-01 00:00:00"} and engines.identified(files).where("extracted_at > timestamp'2025-01-01'").count() == 5
    (tmp_path / "one.json").write_text('{"kids": [{"type": "heading", "content": "H"}]}')
    assert [(r.doc_id, r.kind, r.text) for r in engines.second_opinion(spark, str(tmp_path)).collect()] == [("one",
        "heading", "H")]


def test_responses_and_glyphs(spark):
    bodies = ['{"md_results": "# a\\n"}', '{"md_results": ["a", "b"]}', '{"md_results": []}', '{"md_results": 3}', "{}",
        None, '{"md_results": "  "}', "not json"]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    got = {r.i: (r.r.text, r.r.pages, r.r.problem)
        for r in df.select("i", readers.response_markdown(df.body).alias("r")).collect()}
    assert got[0] == ("# a\n", [], None) and got[1] == ("a\n\nb", ["a", "b"], None) and [got[i][2]
        for i in range(2, 8)] == ["empty", "unexpected type", "no md_results", "no md_results", "empty",
        "no md_results"]
    texts = spark.createDataFrame([(0, " a\ue000b\ue001 "), (1, None), (2, "PMT"), (3, "plain")], "i int, t string")
    shown = {r.i: tuple(r.r) for r in texts.select("i",
        glyphs.rendered(texts.t, {"\ue000": "+"}, ["\ue001"], ["PMT"]).alias("r")).collect()}
    assert shown == {0: ("a+b", 1, True), 1: ("", 0, False), 2: ("", 0, False), 3: ("plain", 0, False)}


def test_verdicts(spark):
    found = spark.createDataFrame([("a", "x", "ok", ""), ("a/1", "y", "review", ""), ("b", "x", "fail", ""),
        ("b/2", "x", "fail", ""), ("c", "x", "ok", "")],
        "subject string, check_id string, severity string, detail string")
    assert {(r.subject, r.verdict, tuple(r.failed))
        for r in suites.verdicts(found).collect()} == {("a", "pass with flags", ()), ("b", "fail", ("x",)),
        ("c", "pass", ())}


@pytest.mark.parametrize("mode", ["canonical", "qp", "ms", "points", "glyphs"])
def test_dumps(spark, tmp_path, mode):
    from foliant.__main__ import main

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.md").write_text("# MS\n1 Say \ue001.\n(a) Now\n(2)\n<table><tr><td>1</td><td>a (1) b (1)</td><td></td><td>2</td></tr></table>")
    assert main(["--dump", mode, str(tmp_path / "in"), str(tmp_path / "out")]) == 0
    rows = [json.loads(x) for x in spark.read.text(str(tmp_path / "out")).toPandas().value]
    assert rows and all(r["doc_id"] for r in rows)
    assert {"canonical": lambda: [r["kind"] for r in rows] == ["heading", "paragraph", "paragraph", "paragraph",
        "table"], "qp": lambda: rows[0]["questions"][0]["number"] == 1,
        "ms": lambda: rows[0]["entries"][0]["marks"] == 2,
            "points": lambda: [r["raw"] for r in rows] == ["a", "b"],
            "glyphs": lambda: rows[0]["code_point"] == 0xE001}[mode]()


def test_unknown_modes_are_errors(tmp_path):
    from foliant.__main__ import main

    for args in (["--dump", "other", "a", "b"], ["--unknown"], []):
        with pytest.raises(SystemExit):
            main(args)
