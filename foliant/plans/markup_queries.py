"""Queries over every form that the markdown, paper and scheme grammars read, and over the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text
from foliant.operators import markdown, papers, schemes, sittings
from foliant.plans.grammar_queries import _str
from foliant.plans.record_queries import _case
from foliant.plans.registry import query, table
from foliant.sources import readers


def _customers(spark: SparkSession, d: str, *parts) -> DataFrame:
    """(doc_id, text): a text of parts for each customer."""
    return table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"),
        _str(*parts).alias("text"))


def _markup(spark: SparkSession, d: str) -> DataFrame:
    """Headings, paragraphs, lists, centred blocks, figures, tables, display mathematics, references; open ones too."""
    c, name = F.col("c_custkey"), F.col("c_name")
    odd = _case((c % 4 == 0, "$$\nopen\n## After"), (c % 4 == 1, "<div align='center'>\nlost\n## After"),
        (c % 4 == 2, "<table><tr><td>cut</td></tr>\n<tr><td>off\n## After"), other="## After")
    return _customers(
        spark, d, "# ", name, "\n\nfirst &lt;", c,
        "&gt; &#65;\n- item\n* star\n<div align=\"center\">\n## Mid\nin the middle\n</div>\n$$\nx = ", c,
        "\n$$\n$$a$$ $$b$$\nsay $$c$$ here\n",
        "<div style=\"text-align: center;\"><img src='https://h/p/im%20", c,
        ".PNG?Signature=s&Expires=1' alt='pic' /></div>\n<table border=1>\n<tr><th>h &amp; i</th><td>", c,
        "<br/>z</td></tr>\n<tr></tr></table>\n", odd)


@query("""
WITH c AS (SELECT c_custkey AS c, c_name AS name FROM customer),
r AS (SELECT c, unnest(['heading', 'paragraph', 'list_item', 'list_item', 'heading', 'paragraph', 'equation', 'equation', 'equation', 'paragraph', 'figure', 'table']
    || CASE c % 4 WHEN 0 THEN ['paragraph', 'heading'] WHEN 1 THEN ['paragraph', 'heading'] WHEN 2 THEN ['table', 'paragraph', 'heading'] ELSE ['heading'] END) AS kind,
  unnest([name, 'first <' || c || '> A', 'item', 'star', 'Mid', 'in the middle', 'x = ' || c, 'a', 'b', 'say $$c$$ here', NULL, 'h & i|' || c || chr(10) || 'z/']
    || CASE c % 4 WHEN 0 THEN ['open', 'After'] WHEN 1 THEN ['lost', 'After'] WHEN 2 THEN ['cut', '<tr><td>off', 'After'] ELSE ['After'] END) AS said,
  unnest([1, NULL, NULL, NULL, 2, NULL, NULL, NULL, NULL, NULL, NULL, NULL] || CASE WHEN c % 4 = 2 THEN [NULL, NULL, 2] WHEN c % 4 = 3 THEN [2] ELSE [NULL, 2] END) AS level,
  generate_subscripts(CASE c % 4 WHEN 2 THEN range(15) WHEN 3 THEN range(13) ELSE range(14) END, 1) - 1 AS ord FROM c)
SELECT CAST(c AS VARCHAR) AS doc_id, CAST(ord AS INTEGER) AS ord, kind, said, level, CASE WHEN kind = 'figure' THEN 'im ' || c || '.PNG' END AS source_name, CASE WHEN kind = 'figure' THEN 'png' END AS format FROM r
""")
def markup_elements(spark: SparkSession, d: str) -> DataFrame:
    rows = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/")
    return markdown.elements(_markup(spark, d)).select("doc_id", "ord", "kind", F.coalesce("text", rows).alias("said"),
        "level", "source_name", "format")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, CAST(18 + CASE c_custkey % 4 WHEN 3 THEN 1 ELSE 3 END AS INTEGER) AS source_lines, 2 AS entity_lines, 1 AS signed_urls, CAST(CASE WHEN c_custkey % 4 = 2 THEN 1 ELSE 0 END AS INTEGER) AS open_tables,
  CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS orphan_fences, CAST(CASE WHEN c_custkey % 4 = 1 THEN 1 ELSE 0 END AS INTEGER) AS open_divs, 1 AS mixed_math_lines FROM customer
""")
def markup_provenance(spark: SparkSession, d: str) -> DataFrame:
    return markdown.provenance(_markup(spark, d))


@query("""
WITH c AS (SELECT c_custkey AS c, c_name AS name FROM customer)
SELECT CAST(c AS VARCHAR) AS doc_id, unnest([1, 2, 3]) AS section, unnest([name, 'Mid', 'After']) AS heading, unnest([1, 2, 2]) AS level, unnest([3, CASE WHEN c % 4 = 3 THEN 2 ELSE 3 END, 0]) AS n FROM c
""")
def markup_sections(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs and list items below each heading; what an open fence, block or table leaves is one more below the second."""
    found = markdown.sections(markdown.elements(_markup(spark, d)))
    return found.select("doc_id", F.col("section").cast("int").alias("section"), "heading", "level",
        F.size("element_ids").alias("n"))


@query("""
WITH n AS (SELECT l_orderkey AS k, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS i, l_partkey AS p, l_suppkey AS s FROM lineitem),
e AS (SELECT k, CASE WHEN i = 3 THEN 2 ELSE i END - 1 AS ord, i, p, s FROM n)
SELECT check_id, count(*) AS n FROM (SELECT 'repeated_ord' AS check_id FROM (SELECT k, ord FROM e GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'repeated_element_id' FROM (SELECT k, ord FROM e GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'order_gap' FROM (SELECT k FROM e GROUP BY k HAVING min(ord) <> 0 OR max(ord) + 1 <> count(DISTINCT ord))
  UNION ALL SELECT CASE WHEN i % 3 = 0 THEN 'incomplete_table' WHEN i % 3 = 1 THEN 'incomplete_figure' ELSE 'incomplete_heading' END FROM e WHERE p % 10 = 0) GROUP BY check_id
""")
def markup_violations(spark: SparkSession, d: str) -> DataFrame:
    from foliant.plans.record_queries import _lines

    i, whole = F.col("i"), F.col("p") % 10 != 0
    at = F.when(i == 3, 2).otherwise(i) - 1
    kind = F.when(i % 3 == 0, "table").when(i % 3 == 1, "figure").otherwise("heading")
    found = _lines(spark, d).select(
        F.col("k").alias("doc_id"), at.alias("ord"), _str("e", at).alias("element_id"), kind.alias("kind"),
        F.lit("t").alias("text"), F.when(whole, 1).alias("level"),
        F.when(whole, F.array(F.array(F.lit("a")))).alias("rows"), F.when(whole, "u").alias("url"))
    return markdown.violations(found).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


def _papers(spark: SparkSession, d: str) -> DataFrame:
    """Sections, a starred choice, parts with a damaged label and a roman one, answer prompts, sources, gaps, all totals."""
    c = F.col("c_custkey")
    choice = F.when(c % 2 == 0, "A red\nB blue\nC green\nD grey").otherwise("A red\nB blue")
    return _customers(
        spark, d, "Paper Reference 4CH1/", c % 2 + 1, "C\n# Section A\n*1 Which is it, ", c, "?\n", choice,
        "\n(Total for Question 1 = 1 marks)\n2. Look.\n(a) Say.\n(2)\nb) Half.\n(i) Roman.\nmass =\n(1)\n(Source: © Somebody)\n",
        "# Section B\n# 3 From a heading\nA\nB\n9 Gap\n# Odd heading\n(Total for Question 2 = ",
        F.when(c % 3 == 0, 3).otherwise(4), " marks)\nTOTAL FOR SECTION A = 9 MARKS\nTOTAL FOR PAPER = ", c % 50 + 10,
        " MARKS")


@query("""
WITH c AS (SELECT c_custkey AS c FROM customer)
SELECT CAST(c AS VARCHAR) AS doc_id, 1 AS number, 'space' AS style, 'A' AS section, 'Which is it, ' || c || '?' || CASE WHEN c % 2 = 0 THEN '' ELSE ' A red B blue' END AS stem, c % 2 = 0 AS mcq, true AS qwc, CASE WHEN c % 2 = 0 THEN 4 ELSE 0 END AS n_options, '' AS parts, 1 AS marks, true AS marks_known,
  CAST(CASE WHEN c % 2 = 0 THEN 0.8 ELSE 0.6 END AS DOUBLE) AS confidence FROM c
UNION ALL SELECT CAST(c AS VARCHAR), 2, 'dot', 'A', 'Look.', false, false, 0, 'a=2|b=|b-i=1 mass', CASE WHEN c % 3 = 0 THEN 3 ELSE 4 END, true, CAST(0.6 AS DOUBLE) FROM c
UNION ALL SELECT CAST(c AS VARCHAR), 3, 'space', 'B', 'From a heading 9 Gap', false, false, 0, '', 0, false, CAST(0.45 AS DOUBLE) FROM c
""")
def paper_forms(spark: SparkSession, d: str) -> DataFrame:
    q = papers.drafted_texts(_papers(spark, d)).select(F.explode("questions").alias("q")).select("q.*")
    part = lambda p: F.concat(p.label, F.lit("="), F.coalesce(p.marks.cast("string"), F.lit("")),
        F.when(F.size(p.prompts) > 0, F.concat(F.lit(" "), F.array_join(p.prompts, ","))).otherwise(""))
    return q.select("doc_id", "number", "style", "section", "stem", "mcq", "qwc", F.size("options").alias("n_options"),
        F.array_join(F.transform("parts", part), "|").alias("parts"), "marks", "marks_known", "confidence")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, '4CH1/' || (c_custkey % 2 + 1) || 'C' AS reference, CAST(c_custkey % 50 + 10 AS INTEGER) AS paper_total, 9 AS section_a, CAST(CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 4 END AS INTEGER) AS total_2,
  3 AS n_questions, CAST(6 + CASE WHEN c_custkey % 2 = 1 THEN 1 ELSE 0 END AS INTEGER) AS n_warnings FROM customer
""")
def paper_headers(spark: SparkSession, d: str) -> DataFrame:
    p = papers.drafted_texts(_papers(spark, d))
    return p.select("doc_id", "reference", "paper_total", F.element_at("section_totals", "A").alias("section_a"),
        F.element_at("totals", F.lit(2)).alias("total_2"), "n_questions", F.size("warnings").alias("n_warnings"))


def _schemes(spark: SparkSession, d: str) -> DataFrame:
    """A starred entry, a part that carries on, a choice, marks in a row of their own, totals in three forms."""
    c = F.col("c_custkey")
    row = lambda *cells: F.concat(F.lit("<tr>"),
        *[F.concat(F.lit("<td>"), x if not isinstance(x, str) else F.lit(x), F.lit("</td>")) for x in cells],
        F.lit("</tr>"))
    rows = F.concat(
        row("*1(a)", _str("first (1) or other ", c, " (2)"), "Allow x", "3"),
        row("(ii)", "any two from: p (1) q (1)", "MP2 dependent on MP1\nno ecf", "2"),
        row("2", _str("The only correct answer is ", F.when(c % 2 == 0, "B").otherwise("C")), "", "1"),
        row("3", "long", "note", ""), row(F.when(c % 3 == 0, "4").otherwise("2")), row("Total", "", "5"))
    return _customers(spark, d, "# Mark Scheme\nJune 2019\n<table>", rows,
        "</table>\nTotal for question 1 = 5 marks\nTOTAL FOR PAPER = ", c % 40 + 11, " MARKS")


@query("""
WITH c AS (SELECT c_custkey AS c FROM customer)
SELECT CAST(c AS VARCHAR) AS doc_id, '*1(a)' AS label, 1 AS number, 'first (1) or other ' || c || ' (2)' AS answer, 3 AS marks, 'label row' AS marks_source, true AS qwc, CAST(NULL AS VARCHAR) AS correct, '1::|2:other ' || c || ':' AS points, 'allow' AS kinds, CAST(0.75 AS DOUBLE) AS confidence FROM c
UNION ALL SELECT CAST(c AS VARCHAR), '1(a)(ii)', 1, 'any two from: p (1) q (1)', 2, 'continuation label row', false, NULL, '1::two|1::', 'dependent,note', CAST(0.75 AS DOUBLE) FROM c
UNION ALL SELECT CAST(c AS VARCHAR), '2', 2, 'The only correct answer is ' || CASE WHEN c % 2 = 0 THEN 'B' ELSE 'C' END, 1, 'label row', false, CASE WHEN c % 2 = 0 THEN 'B' ELSE 'C' END, '', '', CAST(0.85 AS DOUBLE) FROM c
UNION ALL SELECT CAST(c AS VARCHAR), '3', 3, 'long', CASE WHEN c % 3 = 0 THEN 4 ELSE 2 END, 'rowspan continuation row', false, NULL, '', 'note', CAST(0.75 AS DOUBLE) FROM c
""")
def scheme_forms(spark: SparkSession, d: str) -> DataFrame:
    e = schemes.drafted_texts(_schemes(spark, d)).select(F.explode("entries").alias("e")).select("e.*")
    point = lambda p: F.concat(p.marks.cast("string"), F.lit(":"), F.array_join(p.alternatives, ","), F.lit(":"),
        F.when(p.any_two, "two").otherwise(""))
    return e.select("doc_id", "label", "number", "answer", "marks", "marks_source", "qwc", "correct",
        F.array_join(F.transform("points", point), "|").alias("points"),
        F.array_join(F.transform("guidance", lambda g: g.kind), ",").alias("kinds"), "confidence")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, 'June 2019' AS session, CAST(c_custkey % 40 + 11 AS INTEGER) AS paper_total, 5 AS total_1, 5 AS total_3 FROM customer
""")
def scheme_headers(spark: SparkSession, d: str) -> DataFrame:
    s = schemes.drafted_texts(_schemes(spark, d))
    return s.select("doc_id", "session", "paper_total", F.element_at("totals", F.lit(1)).alias("total_1"),
        F.element_at("totals", F.lit(3)).alias("total_3"))


@query("""
WITH p AS (SELECT p_partkey AS p, p_name AS name FROM part)
SELECT p, CASE p % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'C' WHEN 2 THEN 'D' WHEN 3 THEN 'e' END AS letter, CASE WHEN p % 2 = 0 THEN 'ab cd' ELSE 'a b word' END AS closed, CAST(p % 4 AS INTEGER) AS formulas,
  CASE p % 4 WHEN 0 THEN '(a)(i)' WHEN 1 THEN '(b)(ii)' WHEN 2 THEN '' ELSE '(c)' END AS suffix, CASE p % 6 WHEN 0 THEN 'allow' WHEN 1 THEN 'ignore' WHEN 2 THEN 'example-diagram' WHEN 3 THEN 'ecf' WHEN 4 THEN 'dependent' ELSE 'note' END AS guidance,
  CASE p % 4 WHEN 0 THEN name || '.' WHEN 1 THEN 'the ' || name WHEN 2 THEN name ELSE 'plain ' || name END AS note FROM p
""")
def text_scalars(spark: SparkSession, d: str) -> DataFrame:
    p, name = F.col("p_partkey"), F.col("p_name")
    return table(spark, d, "part").select(
        p.alias("p"), text.correct_letter(_case((p % 5 == 0, " (B) "), (p % 5 == 1, "The only correct answer is C"),
        (p % 5 == 2, "answer is: D."), (p % 5 == 3, "e"), other="B or C")).alias("letter"),
        text.collapse_spaced(F.when(p % 2 == 0, "a b  c d").otherwise("a b word")).alias("closed"),
        text.inline_math_count(F.concat(F.lit("cost \\$"),
        F.repeat(F.lit(" $x$"), (p % 4).cast("int")))).alias("formulas"),
        text.suffix(_case((p % 4 == 0, "3(a)(i)"), (p % 4 == 1, "b-ii"), (p % 4 == 2, "*14"),
        other="(C)")).alias("suffix"),
        text.guidance_kind(_case((p % 6 == 0, " Allow this"), (p % 6 == 1, "IGNORE that"),
        (p % 6 == 2, "Example graph below"), (p % 6 == 3, "ecf from a"), (p % 6 == 4, "MP2 is dependent on MP1"),
        other="see a")).alias("guidance"),
        text.note_text(_case((p % 4 == 0, _str("do not accept: ", name, ".")), (p % 4 == 1, _str("Allow — the ", name)),
        (p % 4 == 2, _str("ignore ", name)), other=_str("plain ", name))).alias("note"))


@query("""
SELECT c_custkey AS c, unnest(['u/' || c_custkey || '.png', 'v/' || c_custkey || '.jpg', 'https://h/crop' || c_custkey || '.webp?x=1']) AS url, unnest([0, 1, 2]) AS at FROM customer
""")
def crop_addresses(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    body = _str("![a](u/", c, ".png) <img alt='x' src=\"v/", c, ".jpg\"> ![b](u/", c, ".png)")
    return table(spark, d, "customer").select(c.alias("c"),
        F.posexplode(readers.crop_urls(body, _str("see https://h/crop", c, ".webp?x=1 now"))).alias("at",
        "url")).select("c", "url", "at")


@query("""
SELECT c_custkey AS c, '{"b":' || c_custkey || ',"a":"' || c_name || '"' || CASE WHEN c_custkey % 2 = 0 THEN ',"t":"2024-01-02T03:04:05.000Z"' ELSE '' END || '}' AS json FROM customer
""")
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    from foliant.sources import sinks

    c = F.col("c_custkey")
    rows = table(spark, d, "customer").select(c.alias("c"), c.alias("b"), F.col("c_name").alias("a"),
        F.when(c % 2 == 0, F.lit("2024-01-02 03:04:05").cast("timestamp")).alias("t"))
    return rows.select("c", sinks.canonical_json(rows, ["b", "a", "t"]).alias("json"))


@query("""
WITH n AS (SELECT l_orderkey AS k, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS i, l_returnflag AS f FROM lineitem)
SELECT CAST(k AS VARCHAR) AS pair, CAST(count(CASE WHEN f <> 'R' THEN 1 END) AS BIGINT) AS lone_parts, count(CASE WHEN f = 'A' THEN 1 END) AS lone_entries FROM n GROUP BY k HAVING count(CASE WHEN f <> 'R' THEN 1 END) > 0
""")
def binding_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Parts without an entry and entries without a part: N lines have no entry, A lines one of another part."""
    from foliant.plans.record_queries import _lines

    x = _lines(spark, d).select(F.col("k").cast("string").alias("pair"), F.col("i").alias("number"), "f")
    part = F.struct(F.lit("a").alias("label"), F.lit("text").alias("text"), F.lit(1).alias("marks"))
    questions = x.select("pair", "number", _str("q", F.col("number")).alias("question_id"), F.lit("stem").alias("stem"),
        F.array(part).alias("parts"))
    entries = x.where("f <> 'N'").select(
        "pair", "number", F.col("number").alias("ord"), _str("e", F.col("number")).alias("entry_id"),
        _str(F.col("number"), F.when(F.col("f") == "R", "(a)").otherwise("(z)")).alias("label"),
        F.lit("x").alias("answer"),
        F.array().cast("array<string>").alias("points"), F.array().cast("array<string>").alias("guidance"),
        F.lit(1).alias("marks"), F.lit(0.5).alias("confidence"))
    bound, _, unmatched = sittings.bind(questions, entries)
    lone = F.col("warning").startswith("Q")
    return sittings.binding_warnings(bound, unmatched).groupBy("pair").agg(F.count_if(lone).alias("lone_parts"),
        F.count_if(~lone).alias("lone_entries"))
