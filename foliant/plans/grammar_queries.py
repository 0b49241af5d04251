"""Queries that run the document grammars: papers, schemes, outlines and notes are made from the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.operators import glyphs, markdown, outline, papers, schemes, sittings
from foliant.operators.shared import written
from foliant.plans.registry import query, table
from foliant.sources import readers


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each order numbered from 1: a line is a question, its quantity the marks."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("q"), "l_returnflag", F.row_number().over(w).alias("i"))


_NUMBERED = """n AS (SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, CAST(l_quantity AS INTEGER) AS q, l_returnflag AS f,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS i FROM lineitem)"""


def _joined(df: DataFrame, key: str, text: Column, order: str = "i") -> DataFrame:
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), text.alias("t")))),
        lambda x: x.t), "\n")
    return df.groupBy(F.col(key).cast("string").alias("doc_id")).agg(lines.alias("text"))


def _str(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _paper_texts(spark: SparkSession, d: str) -> DataFrame:
    """Questions in three numbering styles; returned lines have two parts, of q - 1 and 1 marks, else the total alone."""
    i, q = F.col("i"), F.col("q")
    opener = F.when(i % 3 == 0, _str(i, ": ")).when(i % 3 == 1, _str(i, " ")).otherwise(_str(i, ". "))
    parts = F.when((F.col("l_returnflag") == "R") & (q > 1),
        _str("\n(a) State part ", F.col("l_partkey"), ".\n(", q - 1, ")\n(b) Name supplier ", F.col("l_suppkey"),
        ".\n(1)")).otherwise("")
    total = F.when(F.col("l_returnflag") != "N", _str("\n(Total for Question ", i, " = ", q, " marks)")).otherwise("")
    return _joined(_numbered(spark, d), "l_orderkey",
        F.concat(opener, _str("Part ", F.col("l_partkey"), " was shipped."), parts, total))


def _scheme_texts(spark: SparkSession, d: str) -> DataFrame:
    """A table for each order; the printed totals differ by one where the part number divides by five."""
    i, q = F.col("i"), F.col("q")
    row = lambda label, answer, note, marks: F.concat(F.lit("<tr><td>"), label, F.lit("</td><td>"), answer,
        F.lit("</td><td>"), note, F.lit("</td><td>"), marks.cast("string"), F.lit("</td></tr>"))
    split = (F.col("l_returnflag") == "R") & (q > 1)
    rows = F.when(split, F.concat(row(_str(i, "(a)"), _str("part ", F.col("l_partkey"), " (1) or number"),
        F.lit("Allow other"), q - 1), row(_str("(b)"), _str("supplier ", F.col("l_suppkey")), F.lit("Ignore case"),
        F.lit(1)))).otherwise(
        row(_str(i), _str("part ", F.col("l_partkey"), " &amp; more"), F.lit("ECF"), q))
    total = F.concat(F.lit("<tr><td>Total for question "), i.cast("string"), F.lit("</td><td></td><td>"),
        (q + F.when(F.col("l_partkey") % 5 == 0, 1).otherwise(0)).cast("string"), F.lit("</td></tr>"))
    made = _joined(_numbered(spark, d), "l_orderkey", F.concat(rows, total))
    return made.withColumn("text", F.concat(F.lit("# Mark Scheme\n<table>"), F.regexp_replace("text", "\n", ""),
        F.lit("</table>")))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, count(*) AS n_elements, count(CASE WHEN starts_with(trim(raw, ' ' || chr(9) || chr(13)), '#') THEN 1 END) AS n_headings FROM l WHERE regexp_matches(raw, '[^\\s]') GROUP BY doc_id
""")
def markdown_elements(spark: SparkSession, d: str) -> DataFrame:
    e = markdown.elements(table(spark, d, "documents"))
    return e.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_elements"),
        F.count_if(F.col("kind") == "heading").alias("n_headings"))


@query(f"""
WITH {_NUMBERED}
SELECT CAST(k AS VARCHAR) AS doc_id, i AS number, CASE WHEN i % 3 = 0 THEN 'colon' WHEN i % 3 = 1 THEN 'space' ELSE 'dot' END AS style, 'Part ' || p || ' was shipped.' AS stem,
  CASE WHEN f = 'R' AND q > 1 THEN 2 ELSE 0 END AS n_parts, CASE WHEN f = 'N' THEN 0 ELSE q END AS marks, f <> 'N' AS marks_known, CAST(CASE WHEN f = 'R' AND q > 1 THEN 0.75 WHEN f <> 'N' THEN 0.6 ELSE 0.45 END AS DOUBLE) AS confidence FROM n
""")
def paper_questions(spark: SparkSession, d: str) -> DataFrame:
    q = papers.drafted_texts(_paper_texts(spark, d)).select(F.explode("questions").alias("q")).select("q.*")
    return q.select("doc_id", "number", "style", "stem", F.size("parts").alias("n_parts"), "marks", "marks_known",
        "confidence")


@query(f"""
WITH {_NUMBERED}
SELECT CAST(k AS VARCHAR) AS doc_id, CAST(count(*) AS INTEGER) AS n_questions, CAST(count(CASE WHEN f <> 'N' THEN 1 END) AS INTEGER) AS n_totals, CAST(coalesce(sum(CASE WHEN f <> 'N' THEN q END), 0) AS INTEGER) AS total FROM n GROUP BY k
""")
def paper_totals(spark: SparkSession, d: str) -> DataFrame:
    p = papers.drafted_texts(_paper_texts(spark, d))
    return p.select("doc_id", "n_questions", F.size("totals").alias("n_totals"),
        F.aggregate(F.map_values("totals"), F.lit(0), lambda s, x: s + x).alias("total"))


@query(f"""
WITH {_NUMBERED}
SELECT CAST(k AS VARCHAR) AS doc_id, i || '(a)' AS label, i AS number, 'part ' || p || ' (1) or number' AS answer, 2 AS n_points, 'allow' AS kind, q - 1 AS marks, 'label row' AS marks_source FROM n WHERE f = 'R' AND q > 1
UNION ALL SELECT CAST(k AS VARCHAR), i || '(b)', i, 'supplier ' || s, 0, 'ignore', 1, 'continuation label row' FROM n WHERE f = 'R' AND q > 1
UNION ALL SELECT CAST(k AS VARCHAR), i || '', i, 'part ' || p || ' & more', 0, 'ecf', q, 'label row' FROM n WHERE NOT (f = 'R' AND q > 1)
""")
def scheme_entries(spark: SparkSession, d: str) -> DataFrame:
    e = schemes.drafted_texts(_scheme_texts(spark, d)).select(F.explode("entries").alias("e")).select("e.*")
    return e.select("doc_id", "label", "number", "answer", F.size("points").alias("n_points"),
        F.col("guidance")[0]["kind"].alias("kind"), "marks", "marks_source")


def _sitting(spark: SparkSession, d: str, numbers_only: bool = False) -> tuple[DataFrame, DataFrame, DataFrame,
        DataFrame]:
    """Papers, schemes, questions and entries; each side is read once and kept as a table, since all joins go over it.

    numbers_only keeps of questions and entries what gates on marks read.
    """
    qp, ms = papers.drafted_texts(_paper_texts(spark, d)), schemes.drafted_texts(_scheme_texts(spark, d))
    if numbers_only:
        part = lambda p: F.struct(p.label.alias("label"), p.marks.alias("marks"))
        qp = qp.select("doc_id", "session", "reference", "paper_total", "totals", "n_questions",
            F.transform("questions", lambda q: F.struct(q.number.alias("number"),
            F.transform(q.parts, part).alias("parts"))).alias("questions"))
        ms = ms.select("doc_id", "session", "reference", "paper_total", "totals",
            F.transform("entries", lambda e: F.struct(e.number.alias("number"))).alias("entries"))
    qp, ms = (written(x.withColumn("pair", F.col("doc_id")), n) for x, n in ((qp, "papers"), (ms, "schemes")))
    questions = qp.select("pair", F.explode("questions").alias("q")).select("pair", "q.*")
    entries = ms.select("pair", F.posexplode("entries").alias("ord", "e")).select("pair", "ord", "e.*")
    return qp.drop("questions"), ms.drop("entries"), questions, entries


@query(f"""
WITH {_NUMBERED}
SELECT CAST(k AS VARCHAR) AS pair, i AS number, '(a)' AS suffix, 'Part ' || p || ' was shipped.' || chr(10) || chr(10) || 'State part ' || p || '.' AS prompt, i || '(a)' AS entry FROM n WHERE f = 'R' AND q > 1
UNION ALL SELECT CAST(k AS VARCHAR), i, '(b)', 'Part ' || p || ' was shipped.' || chr(10) || chr(10) || 'Name supplier ' || s || '.', i || '(b)' FROM n WHERE f = 'R' AND q > 1
""")
def sitting_bind(spark: SparkSession, d: str) -> DataFrame:
    _, _, questions, entries = _sitting(spark, d)
    bound, _, _ = sittings.bind(questions, entries)
    return bound.select("pair", "number", "suffix", "prompt", F.col("entry.label").alias("entry"))


@query(f"""
WITH {_NUMBERED}, j AS (SELECT k, i, CASE WHEN f <> 'N' THEN q END AS a, q + CASE WHEN p % 5 = 0 THEN 1 ELSE 0 END AS b FROM n)
SELECT CASE WHEN a IS NULL THEN 'ms-only' WHEN a = b THEN 'match' ELSE 'mismatch' END AS severity, count(*) AS n, CAST(sum(b) AS BIGINT) AS ms_marks FROM j GROUP BY 1
""")
def sitting_findings(spark: SparkSession, d: str) -> DataFrame:
    found = sittings.mark_findings(*_sitting(spark, d, True))
    return found.groupBy("severity").agg(F.count(F.lit(1)).alias("n"), F.sum("ms_marks").alias("ms_marks"))


@query(f"""
WITH {_NUMBERED}, g AS (SELECT CAST(k AS VARCHAR) AS pair, max(CASE WHEN f <> 'N' AND p % 5 = 0 THEN 1 ELSE 0 END) AS bad FROM n GROUP BY k)
SELECT pair, CASE WHEN bad = 1 THEN 'fail' ELSE 'review' END AS status FROM g
""")
def sitting_health(spark: SparkSession, d: str) -> DataFrame:
    return sittings.pair_status(sittings.health(*_sitting(spark, d, True))).select("pair", "status")


@query(f"""
WITH {_NUMBERED}, x AS (SELECT 'totals_agree' AS code, 'fail' AS severity FROM n WHERE f <> 'N' AND p % 5 = 0 UNION ALL SELECT 'mismatch', 'fail' FROM n WHERE f <> 'N' AND p % 5 = 0
  UNION ALL SELECT 'ms-only', 'review' FROM n WHERE f = 'N' UNION ALL SELECT DISTINCT 'paper_total', 'review' FROM n WHERE false)
SELECT code, severity, count(*) AS n FROM x GROUP BY ALL UNION ALL SELECT 'paper_total', 'review', count(DISTINCT k) FROM n
""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    sides = _sitting(spark, d, True)
    queue = sittings.review_queue(sittings.health(*sides), sittings.mark_findings(*sides))
    return queue.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH n AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) AS t FROM nation)
SELECT 1 AS level, 'U' || (r_regionkey + 1) AS code, CAST(NULL AS VARCHAR) AS parent, r_name AS title FROM region
UNION ALL SELECT 2, 'U' || (n_regionkey + 1) || '-T' || (n_nationkey + 1), 'U' || (n_regionkey + 1), n_name FROM n
UNION ALL SELECT 3, 'U' || (n_regionkey + 1) || '-T' || (n_nationkey + 1) || '-S' || (n_nationkey + 1) || 'A', 'U' || (n_regionkey + 1) || '-T' || (n_nationkey + 1), 'About ' || n_name FROM n
""")
def printed_outline(spark: SparkSession, d: str) -> DataFrame:
    units = table(spark, d, "region").select(F.col("r_regionkey").alias("r"), F.lit(-1).alias("t"), F.lit(0).alias("s"),
        _str("# Unit ", F.col("r_regionkey") + 1, ": ", F.col("r_name")).alias("line"))
    nations = table(spark, d, "nation")
    topics = nations.select("n_regionkey", "n_nationkey", F.lit(0),
        _str("## Topic ", F.col("n_nationkey") + 1, " ", F.col("n_name")))
    subs = nations.select("n_regionkey", "n_nationkey", F.lit(1),
        _str(F.col("n_nationkey") + 1, "A About ", F.col("n_name")))
    text = units.union(topics).union(subs).withColumn("i", F.struct("r", "t", "s")).withColumn("k", F.lit("syllabus"))
    return outline.printed_outline(markdown.elements(_joined(text, "k", F.col("line")))).select("level", "code",
        "parent", "title")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'rn_' || c_custkey END AS note_id, CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS n_violations, 'Body of ' || c_name AS body FROM customer
""")
def revision_notes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    head = F.concat(F.lit("---\n"), F.when(k % 4 == 0, "").otherwise(_str("note_id: rn_", k, "\n")),
        _str("title: \"", F.col("c_name"), "\"\nsource: ", F.col("c_mktsegment"),
        "\npath: a/b\nspec_point_ids: [\"x\"]\nspec_point_codes: [\"y\"]\nguided_study: no\nupdated_at: "),
        F.when(k % 3 == 0, "soon").otherwise("2025-01-02"))
    docs = table(spark, d, "customer").select(k.alias("k"),
        F.concat(head, F.lit("\n---\n\n"), _str("Body of ", F.col("c_name"))).alias("text"))
    return readers.notes(docs, "k").select("k", F.element_at("meta", "note_id").alias("note_id"),
        F.size("violations").alias("n_violations"), "body")


@query(r"""
WITH RECURSIVE n AS (SELECT page_id, page_id // 50 AS f, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', ''), '^.*/', '') AS name,
             row_number() OVER (PARTITION BY page_id // 50 ORDER BY page_id) AS i FROM pages),
s AS (SELECT f, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS page_id, CAST([] AS VARCHAR[]) AS used FROM (SELECT DISTINCT f FROM n)
  UNION ALL SELECT s.f, n.i, n.page_id, list_append(used, CASE WHEN NOT list_contains(used, name) THEN name WHEN NOT list_contains(used, 'p' || n.i || '_' || name) THEN 'p' || n.i || '_' || name
    ELSE 'crop_' || n.i || '.bin' END) FROM s JOIN n ON n.f = s.f AND n.i = s.i + 1)
SELECT page_id, used[len(used)] AS unique_name FROM s WHERE i > 0
""")
def unique_names(spark: SparkSession, d: str) -> DataFrame:
    """Last parts of addresses as names of images, fifty pages to a folder."""
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/$", ""), "^.*/", "")
    rows = table(spark, d, "pages").select("page_id", name.alias("name"), F.floor(F.col("page_id") / 50).alias("f"))
    return readers.unique_names(rows, "f", "name", "page_id").select("page_id", "unique_name")


@query(r"""
WITH p AS (SELECT doc_id, string_split(replace(text, '. ', chr(12)), chr(12)) AS xs FROM documents),
k AS (SELECT doc_id, CASE WHEN xs[len(xs)] = '' THEN xs[1:len(xs) - 1] ELSE xs END AS xs FROM p)
SELECT doc_id, CAST(len(xs) AS BIGINT) AS n_pages, CAST(coalesce(list_sum(list_transform(xs, lambda x: length(x))), 0) AS BIGINT) AS n_chars FROM k
""")
def layout_pages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit("\f")).alias("text"))
    return readers.layout_pages(docs, "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"),
        F.sum(F.length("text")).alias("n_chars"))


@query("""
WITH u AS (SELECT unnest(regexp_extract_all(text, 'ung|ble|th|é')) AS glyph FROM documents)
SELECT glyph, count(*) AS n, CASE WHEN length(glyph) > 1 THEN 'sequence' WHEN glyph = 'é' THEN 'drop' ELSE 'substitution' END AS kind FROM u GROUP BY glyph
""")
def glyph_accounting(spark: SparkSession, d: str) -> DataFrame:
    return glyphs.accounting(table(spark, d, "documents"), "text", {"ble": "B", "ung": "U", "th": "T", "é": ""})


@query("""
WITH c AS (SELECT d.doc_id, d.lang, coalesce(l.toxic = 1, false) AS edited, coalesce(l.quality = 0, false) AS wanted FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, CASE WHEN edited THEN lang || '!' WHEN wanted THEN upper(lang) ELSE lang END AS lang, edited AND wanted AS conflict FROM c
""")
def guarded_update(spark: SparkSession, d: str) -> DataFrame:
    """Languages of poor documents are to be set in capitals; toxic ones were edited since the snapshot."""
    snapshot = table(spark, d, "documents").select("doc_id", "lang")
    labels = table(spark, d, "labels")
    edited = labels.where("toxic = 1").select("doc_id").withColumn("edited", F.lit(True))
    current = snapshot.join(edited, "doc_id", "left").select("doc_id",
        F.when(F.col("edited"), F.concat("lang", F.lit("!"))).otherwise(F.col("lang")).alias("lang"))
    update = snapshot.join(labels.where("quality = 0").select("doc_id"), "doc_id", "left_semi").withColumn("lang",
        F.upper("lang"))
    out, conflicts = glyphs.guarded_update(current, snapshot, update, "doc_id", "lang")
    return out.join(conflicts.withColumn("conflict", F.lit(True)), "doc_id", "left").select("doc_id", "lang",
        F.coalesce("conflict", F.lit(False)).alias("conflict"))
