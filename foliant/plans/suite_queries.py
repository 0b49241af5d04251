"""Queries that run the suites of gates and the assembly of schemes over papers made from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import glyphs, suites
from foliant.plans.grammar_queries import _NUMBERED, _str
from foliant.plans.record_queries import _PARTS, _case, _lines, _parted
from foliant.plans.registry import query, table
from foliant.sources import readers


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"))


@query(f"""
WITH {_NUMBERED}, docs AS (SELECT o_orderkey AS k FROM orders), a AS (SELECT k, i, CASE WHEN f <> 'N' OR k % 2 = 0 THEN q END AS t FROM n), b AS (SELECT k, i, q + CASE WHEN p % 50 = 0 THEN 1 ELSE 0 END AS t, s % 10 <> 0 AS ok FROM n),
w AS (SELECT k, sum(q) AS t FROM n WHERE k % 4 <> 0 GROUP BY k), o AS (SELECT k, i, CASE WHEN k % 9 = 0 AND i = 2 THEN t + 1 ELSE t END AS t FROM a WHERE NOT (k % 10 = 0 AND i = 3)), s AS (SELECT k, i, t FROM b WHERE NOT (k % 8 = 0 AND i = 1)),
r AS (SELECT k, i, q + CASE WHEN k % 12 = 0 THEN 1 ELSE 0 END AS t FROM n WHERE i = 1), ga AS (SELECT k, sum(t) AS sum, count(*) - count(t) AS missing FROM a GROUP BY k), gb AS (SELECT k, count(*) - count(t) AS missing, count(CASE WHEN NOT ok THEN 1 END) AS open FROM b GROUP BY k),
x AS (SELECT 'paper_totals_present' AS c, CASE WHEN missing = 0 THEN 'ok' ELSE 'fail' END AS v FROM docs LEFT JOIN ga USING (k)
  UNION ALL SELECT 'paper_sum_is_printed', CASE WHEN w.t = sum THEN 'ok' ELSE 'fail' END FROM docs LEFT JOIN ga USING (k) LEFT JOIN w USING (k)
  UNION ALL SELECT 'scheme_totals_present', CASE WHEN missing = 0 THEN 'ok' ELSE 'fail' END FROM docs LEFT JOIN gb USING (k) UNION ALL SELECT 'points_close', CASE WHEN open = 0 THEN 'ok' ELSE 'fail' END FROM docs LEFT JOIN gb USING (k)
  UNION ALL SELECT 'second_reader_agrees', CASE WHEN EXISTS (SELECT 1 FROM a FULL OUTER JOIN o ON a.k = o.k AND a.i = o.i WHERE coalesce(a.k, o.k) = docs.k AND (a.k IS NULL OR o.k IS NULL OR a.t IS DISTINCT FROM o.t)) THEN 'fail' ELSE 'ok' END FROM docs
  UNION ALL SELECT 'scheme_follows_layout', CASE WHEN EXISTS (SELECT 1 FROM b LEFT JOIN s ON b.k = s.k AND b.i = s.i WHERE b.k = docs.k AND s.k IS NULL) THEN 'fail' ELSE 'ok' END FROM docs
  UNION ALL SELECT 'as_referenced', CASE WHEN EXISTS (SELECT 1 FROM r LEFT JOIN a ON a.k = r.k AND a.i = r.i WHERE r.k = docs.k AND a.t IS DISTINCT FROM r.t) THEN 'fail' ELSE 'ok' END FROM docs
  UNION ALL SELECT 'totals_differ', 'review' FROM a JOIN b ON a.k = b.k AND a.i = b.i WHERE a.t IS DISTINCT FROM b.t)
SELECT c AS check_id, v AS severity, count(*) AS n FROM x GROUP BY c, v
""")
def marks_suite(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d).withColumn("doc_id", F.col("k")).withColumn("number", F.col("i"))
    k, i, q = F.col("k"), F.col("i"), F.col("q")
    total = F.when((F.col("f") != "N") | (k % 2 == 0), q)
    paper = x.select("doc_id", "number", total.alias("total"))
    scheme_total = q + F.when(F.col("p") % 50 == 0, 1).otherwise(0)
    scheme = x.select("doc_id", "number", scheme_total.alias("total"), (F.col("s") % 10 != 0).alias("arithmetic_ok"))
    witnesses = x.where(k % 4 != 0).groupBy("doc_id").agg(F.sum("q").alias("value"))
    second = x.where(~((k % 10 == 0) & (i == 3))).select("doc_id", "number",
        F.when((k % 9 == 0) & (i == 2), total + 1).otherwise(total).alias("total"))
    sequence = x.where(~((k % 8 == 0) & (i == 1))).select("doc_id", "number", scheme_total.alias("total"))
    reference = x.where(i == 1).select("doc_id", "number", (q + F.when(k % 12 == 0, 1).otherwise(0)).alias("total"))
    found = suites.marks(_documents(spark, d), paper, scheme, witnesses, sequence, second, reference)
    return found.groupBy("check_id", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {_NUMBERED}, docs AS (SELECT o_orderkey AS k FROM orders), b AS (SELECT k, i, CASE WHEN p % 40 = 0 THEN NULL ELSE q END AS t, s % 10 <> 0 AS ok, CASE WHEN q % 25 = 0 THEN 0 ELSE q END AS pts FROM n WHERE NOT (k % 6 = 0 AND i = 2)),
g AS (SELECT k, count(*) AS n, max(i) AS hi, count(*) - count(t) AS missing, count(CASE WHEN NOT ok THEN 1 END) AS open, count(CASE WHEN pts = 0 THEN 1 END) AS bare FROM b GROUP BY k),
r AS (SELECT k, count(DISTINCT i) AS refs, count(DISTINCT CASE WHEN s % 30 = 0 THEN i END) AS lost FROM n GROUP BY k), e AS (SELECT k, refs, lost, refs - lost AS files, CASE WHEN k % 7 = 0 THEN refs + 1 ELSE refs END AS emb FROM r)
SELECT CAST(docs.k AS VARCHAR) AS subject, concat_ws(',', CASE WHEN coalesce(emb, 0) <> coalesce(files, 0) THEN 'asset_count' END, CASE WHEN lost > 0 THEN 'asset_files' END, CASE WHEN g.k IS NULL OR n <> hi THEN 'continuous_scheme' END,
    CASE WHEN docs.k % 11 = 0 THEN 'labels_accounted' END, CASE WHEN g.k IS NULL OR open > 0 THEN 'points_close' END, CASE WHEN bare > 0 THEN 'questions_have_points' END, CASE WHEN g.k IS NULL OR missing > 0 THEN 'scheme_totals_present' END) AS failed
FROM docs LEFT JOIN g USING (k) LEFT JOIN e USING (k)
""")
def scheme_only_suite(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d).withColumn("doc_id", F.col("k"))
    docs = _documents(spark, d)
    scheme = x.where("not (k % 6 = 0 and i = 2)").select("doc_id", F.col("i").alias("number"),
        F.when(F.col("p") % 40 != 0, F.col("q")).alias("total"), (F.col("s") % 10 != 0).alias("arithmetic_ok"),
        F.when(F.col("q") % 25 == 0, 0).otherwise(F.col("q")).alias("n_points"))
    labels = docs.select("doc_id", (F.col("doc_id") % 11 != 0).alias("accounted"))
    refs = x.select("doc_id", _str("a/", F.col("i")).alias("path"))
    files = x.where("s % 30 <> 0").select("doc_id", _str("a/", F.col("i")).alias("path"))
    embedded = x.groupBy("doc_id").agg((F.count(F.lit(1)) + F.when(F.first("k") % 7 == 0, 1).otherwise(0)).alias("n"))
    return suites.verdicts(suites.scheme_only(docs, scheme, labels, refs, files, embedded)).select("subject",
        F.array_join("failed", ",").alias("failed"))


@query(f"""
WITH {_NUMBERED}, docs AS (SELECT o_orderkey AS k FROM orders), c AS (SELECT * FROM n WHERE NOT (k % 5 = 0 AND i = 1)),
x AS (SELECT 'no_more_questions' AS c, 'ok' AS v FROM docs
  UNION ALL SELECT 'no_more_points', CASE WHEN EXISTS (SELECT 1 FROM n WHERE n.k = docs.k) AND docs.k % 13 = 0 THEN 'fail' ELSE 'ok' END FROM docs
  UNION ALL SELECT 'same_marks', CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.k = docs.k AND p % 70 = 0) THEN 'fail' ELSE 'ok' END FROM docs
  UNION ALL SELECT 'same_totals', CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.k = docs.k AND (s % 60 = 0 OR (k % 17 = 0 AND i = 2))) THEN 'fail' ELSE 'ok' END FROM docs
  UNION ALL SELECT 'no_new_warnings', CASE WHEN EXISTS (SELECT 1 FROM n WHERE n.k = docs.k AND f = 'R' AND k % 3 = 0) THEN 'fail' ELSE 'ok' END FROM docs
  UNION ALL SELECT 'same_conflict', CASE WHEN docs.k % 4 = 1 THEN 'fail' ELSE 'ok' END FROM docs)
SELECT c AS check_id, v AS severity, count(*) AS n FROM x GROUP BY c, v
""")
def cleaned_suite(spark: SparkSession, d: str) -> DataFrame:
    """A cleaned draft lacks the first question of some papers; marks, totals, points and warnings move in others."""
    x = _lines(spark, d).withColumn("doc_id", F.col("k")).withColumn("number", F.col("i"))
    c = x.where("not (k % 5 = 0 and i = 1)")
    docs = _documents(spark, d)
    k, i = F.col("k"), F.col("i")
    label = F.when(i % 2 == 0, "a").alias("label")
    warn = lambda df, more: df.select("doc_id", F.explode(F.array_compact(F.array(F.lit("lost line: 3"),
        F.when(more, F.lit("odd mark: x")), F.lit("page 2 boilerplate-removed")))).alias("text"))
    raw = {
        "questions": x.select("doc_id", "number"), "parts": x.select("doc_id", "number", label,
        F.col("q").alias("marks")), "totals": x.where(~((k % 17 == 0) & (i == 2))).select("doc_id", "number",
        F.col("q").alias("total")),
        "points": x.select("doc_id"), "warnings": warn(x, F.lit(False)),
        "conflicts": docs.select("doc_id", F.when(F.col("doc_id") % 4 != 3,
        F.col("doc_id") % 4 == 2).alias("conflict"))}
    clean = {
        "questions": c.select("doc_id", "number"), "parts": c.select("doc_id", "number", label,
        (F.col("q") + F.when(F.col("p") % 70 == 0, 1).otherwise(0)).alias("marks")),
        "totals": c.select("doc_id", "number", (F.col("q") + F.when(F.col("s") % 60 == 0,
        1).otherwise(0)).alias("total")), "points": x.select("doc_id").union(x.where((k % 13 == 0)
        & (i == 1)).select("doc_id")),
        "warnings": warn(x, (F.col("f") == "R") & (k % 3 == 0)),
        "conflicts": docs.select("doc_id", (F.col("doc_id") % 4).isin(1, 2).alias("conflict"))}
    return suites.cleaned(raw, clean, docs).groupBy("check_id", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {_NUMBERED}, pr AS (SELECT k, count(*) + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS nq, sum(q) + CASE WHEN k % 8 = 0 THEN 1 ELSE 0 END AS m FROM n WHERE k % 20 <> 0 GROUP BY k), g AS (SELECT k, count(*) AS n, sum(q) AS s FROM n WHERE k % 25 <> 0 GROUP BY k),
b AS (SELECT coalesce(pr.k, g.k) AS k, nq, m, n, s FROM pr FULL OUTER JOIN g ON pr.k = g.k)
SELECT check_id, count(*) AS n FROM (SELECT 'unknown_paper' AS check_id FROM b WHERE nq IS NULL UNION ALL SELECT 'question_count' FROM b WHERE nq IS NOT NULL AND coalesce(n, 0) <> nq UNION ALL SELECT 'marks_total' FROM b WHERE nq IS NOT NULL AND coalesce(s, 0) <> coalesce(m, 0)
  UNION ALL SELECT 'repeated_part' FROM (SELECT p FROM n GROUP BY p HAVING count(*) > 1)) GROUP BY check_id
""")
def bank_battery(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d).withColumn("doc_id", F.col("k"))
    k = F.col("doc_id")
    products = x.where(k % 20 != 0).groupBy("doc_id").agg((F.count(F.lit(1)) + F.when(F.first("k") % 9 == 0,
        1).otherwise(0)).alias("n_questions"), (F.sum("q") + F.when(F.first("k") % 8 == 0,
        1).otherwise(0)).alias("marks"))
    questions = x.where(k % 25 != 0).select("doc_id", _str(F.col("k"), "/", F.col("i")).alias("id"),
        F.col("q").alias("marks"))
    found = suites.bank(products, questions, x.select("doc_id", F.col("p").alias("id")), questions.repartition(3))
    return found.groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT p_partkey, concat_ws('; ', CASE WHEN p_partkey % 5 = 0 THEN 'missing:role' END, CASE WHEN p_partkey % 7 = 0 THEN 'missing:description' END, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 5 = 1 THEN 'role' END, CASE WHEN p_partkey % 3 = 0 THEN 'provenance' END,
  CASE WHEN p_partkey % 2 = 0 AND p_partkey % 4 <> 0 THEN 'content without transcription or note' END, CASE WHEN p_partkey % 7 <= 1 THEN 'empty description' END) AS page,
  concat_ws('; ', CASE WHEN p_partkey % 7 = 0 THEN 'missing:description' END, CASE WHEN p_partkey % 3 = 0 THEN 'provenance' END, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 6 = 2 THEN 'answer without a note' END, CASE WHEN p_partkey % 7 <= 1 THEN 'empty description' END) AS figure FROM part
""")
def report_violations(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    given = table(spark, d, "part").select(
        "p_partkey", F.lit("x").alias("doc"), F.lit(1).alias("page"),
        _case((p % 5 == 0, None), (p % 5 == 1, "poster"), other="content").alias("role"),
        (p % 2 == 0).alias("has_question_content"),
        _case((p % 7 == 0, None), (p % 7 == 1, "  "), other="a page").alias("description"),
        F.when(p % 3 == 0, "hand").otherwise("llm-vision").alias("provenance"), F.lit(False).alias("review_required"),
        F.when(p % 4 == 0, "t.md").alias("transcription_ref"),
        F.lit("a.png").alias("png"), F.lit("00").alias("sha256"), F.lit("graph").alias("kind"),
        (p % 2 == 0).alias("carries_answer"), F.when(p % 6 == 2, "MS").otherwise("QP").alias("doc_kind"))
    return given.select("p_partkey", F.array_join(suites.page_report(given.columns), "; ").alias("page"),
        F.array_join(suites.figure_report(given.columns), "; ").alias("figure"))


@query(f"""
WITH {_PARTS}, a AS (SELECT k, i % 3 AS number, i, part, sub, q FROM x WHERE f <> 'N'), b AS (SELECT k, i % 3 AS number, i, part, sub, q + 1 AS q FROM x),
u AS (SELECT *, 'preferred' AS side FROM a UNION ALL SELECT *, 'fallback' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k = b.k AND a.number = b.number)),
g AS (SELECT k, number, side, sum(CASE WHEN part <> 'b' THEN q END) AS alone, sum(CASE WHEN part = 'b' THEN q END) AS pooled FROM u GROUP BY k, number, side)
SELECT k AS doc_id, number, side AS provenance, CASE WHEN side = 'preferred' THEN 5 + number ELSE 7 END AS printed, CAST(coalesce(alone, 0) + CASE WHEN pooled IS NULL THEN 0 ELSE least(pooled, 4) END AS BIGINT) AS sum,
  CASE WHEN side = 'preferred' THEN 5 + number ELSE 7 END = coalesce(alone, 0) + CASE WHEN pooled IS NULL THEN 0 ELSE least(pooled, 4) END AS verified FROM g
""")
def assembled_schemes(spark: SparkSession, d: str) -> DataFrame:
    """Points of a first reader where it has any of a question, else a second's; points of part b are a pool of four."""
    x = _parted(spark, d).withColumn("doc_id", F.col("key")).withColumn("number", F.col("i") % 3)
    point = lambda marks: [F.col("i").alias("ord"), _str("M", F.col("i")).alias("label"), "part", "sub",
        marks.alias("marks"), F.lit("t").alias("text")]
    totals = x.select("doc_id", "number").distinct().select("doc_id", "number",
        (5 + F.col("number")).alias("preferred"), F.lit(7).alias("fallback"))
    pools = x.where("part = 'b'").select("doc_id", "number", _str("M", F.col("i")).alias("label"),
        F.lit("b").alias("pool"), F.lit(4).alias("cap"))
    _, schemes = suites.assembled(x.where("f <> 'N'").select("doc_id", "number", *point(F.col("q"))),
        x.select("doc_id", "number", *point(F.col("q") + 1)), totals, pools)
    return schemes


@query(f"""
WITH {_NUMBERED}, q AS (SELECT k, i % 2 AS number, min(q) AS page, max(CASE WHEN f = 'R' THEN q END) AS printed FROM n GROUP BY k, i % 2),
e AS (SELECT k, number, 0 AS place, 0 AS pos, 'heading' AS role, 'Mark scheme for Question ' || number AS text, page FROM q
  UNION ALL SELECT k, number, 1, 0, 'paragraph', 'Question ' || number || ' printed total: ' || printed || ' marks' || CASE WHEN number = 0 THEN '' ELSE ' (verification FAILED)' END, page FROM q WHERE printed IS NOT NULL
  UNION ALL SELECT k, number, 2, 0, 'paragraph', 'Q' || number || ' guidance: see ' || number, page FROM q WHERE k % 2 = 0
  UNION ALL SELECT k, i % 2, 3, i, 'mark_point', 'Q' || (i % 2) || ' M' || i || ' (' || q || ' mark' || CASE WHEN q = 1 THEN '' ELSE 's' END || '): part ' || p || CASE WHEN f = 'A' THEN chr(10) || 'allow: x; y' ELSE '' END || CASE WHEN s % 2 = 0 THEN chr(10) || 'note: n' || i ELSE '' END, q FROM n),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY number, place, pos) - 1 AS ord FROM e)
SELECT k AS doc_id, CAST(ord AS INTEGER) AS ord, 'e' || lpad(CAST(ord AS VARCHAR), 6, '0') AS element_id, role, text, page, 'q' || number AS group_key FROM o
""")
def scheme_elements(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d).withColumn("doc_id", F.col("k")).withColumn("number", F.col("i") % 2)
    none = F.array().cast("array<string>")
    questions = (x.groupBy("doc_id", "number").agg(F.max(F.when(F.col("f") == "R", F.col("q"))).alias("printed"))
                 .withColumn("verified", F.col("number") == 0).withColumn("guidance",
                 F.when(F.col("doc_id") % 2 == 0, F.array(_str("see ", F.col("number")))).otherwise(none)))
    points = x.select("doc_id", "number", F.col("i").alias("ord"), _str("M", F.col("i")).alias("label"),
        F.col("q").alias("marks"), _str("part ", F.col("p")).alias("text"),
        F.when(F.col("f") == "A", F.array(F.lit("x"), F.lit("y"))).otherwise(none).alias("allow"),
                      none.alias("reject"), F.lit(None).cast("array<string>").alias("ignore"),
                      F.when(F.col("s") % 2 == 0, F.array(_str("n", F.col("i")))).alias("notes"),
                      F.col("q").alias("page"))
    return suites.scheme_elements(questions, points)


@query("""
SELECT doc_id, trim(translate(replace(replace(trim(t, ' ' || chr(9) || chr(10) || chr(13)), 'é', ''), 'ß', ''), 'ä', 'a'), ' ' || chr(9) || chr(10) || chr(13)) AS text,
  CAST(length(t) - length(replace(replace(t, 'é', ''), 'ß', '')) AS INTEGER) AS n_dropped, length(t) > length(replace(replace(t, 'é', ''), 'ß', '')) AS loss FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
""")
def rendered_glyphs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", glyphs.rendered(F.col("text"), {"ä": "a"}, ["é", "ß"]).alias("r")).select("doc_id", "r.*")


@query("""
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '# ' || c_name WHEN 1 THEN c_name || chr(10) || chr(10) || 'two' END AS text, CAST(CASE WHEN c_custkey % 6 = 1 THEN 2 ELSE 0 END AS INTEGER) AS n_pages,
  CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'no md_results' WHEN 3 THEN 'unexpected type' WHEN 4 THEN 'empty' ELSE 'no md_results' END AS problem FROM customer
""")
def service_responses(spark: SparkSession, d: str) -> DataFrame:
    c, name = F.col("c_custkey"), F.col("c_name")
    body = _case((c % 6 == 0, _str('{"id": 1, "md_results": "# ', name, '"}')),
        (c % 6 == 1, _str('{"md_results": ["', name, '", "two"], "x": 2}')), (c % 6 == 2, '{"other": "x"}'),
        (c % 6 == 3, '{"md_results": {"a": 1}}'), (c % 6 == 4, '{"md_results": " \\n "}'), other='{"md_results": null}')
    return table(spark, d, "customer").select("c_custkey",
        readers.response_markdown(body).alias("r")).select("c_custkey", "r.text", F.size("r.pages").alias("n_pages"),
        "r.problem")


@query("""
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'unknown' ELSE p_brand END AS version, count(*) AS n FROM part GROUP BY 1
""")
def engine_versions(spark: SparkSession, d: str) -> DataFrame:
    given = _case((F.col("p_partkey") % 6 == 0, None), (F.col("p_partkey") % 3 == 0, "  "),
        other=_str(F.col("p_brand"), " "))
    return table(spark, d,
        "part").select(readers.engine_version(given).alias("version")).groupBy("version").agg(F.count(F.lit(1)).alias("n"))
