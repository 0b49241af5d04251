"""Queries over validators, post-gates, line streams and drafts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import bridges, glyphs, records, suites
from foliant.plans.grammar_queries import _NUMBERED, _str
from foliant.plans.record_queries import _PARTS, _case, _lines, _parted
from foliant.plans.registry import query, table
from foliant.sources import package, readers


@query(f"""
WITH {_NUMBERED}, q AS (SELECT k, i, q + CASE WHEN p % 30 = 0 THEN 1 ELSE 0 END AS total, q AS sum FROM n WHERE NOT (k % 6 = 0 AND i = 2)), docs AS (SELECT o_orderkey AS k FROM orders),
o AS (SELECT k, count(*) AS n, max(i) AS hi FROM q GROUP BY k)
SELECT check_id, count(*) AS n FROM (SELECT 'schema:point' AS check_id FROM n WHERE s % 40 = 0 OR s % 33 = 0 UNION ALL SELECT 'schema:part' FROM n WHERE s % 21 = 0
  UNION ALL SELECT 'closure:parts' FROM q JOIN n USING (k, i) WHERE f <> 'N' AND q.total <> n.q UNION ALL SELECT 'closure:points' FROM q WHERE total <> sum
  UNION ALL SELECT 'census:numbers' FROM docs LEFT JOIN o USING (k) WHERE o.k IS NULL OR n <> hi UNION ALL SELECT 'census:parts' FROM (SELECT k, least(i, 4) AS j FROM n WHERE s % 21 <> 0 GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'assets:missing' FROM n WHERE p % 13 = 0 UNION ALL SELECT 'assets:unused' FROM n WHERE p % 17 = 0 AND p % 13 <> 0) GROUP BY check_id
""")
def atoms_validator(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d).withColumn("doc_id", F.col("k")).withColumn("number", F.col("i"))
    q, i, p, s = F.col("q"), F.col("i"), F.col("p"), F.col("s")
    questions = x.where("not (k % 6 = 0 and i = 2)").select("doc_id", "number",
        (q + F.when(p % 30 == 0, 1).otherwise(0)).alias("total"), q.alias("sum"))
    parts = x.select("doc_id", "number", F.when(s % 21 != 0, _str("p", F.least(i, F.lit(4)))).alias("part_id"),
        F.when(F.col("f") != "N", q).alias("marks"))
    points = x.select("doc_id", "number", F.when(s % 33 != 0, q).alias("marks"),
        F.when(s % 40 == 0, " ").otherwise("t").alias("text"))
    refs = x.where(p % 17 != 0).select("doc_id",
        _str("a", i).alias("path")).union(x.where((p % 17 == 0) & (p % 13 == 0)).select("doc_id", _str("a", i)))
    files = x.where(p % 13 != 0).select("doc_id", _str("a", i).alias("path"))
    docs = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return suites.atoms(docs, questions, parts, points, refs,
        files).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH p AS (SELECT p_partkey AS p FROM part)
SELECT check_id, severity, detail, count(*) AS n FROM (SELECT 'pair' AS check_id, 'fail' AS severity, CASE WHEN p % 9 = 0 THEN 'no paper' ELSE 'no scheme' END AS detail FROM p WHERE p % 9 = 0 OR p % 8 = 0
  UNION ALL SELECT 'file', CASE WHEN p % 10 = 1 THEN 'review' ELSE 'fail' END, CASE WHEN p % 10 = 1 THEN 'stray' WHEN p % 11 = 2 THEN 'missing' ELSE 'changed' END FROM p WHERE (p % 10 = 1) <> (p % 11 = 2) OR (p % 10 <> 1 AND p % 11 <> 2 AND p % 12 = 0)
  UNION ALL SELECT 'anchor', 'fail', 'x' FROM p WHERE p % 11 = 2) GROUP BY ALL
""")
def corpus_verification(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    part = table(spark, d, "part")
    path = _str("f/", p)
    pairs = part.select(p.alias("key"), F.when(p % 9 != 0, "a").alias("qp"), F.when(p % 8 != 0, "b").alias("ms"))
    manifest = part.where(p % 10 != 1).select(path.alias("path"), F.lit("00").alias("sha256"))
    files = part.where(p % 11 != 2).select(path.alias("path"),
        F.when(p % 12 == 0, "11").otherwise("00").alias("sha256"))
    anchors = part.select(_str("clean/", p).alias("path"), path.alias("raw_path"))
    found = suites.corpus(pairs, manifest, files, anchors)
    return found.withColumn("detail", F.when(F.col("check_id") == "anchor",
        "x").otherwise(F.col("detail"))).groupBy("check_id", "severity", "detail").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH c AS (SELECT c_custkey AS k FROM customer)
SELECT problem, count(*) AS n FROM (SELECT 'lost' AS problem FROM c WHERE k % 20 = 0 UNION ALL SELECT 'new' FROM c WHERE k % 25 = 1 AND k % 20 <> 0 UNION ALL SELECT 'residual' FROM c WHERE k % 7 = 0 AND k % 20 <> 0
  UNION ALL SELECT 'unexpected' FROM c WHERE k % 2 = 0 AND (k % 20 = 0 OR k % 7 = 0 OR k % 11 = 0) UNION ALL SELECT 'unplanned' FROM c WHERE k % 2 = 1 AND k % 20 <> 0 AND k % 25 <> 1 AND (k % 7 = 0 OR k % 11 = 0)
  UNION ALL SELECT 'control' FROM c WHERE k % 3 = 0 AND (k % 20 = 0 OR k % 25 = 1 OR k % 2 = 0 OR k % 7 = 0 OR k % 11 = 0)) GROUP BY problem
""")
def post_gates(spark: SparkSession, d: str) -> DataFrame:
    """Even rows were to be changed; every seventh has a glyph left, every eleventh other words; some are lost or new."""
    k = F.col("c_custkey")
    base = table(spark, d, "customer").select(k.alias("k"), F.col("c_name").alias("t"))
    before = base.where("k % 25 <> 1 or k % 20 = 0")
    planned = F.concat(F.lit("new "), "t")
    x = F.col("k")
    now = F.when(x % 7 == 0, F.concat("t", F.lit("\ue010"))).when(x % 11 == 0, F.lit("other")).when(x % 2 == 0,
        planned).otherwise(F.col("t"))
    after = base.where("k % 20 <> 0").withColumn("t", now)
    found = glyphs.post_gates(before, after, base.where("k % 2 = 0").withColumn("t", planned), base.where("k % 3 = 0"),
        "k", "t")
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    """R lines are tables of two rows, A lines texts of two lines, N lines blank."""
    f, i, p = F.col("f"), F.col("i"), F.col("p")
    cells = F.array(F.array(_str("a ", i, "\n x"), F.lit("")), F.array(_str("part ", p)))
    return _lines(spark, d).select(F.col("k").alias("doc_id"), i.alias("ord"),
        F.when(f == "R", "table").otherwise("paragraph").alias("kind"), F.when(f == "R", cells).alias("rows"),
        _case((f == "A", _str("one ", i, "\n two"))).alias("text"))


@query(f"""
WITH {_NUMBERED}
SELECT k AS doc_id, i AS ord, unnest([0, 0, 2]) AS cell, unnest([0, 1, 0]) AS line, unnest(['a ' || i, 'x', 'part ' || p]) AS text FROM n WHERE f = 'R'
""")
def cell_lines(spark: SparkSession, d: str) -> DataFrame:
    return bridges.cell_lines(_mixed(spark, d))


@query(f"""
WITH {_NUMBERED}, r AS (SELECT k, i, unnest(CASE f WHEN 'R' THEN ['a ' || i || ' x', 'part ' || p] WHEN 'A' THEN ['one ' || i, 'two'] ELSE [] END) AS raw, unnest(CASE f WHEN 'N' THEN [] ELSE [0, 1] END) AS pos FROM n)
SELECT k AS doc_id, CAST(row_number() OVER (PARTITION BY k ORDER BY i, pos) - 1 AS INTEGER) AS line_no, raw FROM r
""")
def line_stream(spark: SparkSession, d: str) -> DataFrame:
    return bridges.line_stream(_mixed(spark, d))


@query(f"""
WITH {_NUMBERED} SELECT k AS doc_id, i AS ord, 'e' || i AS element_id, CASE f WHEN 'R' THEN 'texts' WHEN 'A' THEN 'tables' ELSE 'figures' END AS kind FROM n
""")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    e = F.struct(F.col("i").cast("int").alias("ord"), _str("e", F.col("i")).alias("element_id"))
    of = lambda f: F.collect_list(F.when(F.col("f") == f, e))
    docs = _lines(spark, d).groupBy(F.col("k").alias("doc_id")).agg(of("R").alias("texts"), of("A").alias("tables"),
        of("N").alias("figures")).withColumn("equations", F.lit(None).cast("array<struct<ord:int,element_id:string>>"))
    return records.reading_order(docs, ["texts", "tables", "figures", "equations"])


@query(f"""
WITH {_PARTS}, m AS (SELECT *, CASE WHEN f = 'N' THEN 0 ELSE q END AS marks FROM x), o AS (SELECT *, min(CASE WHEN marks > 0 THEN i END) OVER (PARTITION BY k, part, sub) AS first FROM m),
g AS (SELECT k, part, sub, CASE WHEN marks = 0 AND first IS NOT NULL THEN first ELSE i END AS ord, count(*) - 1 AS n FROM o GROUP BY ALL)
SELECT k AS key, part, sub, ord, CASE WHEN ord % 3 = 0 THEN '[any two] ' ELSE '' END || 'point ' || ord AS text, n AS n_alternatives, CASE WHEN ord = min(ord) OVER (PARTITION BY k) AND k % 2 = 0 THEN 1 ELSE 0 END AS n_guidance FROM g
""")
def draft_points(spark: SparkSession, d: str) -> DataFrame:
    x = _parted(spark, d)
    points = x.select("key", "part", "sub", F.col("i").alias("ord"),
        F.when(F.col("f") == "N", 0).otherwise(F.col("q")).alias("marks"), _str("point ", F.col("i")).alias("text"))
    pools = x.where("i % 3 = 0").select("key", F.col("i").alias("ord"), F.lit("any two").alias("rule"))
    guidance = x.where("key % 2 = 0").select("key").distinct().select("key", F.array(F.lit("see below")).alias("text"))
    found = records.draft_points(points, pools, guidance)
    return found.select("key", "part", "sub", "ord", "text",
        F.size("alternatives").cast("long").alias("n_alternatives"), F.size("guidance").alias("n_guidance"))


@query(f"""
WITH {_PARTS}, a AS (SELECT k, part, min('id' || i) AS pid FROM x WHERE f <> 'N' GROUP BY k, part)
SELECT x.k AS question_id, i, CASE WHEN q % 4 = 0 THEN NULL ELSE x.part END AS part, CASE WHEN q % 4 = 0 THEN NULL ELSE pid END AS question_part_id FROM x LEFT JOIN a ON a.k = x.k AND a.part = x.part
""")
def linked_points(spark: SparkSession, d: str) -> DataFrame:
    x = _parted(spark, d)
    parts = x.where("f <> 'N'").select(F.col("key").alias("question_id"), F.col("part").alias("anchor"),
        _str("id", F.col("i")).alias("question_part_id"))
    points = x.select(F.col("key").alias("question_id"), "i", F.when(F.col("q") % 4 != 0, F.col("part")).alias("part"))
    return package.linked_points(points, parts).select("question_id", "i", "part", "question_part_id")


@query("""
SELECT p_partkey AS p, CASE p_partkey % 5 WHEN 0 THEN 'im ' || p_partkey || '.PNG' WHEN 1 THEN p_partkey || '.jpg' WHEN 2 THEN 'a+b' || p_partkey || '.gif' WHEN 3 THEN 'plain' || p_partkey ELSE 'bad%zz.png' END AS source_name,
  CASE p_partkey % 5 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' WHEN 2 THEN 'gif' WHEN 4 THEN 'png' END AS format FROM part
""")
def figure_names(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    url = _case((p % 5 == 0, _str("https://h.example/x/im%20", p, ".PNG?Signature=a/b.c")),
        (p % 5 == 1, _str("crops/", p, ".jpg#top")), (p % 5 == 2, _str("http://h/a+b", p, ".gif")),
        (p % 5 == 3, _str("plain", p)), other="bad%zz.png")
    return table(spark, d, "part").select(p.alias("p"), readers.figure_name(url).alias("r")).select("p", "r.*")
