"""Queries over packages, inventories, manifests and parsers by media type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import gates, glyphs
from foliant.plans.grammar_queries import _NUMBERED, _str
from foliant.plans.record_queries import _case, _lines
from foliant.plans.registry import query, table
from foliant.sources import engines, package


@query(f"""
WITH {_NUMBERED}, o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 50 <> 0)
SELECT check_id, count(*) AS n FROM (
  SELECT 'missing_table' AS check_id FROM (SELECT unnest(['package_metadata', 'resource', 'resource_version', 'resource_provenance', 'specification_point', 'revision_note', 'revision_note_specification_point', 'parser_run', 'validation_finding']))
  UNION ALL SELECT 'unknown_table' UNION ALL SELECT 'required:paper' FROM o WHERE k % 7 = 0 UNION ALL SELECT 'dangling:paper_question:paper' FROM n WHERE k % 50 = 0
  UNION ALL SELECT 'repeated:paper_question' FROM (SELECT k, least(i, 3) FROM n GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'dangling:question_part:paper_question' FROM n WHERE s % 9 = 0
  UNION ALL SELECT 'repeated:mark_scheme' FROM (SELECT o_orderkey // 4 FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'dangling:mark_scheme:paper' FROM orders WHERE o_orderkey % 50 = 0
  UNION ALL SELECT 'missing_column:mark_point' UNION ALL SELECT 'dangling:mark_point:question_part' FROM n WHERE f = 'R' AND p % 6 = 0) GROUP BY check_id
""")
def package_checks(spark: SparkSession, d: str) -> DataFrame:
    """A package of papers with planted faults: lost papers, ordinals twice, parts and points that hang in the air."""
    x = _lines(spark, d)
    k, i = F.col("k"), F.col("i")
    order = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    qid = _str(k, "/", i)
    tables = {
        "paper": order.where(k % 50 != 0).select(k.alias("paper_id"), F.when(k % 7 != 0, "VALIDATED").alias("status")),
        "paper_question": x.select(qid.alias("question_id"), k.alias("paper_id"), F.least(i, F.lit(3)).alias("ordinal"),
        F.lit("VALIDATED").alias("status")),
        "question_part": x.select(_str(qid, "a").alias("question_part_id"),
        F.when(F.col("s") % 9 == 0, _str("lost ", qid)).otherwise(qid).alias("question_id"), F.lit("a").alias("anchor"),
        F.lit(1).alias("ordinal"), F.lit("ok").alias("status")),
        "mark_scheme": order.select(F.floor(k / 4).alias("mark_scheme_id"), k.alias("paper_id"),
        F.lit("00").alias("content_sha256"), F.lit("ok").alias("status")),
        "mark_point": x.select(_str(qid, "-p").alias("mark_point_id"), F.floor(k / 4).alias("mark_scheme_id"),
        F.when(F.col("f") == "R", F.when(F.col("p") % 6 == 0,
        "none").otherwise(_str(qid, "a"))).alias("question_part_id"), F.lit("ok").alias("status")),
        "pictures": order}
    return package.findings(tables).withColumn("check_id",
        F.col("check_id")).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH o AS (SELECT o_orderkey AS k FROM orders)
SELECT check_id, count(*) AS n FROM (SELECT 'paper_status' AS check_id FROM o WHERE k % 7 = 0 UNION ALL SELECT 'paper_identity' FROM o WHERE k % 11 = 0 OR k % 30 = 0 UNION ALL SELECT 'scheme_identity' FROM o WHERE k % 30 = 0
  UNION ALL SELECT 'version_status' FROM lineitem WHERE l_partkey % 40 = 0 UNION ALL SELECT 'scheme_status' FROM lineitem WHERE l_suppkey % 25 = 0 OR l_suppkey % 35 = 0) GROUP BY check_id
UNION ALL SELECT 'no_points', count(*) FROM lineitem WHERE l_returnflag = 'N'
""")
def inventory_gates(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    papers = table(spark, d, "orders").select(k.alias("paper_id"),
        F.when(k % 7 == 0, "DRAFT").otherwise("VALIDATED").alias("status"), _str("q", k).alias("qp_document_id"),
        _str("m", k).alias("ms_document_id"))
    identities = table(spark, d, "orders").where(k % 30 != 0).select(k.alias("paper_id"),
        F.when(k % 11 == 0, "other").otherwise(_str("q", k)).alias("qp_document_id"),
        _str("m", k).alias("ms_document_id"))
    x = _lines(spark, d)
    vid = _str(F.col("k"), "/", F.col("i"))
    versions = x.select(F.col("k").alias("paper_id"), vid.alias("version_id"),
        F.when(F.col("p") % 40 == 0, None).otherwise("VALIDATED").alias("status"),
        F.when(F.col("s") % 25 != 0, F.col("s")).alias("scheme_id"),
        F.when(F.col("s") % 35 == 0, "DRAFT").otherwise("VALIDATED").alias("scheme_status"))
    points = x.where("f <> 'N'").select(vid.alias("version_id"))
    return package.inventory_findings(papers, versions, points,
        identities).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {_NUMBERED} SELECT k AS version_id, i AS ord, CASE WHEN f = 'N' THEN 'MP-' || i WHEN f = 'A' THEN CAST(i AS VARCHAR) ELSE i || '-b-ii' END AS anchor, CASE WHEN f = 'R' THEN 'b-ii' END AS part FROM n
""")
def inventory_points(spark: SparkSession, d: str) -> DataFrame:
    f, i = F.col("f"), F.col("i")
    points = _lines(spark, d).select(F.col("k").alias("version_id"), i.alias("ord"),
        _case((f == "N", None), (f == "A", i.cast("string")), other=_str(i, "-b-ii")).alias("reference"))
    return package.inventory_points(points).select("version_id", "ord", "anchor", "part")


@query(f"""
WITH {_NUMBERED}, t AS (SELECT k, string_agg(CASE WHEN f = 'R' THEN repeat('#', i % 3 + 1) || ' ' ELSE '' END || 'part ' || p, chr(10) || chr(10) ORDER BY i) || chr(10) AS md FROM n GROUP BY k)
SELECT k AS doc_id, md AS markdown, sha256(md) AS sha256 FROM t
""")
def rendered_elements(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d)
    heading = F.col("f") == "R"
    return package.rendered(x.select(F.col("k").alias("doc_id"), F.col("i").alias("ord"),
        F.when(heading, "heading").otherwise("paragraph").alias("kind"),
        F.when(heading, F.col("i") % 3 + 1).alias("level"), _str("part ", F.col("p")).alias("text")))


@query(f"""
WITH {_NUMBERED}, a AS (SELECT k, i, CASE WHEN f = 'N' THEN NULL ELSE '{{"name":"c' || i || '.png","sha256":"' || p || '","bytes":' || q || '}}' END AS ok, CASE WHEN f = 'N' THEN '{{"name":"c' || i || '.png","reason":"gone"}}' END AS bad FROM n),
g AS (SELECT k, string_agg(ok, ',' ORDER BY i) AS ok, string_agg(bad, ',' ORDER BY i) AS bad FROM a GROUP BY k)
SELECT o_orderkey AS doc_id, '{{"manifest_version":2,"role":"qp","sha256":"s' || o_orderkey || '","n_pages":' || (o_orderkey % 9) || ',"engine":"layout","engine_version":"unknown","assets":[' || coalesce(ok, '') || '],"unfetched":[' || coalesce(bad, '') || ']}}' AS manifest
FROM orders LEFT JOIN g ON o_orderkey = k
""")
def manifests(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    docs = table(spark, d, "orders").select(k.alias("doc_id"), F.lit("qp").alias("role"), _str("s", k).alias("sha256"),
        (k % 9).alias("n_pages"))
    lost = F.col("f") == "N"
    assets = _lines(spark, d).select(F.col("k").alias("doc_id"), F.col("i").alias("ord"),
        _str("c", F.col("i"), ".png").alias("name"), F.when(~lost, F.col("p").cast("string")).alias("sha256"),
        F.when(~lost, F.col("q").cast("long")).alias("bytes"), F.when(lost, "gone").alias("reason"))
    return package.manifest(docs, assets, "layout")


@query("""
WITH p AS (SELECT p_partkey AS p, CASE p_partkey % 4 WHEN 0 THEN 'text/markdown' WHEN 1 THEN 'application/json' WHEN 2 THEN 'text/x-revision-note' ELSE 'application/octet-stream' END AS mime FROM part)
SELECT mime, kind, count(*) AS n FROM (SELECT mime, unnest(CASE p % 4 WHEN 0 THEN ['heading', 'paragraph'] WHEN 1 THEN ['heading'] WHEN 2 THEN ['list_item', 'paragraph'] ELSE ['set aside'] END) AS kind FROM p) GROUP BY mime, kind
""")
def parsed_by_media_type(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    path = _case((p % 4 == 0, _str("/x/", p, ".md")), (p % 4 == 1, _str("/x/", p, ".JSON")),
        (p % 4 == 2, _str("/x/notes/", p, ".md")), other=_str("/x/", p, ".bin"))
    body = _case((p % 4 == 0, _str("# Part ", p, "\n\ntext")),
        (p % 4 == 1, _str('{"kids": [{"type": "heading", "content": "', p, '"}]}')),
        (p % 4 == 2, _str("- item ", p, "\n\nwords")), other=p.cast("string"))
    files = table(spark, d, "part").select(path.alias("path"), engines.media_type(path).alias("mime"),
        body.cast("binary").alias("content"))
    found, aside = engines.parse(files)
    ids = engines.identified(files, "2025-01-01T00:00:00Z").select("doc_id", "mime").distinct()
    rows = found.join(ids, "doc_id").select("mime", "kind").union(aside.select("mime", F.lit("set aside")))
    return rows.groupBy("mime", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH c AS (SELECT c_custkey AS k, c_custkey % 3 AS a, c_custkey % 4 AS b FROM customer)
SELECT k, 'private' AS kind, CAST(57344 + k % 5 AS INTEGER) AS code_point, a AS n FROM c WHERE a > 0 AND k % 5 <> 0 UNION ALL SELECT k, 'control', CAST(1 + k % 7 AS INTEGER), b FROM c WHERE b > 0
""")
def glyph_census(spark: SparkSession, d: str) -> DataFrame:
    """Private-use characters that a table lacks, and controls, by text."""
    k = F.col("c_custkey")
    glyph = F.element_at(F.array(*[F.lit(chr(0xE000 + j)) for j in range(5)]), (k % 5 + 1).cast("int"))
    control = F.element_at(F.array(*[F.lit(chr(1 + j)) for j in range(7)]), (k % 7 + 1).cast("int"))
    docs = table(spark, d, "customer").select(k.alias("k"),
        F.concat(F.lit("a\tb"), F.repeat(glyph, (k % 3).cast("int")), F.lit("\n"),
        F.repeat(control, (k % 4).cast("int"))).alias("text"))
    return glyphs.census(docs, "k", "text", {"\ue000": "x"}).select("k", "kind", "code_point", "n")


@query("""
WITH c AS (SELECT c_custkey AS k, c_nationkey AS batch, CASE WHEN c_custkey % 9 = 0 THEN 2 ELSE 0 END + CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 0 END AS n FROM customer)
SELECT batch, count(*) AS n_texts, CAST(sum(n) AS BIGINT) AS n_artifacts, sum(n) = 0 AS passed, coalesce(string_agg(CASE WHEN n > 0 THEN CAST(k AS VARCHAR) END, ',' ORDER BY k), '') AS failed FROM c GROUP BY batch
""")
def glyph_gate(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    said = F.concat(F.lit("text"), F.when(k % 9 == 0, "\ue001\uf8ff").otherwise(""),
        F.when(k % 8 == 0, "\x02").otherwise(""))
    docs = table(spark, d, "customer").select(k.alias("k"), F.col("c_nationkey").alias("batch"), said.alias("text"))
    return glyphs.gate(docs, "k", "text", F.col("batch")).withColumn("failed",
        F.array_join(F.transform("failed", lambda x: x.cast("string")), ","))


@query(r"""
WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}')) AS ts, list_distinct(list_concat(regexp_extract_all(lower(source), '[a-z]{3,}'), ['the', 'and', 'ing', 'der', 'que', 'est', 'ion'])) AS ok FROM documents)
SELECT doc_id, CAST(len(list_filter(ts, lambda x: NOT list_contains(ok, x))) AS INTEGER) AS n_ungrounded, len(list_filter(ts, lambda x: NOT list_contains(ok, x))) = 0 AS grounded FROM t
""")
def grounded_tokens(spark: SparkSession, d: str) -> DataFrame:
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{3,}"), F.lit(0)))
    allowed = F.concat(tokens("source"), F.array(*map(F.lit, ("the", "and", "ing", "der", "que", "est", "ion"))))
    found = gates.grounded(table(spark, d, "documents"), tokens("text"), allowed)
    return found.select("doc_id", F.size("ungrounded").alias("n_ungrounded"), "grounded")
