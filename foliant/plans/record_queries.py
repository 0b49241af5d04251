"""Queries that run the operators on layout blocks, records, ledgers and files, made from the star schema by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import identity
from foliant.operators import atoms, bridges, corpus, gates, glyphs, lines, notes, reconcile, records
from foliant.plans.grammar_queries import _NUMBERED, _numbered, _str
from foliant.plans.registry import query, table
from foliant.sources import readers


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """(k, i, p, s, q, f): lines of orders numbered from 1."""
    return _numbered(spark, d).select(F.col("l_orderkey").alias("k"), "i", F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"), "q", F.col("l_returnflag").alias("f"))


def _case(*pairs: tuple[Column, str | Column | None], other: str | Column | None = None) -> Column:
    out = F
    for when, value in pairs:
        out = out.when(when, value if isinstance(value, Column) else F.lit(value))
    return out.otherwise(other if isinstance(other, Column) else F.lit(other))


# Layout blocks

@query(f"""
WITH {_NUMBERED}, b AS (SELECT k, k * 100 + i AS id, f <> 'N' AS t, p % 50 AS x0, s % 100 AS y0, p % 50 + 10 + q AS x1, s % 100 + 5 + i AS y1 FROM n),
g AS (SELECT DISTINCT b.id FROM b a JOIN b ON a.k = b.k AND a.t AND b.t AND (a.y0, a.x0, a.id) < (b.y0, b.x0, b.id)
      AND least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0)
      AND 2 * (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) > least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0))),
kept AS (SELECT * FROM b WHERE t AND id NOT IN (SELECT id FROM g))
SELECT id, 'table' AS kind FROM kept
UNION ALL SELECT id, 'line' FROM b WHERE NOT t AND NOT EXISTS (SELECT 1 FROM kept c WHERE c.k = b.k AND b.x0 >= c.x0 AND b.x1 <= c.x1 AND b.y0 >= c.y0 AND b.y1 <= c.y1)
""")
def drop_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order as boxes of a page: not returned ones are text lines, the others tables."""
    x = _lines(spark, d)
    box = {"x0": F.col("p") % 50, "y0": F.col("s") % 100, "x1": F.col("p") % 50 + 10 + F.col("q"),
        "y1": F.col("s") % 100 + 5 + F.col("i")}
    blocks = x.select("k", (F.col("k") * 100 + F.col("i")).alias("id"),
        F.when(F.col("f") != "N", "table").otherwise("line").alias("kind"), F.lit("words").alias("text"),
        *[c.alias(n) for n, c in box.items()])
    return atoms.drop_overlaps(blocks, ["k"]).select("id", "kind")


@query("""
WITH t AS (SELECT CASE p_partkey % 8 WHEN 0 THEN 'exact' WHEN 1 THEN 'exact' WHEN 2 THEN 'prefix' WHEN 3 THEN 'exact' WHEN 4 THEN 'total' WHEN 5 THEN 'exact' ELSE NULL END AS kind FROM part)
SELECT kind, count(*) AS n FROM t GROUP BY kind
""")
def furniture_lines(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("p_partkey") % 8
    text = _case((m == 0, "Turn  over"), (m == 1, " BLANK PAGE. "), (m == 2, "Do not write in this area, please"),
        (m == 3, "Answer ALL questions..."), (m == 4, "(Total for Question 3 = 7 marks)"), (m == 5, "pmt"),
        other=F.col("p_name"))
    return table(spark, d,
        "part").select(atoms.furniture(text).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH b AS (SELECT CAST(l_quantity AS INTEGER) * 20 AS w, l_partkey % 60 AS h FROM lineitem)
SELECT count(*) AS n, count(CASE WHEN least(w, h) > 0 AND greatest(w, h) >= 200 AND greatest(w, h) >= 8 * least(w, h) THEN 1 END) AS n_bars FROM b
""")
def furniture_images(spark: SparkSession, d: str) -> DataFrame:
    bar = atoms.furniture_image(F.col("l_quantity").cast("int") * 20, F.col("l_partkey") % 60)
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"), F.count_if(bar).alias("n_bars"))


@query("""
SELECT l_orderkey AS doc_id, count(*) AS n_pages, count(CASE WHEN l_discount * 10 > 0.55 AND l_quantity * 10 < 250 THEN 1 END) AS n_scanned,
  2 * count(CASE WHEN l_discount * 10 > 0.55 AND l_quantity * 10 < 250 THEN 1 END) > count(*) AS scanned FROM lineitem GROUP BY l_orderkey
""")
def page_kinds(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"),
        (F.col("l_discount") * 10).alias("coverage"), (F.col("l_quantity") * 10).alias("n_chars"))
    return atoms.page_kinds(pages)


@query(f"""
WITH {_NUMBERED}, m AS (SELECT *, max(i) OVER (PARTITION BY k) AS last FROM n)
SELECT CAST(k AS VARCHAR) AS doc_id, i AS number, i AS first_page, CAST(CASE WHEN i = last AND f = 'A' THEN last + 1 ELSE i END AS INTEGER) AS last_page, CASE WHEN f <> 'N' THEN q END AS total, 2 AS n_lines FROM m
""")
def layout_segments(spark: SparkSession, d: str) -> DataFrame:
    """A page for each question; totals of A lines are printed behind the last page, others where they belong."""
    x = _lines(spark, d)
    last = x.groupBy("k").agg(F.max("i").alias("last"))
    line = lambda page, y, text: F.struct(page.cast("int").alias("page"), y.cast("double").alias("y0"),
        F.lit(10.0).alias("x0"), text.alias("text"))
    i = F.col("i")
    total = _str("(Total for Question ", i, " = ", F.col("q"), " marks)")
    each = F.filter(F.array(
        line(i, F.lit(10), _str(i, " Part ", F.col("p"))), line(i, F.lit(20), F.lit("is shipped.")),
        line(i, F.lit(790), F.lit("9 of the footer")),
        F.when(F.col("f") == "R", line(i, F.lit(30), total)),
        F.when(F.col("f") == "A", line(F.col("last") + 1, i * 5, total))), lambda r: r.isNotNull())
    rows = x.join(last, "k").select(F.col("k").cast("string").alias("doc_id"),
        F.explode(each).alias("r")).select("doc_id", "r.*")
    return atoms.segments(rows)


@query(f"""
WITH {_NUMBERED}, a AS (SELECT k, i, q AS t FROM n WHERE i % 7 <> 0), b AS (SELECT k, i, q + CASE WHEN s % 13 = 0 THEN 1 ELSE 0 END AS t FROM n WHERE p % 11 <> 0),
j AS (SELECT coalesce(a.k, b.k) AS doc_id, coalesce(a.i, b.i) AS number, CASE WHEN b.k IS NULL THEN 'first_only' WHEN a.k IS NULL THEN 'second_only' WHEN a.t <> b.t THEN 'total' END AS problem
      FROM a FULL OUTER JOIN b ON a.k = b.k AND a.i = b.i)
SELECT * FROM j WHERE problem IS NOT NULL
""")
def segment_disagreements(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d)
    keys = [F.col("k").alias("doc_id"), F.col("i").alias("number")]
    a = x.where("i % 7 <> 0").select(*keys, F.col("q").alias("total"))
    b = x.where("p % 11 <> 0").select(*keys, (F.col("q") + F.when(F.col("s") % 13 == 0, 1).otherwise(0)).alias("total"))
    return atoms.cross_check(a, b)


_PARTS = f"""{_NUMBERED}, x AS (SELECT k, chr(97 + CAST(i % 3 AS INTEGER)) AS part, CASE WHEN s % 2 = 0 THEN NULL WHEN p % 2 = 0 THEN 'i' ELSE 'ii' END AS sub, q, f, i FROM n)"""


def _parted(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select(
        F.col("k").alias("key"), F.element_at(F.array(*map(F.lit, "abc")),
        (F.col("i") % 3 + 1).cast("int")).alias("part"),
        F.when(F.col("s") % 2 == 0, None).when(F.col("p") % 2 == 0, "i").otherwise("ii").alias("sub"), "q", "f", "i")


@query(f"""
WITH {_PARTS}, p AS (SELECT k, part, sub, max(CASE WHEN f = 'R' THEN q END) AS marks FROM x GROUP BY k, part, sub),
e AS (SELECT k, part, sub, sum(q) AS exact FROM x WHERE f <> 'A' GROUP BY k, part, sub), l AS (SELECT k, part, sum(q) AS letter, count(DISTINCT sub) AS subs FROM x WHERE f <> 'A' GROUP BY k, part),
j AS (SELECT p.k, p.part, p.sub, coalesce(marks, exact, CASE WHEN subs = 0 THEN letter END, CASE WHEN p.sub IS NOT NULL THEN 1 ELSE coalesce(letter, 1) END) AS marks
      FROM p LEFT JOIN e ON p.k = e.k AND p.part = e.part AND p.sub IS NOT DISTINCT FROM e.sub LEFT JOIN l ON p.k = l.k AND p.part = l.part),
s AS (SELECT k, part, sum(marks) AS t FROM j WHERE sub IS NOT NULL GROUP BY k, part)
SELECT j.k AS key, j.part, j.sub, CAST(CASE WHEN j.sub IS NULL AND t IS NOT NULL THEN t ELSE marks END AS BIGINT) AS marks FROM j LEFT JOIN s ON j.k = s.k AND j.part = s.part
""")
def closed_parts(spark: SparkSession, d: str) -> DataFrame:
    x = _parted(spark, d)
    parts = x.groupBy("key", "part", "sub").agg(F.max(F.when(F.col("f") == "R", F.col("q"))).alias("marks"))
    return atoms.close_parts(parts, x.where("f <> 'A'").select("key", "part", "sub",
        F.col("q").alias("marks"))).withColumn("marks", F.col("marks").cast("long"))


@query(f"""
WITH {_NUMBERED} SELECT CAST(k AS VARCHAR) AS doc_id, i AS ord, CASE WHEN f <> 'N' THEN i END AS page FROM n
""")
def aligned_pages(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d)
    doc = F.col("k").cast("string").alias("doc_id")
    texts = x.select(doc, F.col("i").alias("ord"),
        F.when(F.col("f") == "N", _str("lost ", F.col("i"))).otherwise(_str(" part ", F.col("p"), "  line ", F.col("i"),
        "; ")).alias("text"))
    pages = x.select(doc, F.col("i").alias("page"),
        _str("Order ", F.col("k"), "\n part ", F.col("p"), " line ", F.col("i"), "; more").alias("text"))
    return atoms.align_pages(texts, pages)


@query("""
SELECT c_custkey AS doc_id, CASE c_custkey % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'fail' WHEN 2 THEN 'flag' ELSE 'indeterminate' END AS status FROM customer
""")
def identity_gate(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    said = _case((c % 5 == 0, "Paper Reference 4CH1/1C (4CH1/1C)"), (c % 5 == 1, "WCH11/01"),
        (c % 5 == 2, "4CH1/1C and WCH11/01A"), other="none here, X4CH1/1C")
    doc = table(spark, d, "customer").select(c.alias("doc_id"), F.explode(F.array(
        F.struct(F.lit(1).alias("page"), said.alias("text")),
        F.struct(F.lit(2).alias("page"), F.lit("instructions").alias("text")),
        F.struct(F.lit(3).alias("page"), F.lit("4CH1/1C").alias("text")))).alias("r")).select("doc_id", "r.*")
    return atoms.identity_gate(doc, table(spark, d, "customer").select(c.alias("doc_id"),
        F.lit("4CH1/1C").alias("reference")))


@query(f"""
WITH {_NUMBERED}, x AS (SELECT *, CASE WHEN f <> 'N' THEN q + CASE WHEN p % 5 = 0 THEN 1 ELSE 0 END END AS total FROM n WHERE NOT (i = 2 AND k % 6 = 0)),
w AS (SELECT k, sum(q) AS t FROM n WHERE k % 4 <> 0 GROUP BY k),
o AS (SELECT k, count(*) AS n, max(i) AS hi, sum(total) AS t FROM x GROUP BY k)
SELECT check_id, severity, count(*) AS n FROM (
  SELECT 'question_sum' AS check_id, CASE WHEN total IS NULL THEN 'review' WHEN total = q THEN 'ok' ELSE 'fail' END AS severity FROM x
  UNION ALL SELECT 'continuity', CASE WHEN n = hi THEN 'ok' ELSE 'fail' END FROM o
  UNION ALL SELECT 'witness', CASE WHEN w.t IS NULL THEN 'review' WHEN w.t = o.t THEN 'ok' ELSE 'fail' END FROM o LEFT JOIN w USING (k)
  UNION ALL SELECT 'incomplete_point', 'fail' FROM x WHERE s % 17 = 0) GROUP BY check_id, severity
""")
def scheme_integrity(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d)
    q = x.where("not (i = 2 and k % 6 = 0)").withColumn("total",
        F.when(F.col("f") != "N", F.col("q") + F.when(F.col("p") % 5 == 0, 1).otherwise(0)))
    key = [F.col("k").alias("doc_id"), F.col("i").alias("question")]
    points = q.select(*key, F.col("q").alias("marks"),
        F.when(F.col("s") % 17 == 0, " ").otherwise("text").alias("text"))
    witnesses = x.where("k % 4 <> 0").groupBy(F.col("k").alias("doc_id")).agg(F.sum("q").alias("total"))
    found = atoms.integrity_gate(q.select(*key, "total"), points, witnesses)
    return found.groupBy("check_id", "severity").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {_NUMBERED}
SELECT k AS doc_id, CAST(sum(CASE f WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END) AS BIGINT) AS printed, count(CASE WHEN f = 'R' OR f = 'A' THEN 1 END) + count(CASE WHEN f = 'R' AND s % 2 = 0 THEN 1 END) AS used,
  sum(CASE f WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END) = count(CASE WHEN f = 'R' OR f = 'A' THEN 1 END) + count(CASE WHEN f = 'R' AND s % 2 = 0 THEN 1 END) AS accounted FROM n GROUP BY k
""")
def label_accounting(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d).withColumn("doc_id", F.col("k"))
    f = F.col("f")
    pages = x.select("doc_id", _case((f == "R", "M1 for it\nand A2(x) AM1 M123"), (f == "A", "B1 not, M10"),
        other="none").alias("text"))
    points = x.select("doc_id", F.when((f == "A") | (f == "R"), "M1").alias("label"))
    other = x.select("doc_id", F.when((f == "R") & (F.col("s") % 2 == 0), "see A2 (x)").otherwise("A 2").alias("text"))
    return atoms.label_accounting(pages, points, other)


@query(f"""
WITH {_PARTS}, m AS (SELECT *, CASE WHEN f = 'N' THEN 0 ELSE q END AS marks FROM x),
o AS (SELECT *, min(CASE WHEN marks > 0 THEN i END) OVER (PARTITION BY k, part, sub) AS first FROM m), g AS (SELECT *, CASE WHEN marks = 0 AND first IS NOT NULL THEN first ELSE i END AS ord FROM o)
SELECT k AS key, part, sub, ord, max(CASE WHEN i = ord THEN marks END) AS marks, coalesce(string_agg(CASE WHEN i <> ord THEN 'point ' || i END, '; ' ORDER BY i), '') AS alternatives FROM g GROUP BY k, part, sub, ord
""")
def merged_alternatives(spark: SparkSession, d: str) -> DataFrame:
    points = _parted(spark, d).select("key", "part", "sub", F.col("i").alias("ord"),
        F.when(F.col("f") == "N", 0).otherwise(F.col("q")).alias("marks"), _str("point ", F.col("i")).alias("text"))
    return atoms.merge_alternatives(points).select("key", "part", "sub", "ord", "marks",
        F.array_join("alternatives", "; ").alias("alternatives"))


@query(f"""
WITH {_PARTS}
SELECT k AS key, string_agg('- (' || part || ')' || CASE WHEN sub IS NULL THEN '' ELSE '(' || sub || ')' END || ' point ' || i || CASE WHEN f = 'N' THEN '' ELSE ' [' || q || ']' END
  || CASE WHEN q % 3 = 0 THEN ' — allow; ' || q ELSE '' END, chr(10) ORDER BY i) AS markdown FROM x GROUP BY k
""")
def rendered_points(spark: SparkSession, d: str) -> DataFrame:
    notes_ = F.when(F.col("q") % 3 == 0, F.array(F.lit("allow"),
        F.col("q").cast("string"))).otherwise(F.array().cast("array<string>"))
    return atoms.render_points(_parted(spark, d).select("key", "part", "sub", F.col("i").alias("ord"),
        _str("point ", F.col("i")).alias("text"), F.when(F.col("f") != "N", F.col("q")).alias("marks"),
        notes_.alias("notes")))


@query("""
WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id, '$.k' AS path, CAST(k AS VARCHAR) AS expected, CAST(k + 1 AS VARCHAR) AS actual FROM e WHERE event_id % 5 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), unnest(['$.z.length', '$.z[0]', '$.z[1].a']), NULL, unnest(['2', '1', '"b"']) FROM e WHERE event_id % 7 = 0
""")
def json_leaf_diff(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    made = lambda k, more: _str('{"k": ', k, more, "}")
    a = e.select("event_id", made(F.col("k"), F.lit("")).alias("json"))
    b = e.select("event_id", made(F.when(F.col("event_id") % 5 == 0, F.col("k") + 1).otherwise(F.col("k")),
        F.when(F.col("event_id") % 7 == 0, ', "z": [1, {"a": "b"}]').otherwise("")).alias("json"))
    return atoms.flat_diff(a, b, "event_id")


# Corpus keeping

def _illustrated(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, d, "customer").select(c.alias("doc_id"),
        _str("![x](img/", c % 7, ".png) and <img class=\"a\" src='img/", c % 5, ".png'>\n![x](img/", c % 7,
        ".png) [no](img/9.png)").alias("text"))


@query("""
SELECT DISTINCT c_custkey AS doc_id, unnest(['img/' || (c_custkey % 7) || '.png', 'img/' || (c_custkey % 5) || '.png']) AS url FROM customer
""")
def image_references(spark: SparkSession, d: str) -> DataFrame:
    return corpus.image_urls(_illustrated(spark, d), "doc_id")


@query("""
WITH t AS (SELECT c_custkey AS c, '![x](img/' || (c_custkey % 7) || '.png) and <img class="a" src=''img/' || (c_custkey % 5) || '.png''>' || chr(10) || '![x](img/' || (c_custkey % 7) || '.png) [no](img/9.png)' AS t FROM customer)
SELECT c AS doc_id, CASE WHEN c % 2 = 0 THEN replace(t, 'img/' || (c % 7) || '.png', 'local/' || c || '.png') ELSE t END AS text FROM t
""")
def rewritten_urls(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    mapping = table(spark, d, "customer").where(c % 2 == 0).select(c.alias("doc_id"),
        _str("img/", c % 7, ".png").alias("url"), _str("local/", c, ".png").alias("path"))
    return corpus.rewrite_urls(_illustrated(spark, d), mapping, "doc_id")


@query("""
WITH t AS (SELECT c_custkey AS c, 'u/' || c_custkey || '.png' AS u FROM customer)
SELECT c AS doc_id, CASE WHEN c % 3 = 0 THEN 'keep' || chr(10) || 'see ![x](' || u || ') here' ELSE 'keep' || chr(10) || '![x](' || u || ')' || chr(10) || 'see ![x](' || u || ') here' || chr(10) || '<img src="' || u || '"/>' END AS text,
  CAST(CASE WHEN c % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_violations FROM t
""")
def planned_removals(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    u = _str("u/", c, ".png")
    docs = table(spark, d, "customer").select(c.alias("doc_id"),
        _str("keep\n![x](", u, ")\nsee ![x](", u, ") here\n<img src=\"", u, "\"/>").alias("text"))
    removals = table(spark, d, "customer").where(c % 3 == 0).select(c.alias("doc_id"), u.alias("url"))
    edited, broken = corpus.plan_removal(docs, removals, "doc_id")
    return edited.join(broken.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "doc_id", "left").select("doc_id",
        "text", F.coalesce("n", F.lit(0)).cast("long").alias("n_violations"))


@query("""
SELECT sha256(string_agg(DISTINCT n_name, chr(10) ORDER BY n_name)) AS batch_id, count(DISTINCT n_name) AS n FROM nation
""")
def removal_batch(spark: SparkSession, d: str) -> DataFrame:
    return corpus.batch_id(table(spark, d, "nation"), "n_name")


@query("""
WITH m AS (SELECT 'p/' || p_partkey AS path, p_name AS a FROM part WHERE p_partkey % 10 <> 1), f AS (SELECT 'p/' || p_partkey AS path, CASE WHEN p_partkey % 9 = 0 THEN 'other' ELSE p_name END AS b FROM part WHERE p_partkey % 11 <> 2),
j AS (SELECT coalesce(m.path, f.path) AS path, CASE WHEN f.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'stray' WHEN a <> b THEN 'changed' END AS problem FROM m FULL OUTER JOIN f ON m.path = f.path)
SELECT * FROM j WHERE problem IS NOT NULL
""")
def verified_files(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    side = lambda where, content: table(spark, d, "part").where(where).select(_str("p/", p).alias("path"),
        F.sha2(content, 256).alias("sha256"))
    return corpus.verify_files(side(p % 10 != 1, F.col("p_name")),
        side(p % 11 != 2, F.when(p % 9 == 0, "other").otherwise(F.col("p_name"))))


@query("""
SELECT l_orderkey AS doc_id, 'part ' || l_partkey AS url FROM lineitem WHERE NOT (l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 40) OR l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY'))
""")
def orphan_references(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    url = lambda c: _str("part ", F.col(c)).alias("url")
    refs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), url("l_partkey"))
    return corpus.orphans(refs, part.where("p_size < 40").select(url("p_partkey")),
        part.where("p_type = 'ECONOMY'").select(url("p_partkey"))).select("doc_id", "url")


@query("""
WITH r AS (SELECT c_custkey // 4 AS k, c_custkey AS c, CASE c_custkey % 4 WHEN 0 THEN 'qp' WHEN 1 THEN 'ms' WHEN 2 THEN CASE WHEN (c_custkey // 4) % 3 = 0 THEN 'qp' ELSE 'insert' END ELSE 'ms' END AS kind FROM customer),
g AS (SELECT * FROM r WHERE NOT (c % 4 = 3 AND k % 5 <> 0) AND NOT (c % 4 = 1 AND k % 7 = 0)),
o AS (SELECT k, kind, CASE WHEN kind = 'qp' THEN 'q' || k ELSE 'c' || c END AS sha, min('f' || c) AS file FROM g GROUP BY 1, 2, 3),
m AS (SELECT k, count(CASE WHEN kind = 'qp' THEN 1 END) AS nq, count(CASE WHEN kind = 'ms' THEN 1 END) AS nm, min(CASE WHEN kind = 'qp' THEN file END) AS qp, min(CASE WHEN kind = 'ms' THEN file END) AS ms FROM o WHERE kind <> 'insert' GROUP BY k)
SELECT k AS key, 'pair' AS kind, qp || '+' || ms AS file, 'OK' AS reason FROM m WHERE nq = 1 AND nm = 1
UNION ALL SELECT o.k, o.kind, o.file, CASE WHEN nq > 1 OR nm > 1 THEN 'DUAL_COPY' ELSE 'UNPAIRED' END FROM o JOIN m USING (k) WHERE o.kind <> 'insert' AND NOT (nq = 1 AND nm = 1)
UNION ALL SELECT k, kind, file, 'INSERT' FROM o WHERE kind = 'insert'
""")
def intake_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Four customers are a paper's files: one or two copies of the paper, schemes that may be missing or two, inserts."""
    c, k = F.col("c"), F.col("key")
    r = table(spark, d, "customer").select(F.floor(F.col("c_custkey") / 4).alias("key"), F.col("c_custkey").alias("c"))
    kind = _case((c % 4 == 0, "qp"), (c % 4 == 1, "ms"), ((c % 4 == 2) & (k % 3 == 0), "qp"), (c % 4 == 2, "insert"),
        other="ms")
    given = r.where(~((c % 4 == 3) & (k % 5 != 0)) & ~((c % 4 == 1) & (k % 7 == 0))).withColumn("kind", kind)
    found = given.select("key", "kind", F.sha2(F.when(F.col("kind") == "qp", _str("q", k)).otherwise(_str("c", c)),
        256).alias("sha256"), _str("f", c).alias("file"))
    pairs, aside = corpus.intake_pairs(found, ["key"])
    return pairs.select("key", F.lit("pair").alias("kind"), F.concat_ws("+", "qp", "ms").alias("file"),
        F.lit("OK").alias("reason")).union(aside.select("key", "kind", "file", "reason"))


@query("""
SELECT user_id, event_type, count(*) AS n_runs, count(DISTINCT CAST(floor(value / 25) AS BIGINT)) AS n_variants, count(DISTINCT CAST(floor(value / 25) AS BIGINT)) = 1 AS stable FROM events GROUP BY user_id, event_type
""")
def stable_runs(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "events").select("user_id", "event_type",
        F.floor(F.col("value") / 25).cast("string").alias("content"))
    return corpus.stable(runs, ["user_id", "event_type"], "content")


@query("""
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'was ' || lang ELSE lang END AS lang, CASE WHEN l.doc_id IS NOT NULL THEN NULL ELSE source END AS source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.toxic = 1
""")
def rolled_back(spark: SparkSession, d: str) -> DataFrame:
    current = table(spark, d, "documents").select("doc_id", "lang", "source")
    before = current.join(table(spark, d, "labels").where("toxic = 1").select("doc_id"), "doc_id",
        "left_semi").select("doc_id", _str("was ", F.col("lang")).alias("lang"),
        F.lit(None).cast("string").alias("source"))
    return corpus.rollback(current, before, "doc_id", ["lang", "source"])


# Records of a paper

@query(f"""
WITH {_NUMBERED}, a AS (SELECT k, i, CASE WHEN f <> 'N' THEN q END AS t FROM n WHERE i % 7 <> 0), b AS (SELECT k, i, CASE WHEN s % 4 <> 0 THEN q + CASE WHEN p % 5 = 0 THEN 1 ELSE 0 END END AS t, q - CASE WHEN p % 3 = 0 THEN 1 ELSE 0 END AS sum FROM n WHERE p % 11 <> 0),
j AS (SELECT coalesce(a.k, b.k) AS doc_id, coalesce(a.i, b.i) AS number, a.k IS NOT NULL AS ha, b.k IS NOT NULL AS hb, a.t, b.t AS ms_total, b.sum, coalesce(a.t, b.t, b.sum) AS marks FROM a FULL OUTER JOIN b ON a.k = b.k AND a.i = b.i),
f AS (SELECT *, concat_ws(',', CASE WHEN NOT ha THEN 'no-paper' END, CASE WHEN ha AND t IS NULL THEN 'paper-total-missing' END, CASE WHEN NOT hb THEN 'scheme-missing' END, CASE WHEN t <> ms_total THEN 'totals-differ' END,
  CASE WHEN hb AND NOT coalesce(sum = marks, false) THEN 'points-do-not-close' END) AS flags FROM j)
SELECT doc_id, number, marks, ms_total, sum, flags = '' AS verified, flags FROM f
""")
def record_flags(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d)
    key = [F.col("k").alias("doc_id"), F.col("i").alias("number")]
    plus = lambda m: F.when(F.col("p") % m == 0, 1).otherwise(0)
    q = x.where("i % 7 <> 0").select(*key, F.when(F.col("f") != "N", F.col("q")).alias("total"))
    s = x.where("p % 11 <> 0").select(*key, F.when(F.col("s") % 4 != 0, F.col("q") + plus(5)).alias("ms_total"),
        (F.col("q") - plus(3)).alias("sum"))
    return records.paper_records(q, s).withColumn("flags", F.array_join("flags", ","))


@query(f"""
WITH {_PARTS}, l AS (SELECT DISTINCT k, CASE WHEN i % 2 = 0 OR sub IS NULL THEN part ELSE part || '-' || sub END AS label FROM x)
SELECT l.k AS key, label, count(x.k) AS n, CAST(coalesce(sum(x.q), 0) AS BIGINT) AS marks FROM l LEFT JOIN x ON l.k = x.k AND f <> 'A' AND (label = part OR label = part || '-' || sub) GROUP BY l.k, label
""")
def part_points(spark: SparkSession, d: str) -> DataFrame:
    x = _parted(spark, d)
    label = F.when((F.col("i") % 2 == 0) | F.col("sub").isNull(),
        F.col("part")).otherwise(F.concat_ws("-", "part", "sub"))
    parts = x.select("key", label.alias("label")).distinct()
    found = records.part_points(parts, x.where("f <> 'A'").select("key", "part", "sub", F.col("q").alias("marks")))
    return found.groupBy("key", "label").agg(F.count("point_marks").alias("n"),
        F.coalesce(F.sum("point_marks"), F.lit(0)).alias("marks"))


@query(f"""
WITH {_PARTS}, a AS (SELECT k, part, sub, min(CASE WHEN q % 4 = 0 THEN 'A' WHEN q % 4 = 1 THEN 'B' ELSE 'C' END) AS letter FROM x WHERE f = 'R' GROUP BY k, part, sub)
SELECT x.k AS key, x.part, x.sub, i, letter FROM x LEFT JOIN a ON x.k = a.k AND x.part = a.part AND x.sub IS NOT DISTINCT FROM a.sub
""")
def correct_options(spark: SparkSession, d: str) -> DataFrame:
    x = _parted(spark, d)
    letter = _case((F.col("q") % 4 == 0, "A"), (F.col("q") % 4 == 1, "B"), other="C")
    return records.correct_options(x.select("key", "part", "sub", "i"),
        x.where("f = 'R'").select("key", "part", "sub", letter.alias("letter")))


@query("""
WITH f AS (SELECT c_custkey // 5 AS k, c_custkey AS c, 'Crop_' || (c_custkey % 5) || '.png' AS n FROM customer),
r AS (SELECT c_custkey // 5 AS k, CASE c_custkey % 5 WHEN 0 THEN 'out/CROP_0.PNG' WHEN 1 THEN 'p1-1.png' WHEN 2 THEN 'p1-2.png' WHEN 3 THEN 'p2_2.png' ELSE 'other.png' END AS n, 'about ' || c_custkey AS about FROM customer)
SELECT k AS doc_id, n AS source_name, CASE c % 5 WHEN 0 THEN 'about ' || c WHEN 1 THEN (SELECT min(about) FROM r WHERE r.k = f.k AND n = 'p1-1.png') END AS description FROM f
""")
def figure_descriptions(spark: SparkSession, d: str) -> DataFrame:
    """Five figures a document: one report has the same name, one ends alike, two end alike, two fit nothing."""
    c = F.col("c_custkey")
    base = table(spark, d, "customer")
    figures = base.select(F.floor(c / 5).alias("doc_id"), _str("Crop_", c % 5, ".png").alias("source_name"))
    name = _case((c % 5 == 0, "out/CROP_0.PNG"), (c % 5 == 1, "p1-1.png"), (c % 5 == 2, "p1-2.png"),
        (c % 5 == 3, "p2_2.png"), other="other.png")
    return records.attach_descriptions(figures, base.select(F.floor(c / 5).alias("doc_id"), name.alias("name"),
        _str("about ", c).alias("description")))


@query(f"""
WITH {_PARTS}, o AS (SELECT k, i % 3 AS number, part, sub, i, row_number() OVER (PARTITION BY k ORDER BY i % 3, sub ASC NULLS FIRST, i) - 1 AS ord FROM x)
SELECT k AS doc_id, CAST(ord AS INTEGER) AS ord, 'e' || lpad(CAST(ord AS VARCHAR), 6, '0') AS element_id, 'Question ' || number AS section, 'q' || lpad(CAST(number AS VARCHAR), 2, '0') || coalesce('-' || sub, '') AS group_key FROM o
""")
def canonical_elements(spark: SparkSession, d: str) -> DataFrame:
    blocks = _parted(spark, d).select(F.col("key").alias("doc_id"), (F.col("i") % 3).alias("number"),
        F.col("sub").alias("part"), F.col("i").alias("ord"), F.lit("paragraph").alias("kind"), F.lit("t").alias("text"),
        F.lit(1).alias("page"))
    return records.canonical(blocks).select("doc_id", "ord", "element_id", "section", "group_key")


@query(f"""
WITH {_NUMBERED} SELECT k AS doc_id, max(q) AS page_count, count(*) AS n_elements FROM n GROUP BY k
""")
def element_page_counts(spark: SparkSession, d: str) -> DataFrame:
    return records.page_counts(_lines(spark, d).select(F.col("k").alias("doc_id"), F.col("q").alias("page")))


@query(f"""
WITH {_PARTS}, r AS (SELECT k, i, part, sub, CASE i % 4 WHEN 0 THEN '![alt](img ' || i || ')' WHEN 1 THEN '- item ' || i WHEN 2 THEN '' ELSE 'text ' || i END AS t, row_number() OVER (PARTITION BY k, part, sub ORDER BY i) AS n FROM x)
SELECT k AS doc_id, part AS number, string_agg(CASE WHEN sub IS NOT NULL AND n = 1 THEN '**(' || sub || ')** ' || t ELSE t END, chr(10) || chr(10) ORDER BY i) AS markdown FROM r WHERE t <> '' OR (sub IS NOT NULL AND n = 1) GROUP BY k, part
""")
def bank_markdown(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("i") % 4
    blocks = _parted(spark, d).select(
        F.col("key").alias("doc_id"), F.col("part").alias("number"), F.col("sub").alias("part"),
        F.col("i").alias("ord"), _case((m == 0, "figure"), (m == 1, "list_item"), other="paragraph").alias("kind"),
        _case((m == 0, _str("img ", F.col("i"))), (m == 1, _str("item ", F.col("i"))), (m == 2, ""),
        other=_str("text ", F.col("i"))).alias("text"), F.lit("alt").alias("alt"))
    return records.bank_markdown(blocks)


@query(f"""
WITH {_NUMBERED}, d AS (SELECT DISTINCT k FROM n), e AS (SELECT k, 'e' || CASE WHEN i = 3 THEN 2 ELSE i END AS id, i, q FROM n)
SELECT check_id, count(*) AS n FROM (
  SELECT 'series' AS check_id FROM d WHERE k % 5 = 0 UNION ALL SELECT 'year' FROM d WHERE k % 7 = 0 UNION ALL SELECT 'kind' FROM e WHERE i = 5 UNION ALL SELECT 'confidence' FROM e WHERE q > 40
  UNION ALL SELECT 'page' FROM e WHERE i > 4 UNION ALL SELECT 'repeated_id' FROM (SELECT k, id FROM e GROUP BY k, id HAVING count(*) > 1)
  UNION ALL SELECT 'section_reference' FROM d LEFT JOIN (SELECT DISTINCT k FROM e WHERE id = 'e4') USING (k) WHERE k NOT IN (SELECT k FROM e WHERE id = 'e4')) GROUP BY check_id
""")
def validated_documents(spark: SparkSession, d: str) -> DataFrame:
    x = _lines(spark, d)
    docs = x.select("k").distinct().select(F.col("k").alias("doc_id"),
        F.when(F.col("k") % 5 == 0, "MAY").otherwise("JUN").alias("series"),
        F.when(F.col("k") % 7 == 0, 1889).otherwise(2020).alias("year"), F.lit(4).alias("page_count"))
    elements = x.select(F.col("k").alias("doc_id"),
        _str("e", F.when(F.col("i") == 3, 2).otherwise(F.col("i"))).alias("element_id"), F.col("i").alias("ord"),
        F.when(F.col("i") == 5, "blob").otherwise("paragraph").alias("kind"), F.col("i").alias("page"),
        (F.col("q") / 40).alias("confidence"))
    sections = docs.select("doc_id", F.lit("s").alias("section"),
        F.array(F.lit("e1"), F.lit("e4")).alias("element_ids"))
    return records.validate(docs, elements, sections).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
m AS (SELECT *, sum(CASE WHEN regexp_matches(raw, '^[A-M]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS slice FROM l)
SELECT doc_id, CAST(slice AS BIGINT) AS slice, CAST(min(line_no) AS INTEGER) AS first_line, CAST(max(line_no) AS INTEGER) AS last_line, count(*) AS n_lines FROM m WHERE slice > 0 GROUP BY doc_id, slice
""")
def line_slices(spark: SparkSession, d: str) -> DataFrame:
    return records.slices(lines.explode_lines(table(spark, d, "documents"), "doc_id"), "doc_id",
        F.col("raw").rlike("^[A-M]"))


@query("""
SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'none' ELSE 'v' || s_suppkey END AS tag, 2 AS version FROM supplier
""")
def upgraded_manifest(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey")
    old = table(spark, d, "supplier").select(s.alias("id"), F.col("s_name").alias("name"),
        F.when(s % 3 != 0, _str("v", s)).alias("tag"))
    return records.upgrade_manifest(old, {"tag": F.lit("none"), "version": F.lit(2)})


@query("""
SELECT o_custkey AS batch_id, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0) GROUP BY o_custkey
""")
def appended_log(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("batch_id"), F.col("o_orderkey").alias("row"))
    return records.append_log(o.where("row % 2 = 0"),
        o.where("row % 2 = 1")).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT vec_id, CASE WHEN label % 2 = 0 THEN 2 ELSE 1 END AS embed_rev, CASE WHEN label % 2 = 0 THEN round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) * 2, 3) ELSE round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 3) END AS total FROM embeddings
""")
def applied_embeddings(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    bank = e.select("vec_id", "embedding", F.lit(1).alias("embed_rev"))
    size = e.select(F.size("embedding").alias("n")).first()[0]
    fresh = e.where("label % 2 = 0").select("vec_id",
        F.transform("embedding", lambda x: x * F.lit(2.0).cast("float")).alias("embedding"))
    out, _ = records.apply_embeddings(bank, fresh, "vec_id", size, 2)
    return out.select("vec_id", "embed_rev", F.round(F.aggregate("embedding", F.lit(0.0), lambda s,
        x: s + x.cast("double")), 3).alias("total"))


# Files, images and notes

@query("""
WITH h AS (SELECT c_custkey, sha256(c_name) AS h FROM customer),
n AS (SELECT c_custkey, CAST(CAST('0x' || substr(h, 1, 16) AS UBIGINT) AS UHUGEINT) * CAST('18446744073709551616' AS UHUGEINT) + CAST('0x' || substr(h, 17, 16) AS UBIGINT) AS n FROM h),
d AS (SELECT c_custkey, i, CAST(n // list_reduce([CAST(1 AS UHUGEINT)] || list_transform(range(i), lambda x: CAST(62 AS UHUGEINT)), lambda a, b: a * b) % 62 AS INTEGER) AS v FROM n, (SELECT unnest(range(0, 22)) AS i))
SELECT c_custkey, regexp_replace(string_agg(substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', v + 1, 1), '' ORDER BY i DESC), '^0+', '') AS id FROM d GROUP BY c_custkey
""")
def base62_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", identity.base62(F.sha2("c_name", 256)).alias("id"))


@query("""
SELECT 'f/' || p_partkey || CASE p_partkey % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.gif' WHEN 2 THEN '.jpg' WHEN 3 THEN '.png' ELSE '.bin' END AS path,
  CASE p_partkey % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/gif' WHEN 2 THEN 'image/jpeg' WHEN 3 THEN 'image/bmp' END AS mime_type, CASE WHEN p_partkey % 5 = 4 THEN NULL ELSE p_partkey % 5 = 3 END AS format_mismatch,
  CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN p_size END AS width, CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN CAST(p_partkey % 60000 AS INTEGER) END AS height FROM part
""")
def image_records(spark: SparkSession, d: str) -> DataFrame:
    p, w, h = F.col("p_partkey"), F.col("p_size"), F.col("p_partkey") % 60000
    big = lambda c: F.lpad(F.hex(c), 8, "0")
    byte = lambda c, k: F.lpad(F.hex(F.floor(c / 256**k) % 256), 2, "0")
    little = lambda c, n: F.concat(*[byte(c, k) for k in range(n)])
    raw = _case((p % 5 == 0, F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big(w), big(h))),
        (p % 5 == 1, F.concat(F.lit("474946383961"), little(w, 2), little(h, 2))), (p % 5 == 2, "FFD8FFE0"),
                (p % 5 == 3, F.concat(F.lit("424D00000000000000000000000000000000"), little(w, 4), little(h, 4))),
                other="00FF")
    ending = _case((p % 5 == 0, ".png"), (p % 5 == 1, ".gif"), (p % 5 == 2, ".jpg"), (p % 5 == 3, ".png"), other=".bin")
    files = table(spark, d, "part").select(F.concat(F.lit("f/"), p.cast("string"), ending).alias("path"),
        F.unhex(raw).alias("content"))
    return readers.images(files).select("path", "mime_type", "format_mismatch", "size.width", "size.height")


@query("""
WITH a AS (SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'x/same.png' WHEN s_suppkey % 4 = 1 THEN 'y/same.png' ELSE 'z/' || s_suppkey || '.png' END AS p FROM supplier),
r AS (SELECT c_custkey AS doc_id, CASE c_custkey % 5 WHEN 0 THEN '/z/2.png' WHEN 1 THEN 'z/../2.png' WHEN 2 THEN 'q/same.png' WHEN 3 THEN 'z/' || (c_custkey % 40) || '.png' ELSE 'w/' || (c_custkey % 40) || '.png' END AS ref FROM customer),
n AS (SELECT regexp_replace(p, '^.*/', '') AS b, count(DISTINCT p) AS c, min(p) AS p FROM a GROUP BY 1), j AS (SELECT r.*, e.p AS ep, n.c, n.p AS np FROM r LEFT JOIN (SELECT DISTINCT p FROM a) e ON e.p = ref LEFT JOIN n ON n.b = regexp_replace(ref, '^.*/', ''))
SELECT doc_id, ref, CASE WHEN doc_id % 5 < 2 THEN NULL ELSE coalesce(ep, CASE WHEN c = 1 THEN np END) END AS asset_path, CASE WHEN doc_id % 5 < 2 THEN 'rejected' WHEN ep IS NOT NULL OR c = 1 THEN 'resolved' WHEN c > 1 THEN 'ambiguous' ELSE 'missing' END AS status FROM j
""")
def resolved_assets(spark: SparkSession, d: str) -> DataFrame:
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    assets = table(spark, d, "supplier").select(_case((s % 4 == 0, "x/same.png"), (s % 4 == 1, "y/same.png"),
        other=_str("z/", s, ".png")).alias("relative_path"))
    ref = _case((c % 5 == 0, "/z/2.png"), (c % 5 == 1, "z/../2.png"), (c % 5 == 2, "q/same.png"),
        (c % 5 == 3, _str("z/", c % 40, ".png")), other=_str("w/", c % 40, ".png"))
    return readers.resolve_assets(table(spark, d, "customer").select(c.alias("doc_id"), ref.alias("ref")), assets,
        ["doc_id"], "ref")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, unnest([0, 1, 2, 3]) AS ord, unnest(['heading', 'paragraph', 'list_item', 'table']) AS kind, unnest([c_name, 'In ' || c_mktsegment, 'item ' || c_custkey, NULL]) AS text,
  unnest([1, NULL, NULL, NULL]) AS level, unnest([1, 1, 2, 2]) AS page FROM customer
""")
def engine_elements(spark: SparkSession, d: str) -> DataFrame:
    """An engine's tree for each customer: a heading, a paragraph inside an unknown kind, a list and a table."""
    text = _str('{"kids": [{"type": "Heading", "heading level": 1, "content": "', F.col("c_name"),
        '", "page number": 1}, {"type": "blob", "kids": [{"type": "paragraph", "content": "In ', F.col("c_mktsegment"),
                '", "page number": 1}]}, {"type": "list", "list items": [{"type": "list item", "content": "item ',
                F.col("c_custkey"),
                '", "page number": 2}]}, {"type": "table", "page number": 2, "rows": [{"cells": [{"content": "x"}]}]}]}')
    docs = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), text.alias("json"))
    return readers.engine_json(docs, "doc_id").select("doc_id", "ord", "kind", "text", "level", "page")


@query("""
SELECT 'wch_' || p_partkey || '_' || CASE WHEN p_partkey % 2 = 0 THEN 'qp' ELSE 'ms' END || '.pdf' AS file, sha256(p_name) AS sha256, CAST(p_partkey AS VARCHAR) AS unit, CASE WHEN p_partkey % 2 = 0 THEN 'qp' ELSE 'ms' END AS role, 'kept' AS status FROM part WHERE p_partkey % 9 <> 0
UNION ALL SELECT 'notes ' || p_partkey || '.txt', sha256(p_name), NULL, NULL, 'name' FROM part WHERE p_partkey % 9 = 0
""")
def archive_records(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    name = F.when(p % 9 == 0, _str("notes ", p, ".txt")).otherwise(_str("wch_", p, "_",
        F.when(p % 2 == 0, "qp").otherwise("ms"), ".pdf"))
    found = table(spark, d, "part").select(F.concat(F.lit("/in/"), name).alias("path"),
        F.col("p_name").cast("binary").alias("content"))
    kept, aside = readers.archive(found, r"wch_(\d+)_(qp|ms)\.pdf", ["unit", "role"])
    null = F.lit(None).cast("string")
    return kept.select("file", "sha256", "unit", "role",
        F.lit("kept").alias("status")).union(aside.select("file", "sha256", null, null, "reason"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS k, unnest([0, 1, 2, 3, 4]) AS ord, unnest(['heading', 'paragraph', 'list_item', 'figure', 'table']) AS kind,
  unnest([c_name, 'Lives in ' || c_nationkey || chr(10) || 'and buys.', 'item ' || c_custkey, NULL, NULL]) AS text, unnest([2, NULL, NULL, NULL, NULL]) AS level, unnest([NULL, NULL, NULL, 'a/b' || c_custkey || '.png', NULL]) AS url FROM customer
""")
def note_elements(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    body = _str("## ", F.col("c_name"), "\nLives in ", F.col("c_nationkey"), "\nand buys.\n\n- item ", c, "\n![x](a/b",
        c, ".png)\n| a | b |\n| --- | --- |\n| 1 | 2 |\n")
    return notes.elements(table(spark, d, "customer").select(c.alias("k"), body.alias("body")),
        "k").select(F.col("doc_id").alias("k"), "ord", "kind", "text", "level", "url")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS k, CAST(c_custkey % 3 AS INTEGER) AS inline_math, CAST(c_custkey % 2 AS BIGINT) AS spec_points FROM customer
""")
def note_statistics(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    body = F.concat(F.repeat(F.lit("cost \\$5 is $x$ here\n"), (c % 3).cast("int")),
        F.when(c % 2 == 1, "\n> **Spec point** 1.2\n").otherwise("\n> a quote\n"))
    return notes.statistics(table(spark, d, "customer").select(c.alias("k"), body.alias("body")), "k")


@query("""
WITH n AS (SELECT s_suppkey AS s, 'rn_' || s_suppkey AS id FROM supplier)
SELECT id AS note_id, CASE WHEN s % 3 <> 0 THEN 'p' || s END AS sidecar, CAST(NULL AS VARCHAR) AS reason FROM n
UNION ALL SELECT id, 'q' || s, 'repeated' FROM n WHERE s % 3 <> 0 AND s % 4 = 0
UNION ALL SELECT id, 'p' || s, 'schema' FROM n WHERE s % 3 = 0
UNION ALL SELECT 'rn_x' || s, 'p' || s, 'note_id' FROM n WHERE s % 5 = 0
""")
def note_sidecars(spark: SparkSession, d: str) -> DataFrame:
    """Sidecars of notes: some of another schema, some twice, some of no note."""
    s = F.col("s_suppkey")
    base = table(spark, d, "supplier")
    own = base.select(F.create_map(F.lit("note_id"), _str("rn_", s)).alias("meta"))
    row = lambda where, id_, params, schema: base.where(where).select(id_.alias("note_id"), params.alias("params"),
        schema.alias("schema"))
    side = row(s >= 0, _str("rn_", s), _str("p", s),
        F.when(s % 3 == 0, "v0").otherwise("v1")).union(row((s % 3 != 0) & (s % 4 == 0), _str("rn_", s), _str("q", s),
        F.lit("v1"))).union(row(s % 5 == 0, _str("rn_x", s), _str("p", s), F.lit("v1")))
    joined, aside = readers.with_sidecar(own, side, "v1")
    return joined.select("note_id", "sidecar", F.lit(None).cast("string").alias("reason")).union(aside.select("note_id",
        "params", "reason"))


# Glyphs, retrieval and joins

@query("""
SELECT doc_id, replace(replace(replace(text, 'ung', 'U'), 'th', 'T'), 'é', '') AS text, CAST(length(replace(replace(replace(text, 'ung', 'U'), 'th', 'T'), 'é', '')) - length(text) AS INTEGER) AS length_delta FROM documents
""")
def normalised_glyphs(spark: SparkSession, d: str) -> DataFrame:
    return glyphs.normalise(table(spark, d, "documents").select("doc_id", "text"), "text",
        {"ung": "U", "th": "T", "é": ""})


@query("""
SELECT doc_id FROM documents WHERE contains(replace(text, 'sch', 's'), 'sch')
""")
def second_pass(spark: SparkSession, d: str) -> DataFrame:
    """A table whose values may make a key again: rows that a second pass would change."""
    return glyphs.idempotent(table(spark, d, "documents").select("doc_id", "text"), "text",
        {"sch": "s"}).select("doc_id")


@query(f"""
WITH {_NUMBERED}, r AS (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY i) - 1) // 3 + 1 AS c FROM n)
SELECT k AS doc_id, CAST(c AS INTEGER) AS chunk, sha256(string_agg(rpad('element ' || p || ' ', 400, '.'), chr(10) ORDER BY i)) AS content_sha256, min(q) AS page_start, max(q) AS page_end, string_agg('e' || i, ',' ORDER BY i) AS element_ids, 100 * count(*) AS tokens FROM
  (SELECT k, p, i, min(q) OVER (PARTITION BY k) AS q, (row_number() OVER (PARTITION BY k ORDER BY i) - 1) // 3 + 1 AS c FROM n) GROUP BY k, c
""")
def retrieval_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Elements of a hundred tokens each, three to a chunk; all of an order on one page."""
    x = _lines(spark, d)
    page = x.groupBy("k").agg(F.min("q").alias("page"))
    elements = x.join(page, "k").select(F.col("k").alias("doc_id"), "page", F.col("i").alias("ord"),
        _str("e", F.col("i")).alias("element_id"), F.rpad(_str("element ", F.col("p"), " "), 400, ".").alias("text"),
        F.lit(None).cast("string").alias("group_key"))
    return bridges.chunks(elements).select("doc_id", "chunk", "content_sha256", "page_start", "page_end",
        F.array_join("element_ids", ",").alias("element_ids"), F.col("tokens").cast("long").alias("tokens"))


@query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'JAN' WHEN 1 THEN 'JUN' WHEN 2 THEN 'JUN' WHEN 3 THEN 'NOV' WHEN 4 THEN 'JAN' END AS series, CASE WHEN p_partkey % 6 = 5 THEN NULL ELSE CAST(2000 + p_size % 25 AS INTEGER) END AS year FROM part
""")
def printed_series(spark: SparkSession, d: str) -> DataFrame:
    p, y = F.col("p_partkey"), 2000 + F.col("p_size") % 25
    printed = _case((p % 6 == 0, _str("January ", y)), (p % 6 == 1, _str("Summer series ", y)), (p % 6 == 5, "no date"))
    normal = _case((p % 6 == 2, _str("x-", y, "-06")), (p % 6 == 3, _str("11-", y, "-qp")), (p % 6 == 4, _str(y, "-1")))
    return table(spark, d, "part").select("p_partkey", bridges.series(printed, normal).alias("r")).select("p_partkey", "r.*")


@query(f"""
WITH {_NUMBERED} SELECT k AS doc_id, i AS number, i || CASE WHEN i % 2 = 0 THEN '. ' ELSE ' ' END || 'Part ' || p || chr(10) || 'tail' || CASE WHEN f = 'R' THEN ' (' || q || ')' ELSE '' END AS text, CASE WHEN f = 'R' THEN CAST(q AS BIGINT) END AS marks, CAST(CASE WHEN f = 'R' THEN 0.7 ELSE 0.5 END AS DOUBLE) AS confidence FROM n
""")
def loose_questions(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("i")
    three = F.array(F.concat(_str(i), F.when(i % 2 == 0, ". ").otherwise(" "), _str("Part ", F.col("p"))),
        F.lit("Turn over"), F.concat(F.lit("tail"), F.when(F.col("f") == "R",
        _str(" (", F.col("q"), ")")).otherwise("")))
    rows = _lines(spark, d).select(F.col("k").alias("doc_id"), i.alias("at"),
        F.posexplode(three).alias("j", "raw")).select("doc_id", (F.col("at") * 3 + F.col("j")).alias("line_no"), "raw")
    return bridges.loose_questions(rows).select("doc_id", "number", "text", "marks",
        F.col("confidence").cast("double").alias("confidence"))


@query(f"""
WITH {_NUMBERED}
SELECT k AS doc_id, i || '-a' AS ref, 1 AS ordinal, 'point ' || p || ' (2)' AS text, 2 AS marks, CAST(0.7 AS DOUBLE) AS confidence FROM n
UNION ALL SELECT k, i || '-a', 2, 'more ' || s, 1, CAST(0.55 AS DOUBLE) FROM n WHERE f = 'R'
UNION ALL SELECT k, i || '-a-ii', 1, 'roman', 1, CAST(0.55 AS DOUBLE) FROM n WHERE f <> 'R'
""")
def loose_points(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("i")
    two = F.array(F.concat(F.when(i % 2 == 0, _str(i, " a ")).otherwise(_str(i, "(a) ")),
        _str("point ", F.col("p"), " (2)")), F.when(F.col("f") == "R",
        _str("M2 more ", F.col("s"))).otherwise("ii roman"))
    rows = _lines(spark, d).select(F.col("k").alias("doc_id"), i.alias("at"),
        F.posexplode(two).alias("j", "raw")).select("doc_id", (F.col("at") * 2 + F.col("j")).alias("line_no"), "raw")
    return bridges.loose_points(rows).select("doc_id", "ref", "ordinal", "text", "marks",
        F.col("confidence").cast("double").alias("confidence"))


@query("""
WITH c AS (SELECT o_orderkey, o_custkey, o_totalprice, n_orders FROM orders JOIN (SELECT c_custkey, c_acctbal AS n_orders FROM customer) ON c_custkey = o_custkey),
r AS (SELECT s_suppkey AS s, s_nationkey AS nk, s_acctbal AS at FROM supplier), l AS (SELECT c_custkey AS id, c_nationkey AS nk, c_acctbal AS at FROM customer)
SELECT l.id, (SELECT r.s FROM r WHERE r.nk = l.nk ORDER BY abs(r.at - l.at), r.at LIMIT 1) AS supplier FROM l
""")
def nearest_supplier(spark: SparkSession, d: str) -> DataFrame:
    """For each customer the supplier of the nation whose balance is nearest.

    Of several with one balance it is that of the least key; the SQL leaves this open, and DuckDB's choice changes from
    run to run.
    """
    left = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nk"),
        F.col("c_acctbal").alias("at"))
    right = table(spark, d, "supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("nk"),
        F.col("s_acctbal").alias("at"))
    return reconcile.nearest(left, right, ["nk"], "at", "supplier").select("id", "supplier")


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error FROM events
""")
def asof_owner(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.asof_owner(table(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "error",
        F.col("event_id"), "last_error").select("event_id", "last_error")


@query("""
SELECT check_id, count(*) AS n FROM (SELECT 'repeated:parts' AS check_id FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1) UNION ALL SELECT 'dangling:lines:small' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)) GROUP BY check_id
""")
def package_findings(spark: SparkSession, d: str) -> DataFrame:
    """What stops a package: repeated names and lines whose part is left out."""
    part = table(spark, d, "part")
    found = [gates.findings(gates.repeated_keys(part, ["p_name"]), F.col("p_name"), "repeated:parts", "fail",
        F.col("count")),
             gates.findings(gates.dangling(table(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey"),
             ["p_partkey"], part.where("p_size < 40")), F.col("p_partkey"), "dangling:lines:small", "fail",
             F.lit("part"))]
    return gates.all_findings(found).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))
