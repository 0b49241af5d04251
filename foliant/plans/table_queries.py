"""Queries over the star schema and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.functions import identity
from foliant.operators import gates, lines, reconcile
from foliant.plans.registry import query, table


@query("""
WITH l AS (SELECT l_orderkey AS k, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS computed FROM lineitem GROUP BY l_orderkey),
j AS (SELECT coalesce(o_orderkey, k) AS orderkey, o_totalprice, computed, CASE WHEN k IS NULL THEN 'left_only' WHEN o_orderkey IS NULL THEN 'right_only'
  WHEN abs(o_totalprice - computed) < 0.01 THEN 'match' ELSE 'mismatch' END AS status, o_orderpriority FROM orders FULL OUTER JOIN l ON o_orderkey = k)
SELECT o_orderpriority, status, count(*) AS n, count(CASE WHEN computed > o_totalprice THEN 1 END) AS n_over, CASE WHEN max(CASE WHEN status = 'match' THEN 0 WHEN status = 'mismatch' THEN 2 ELSE 1 END) = 2 THEN 'fail'
  WHEN max(CASE WHEN status = 'match' THEN 0 ELSE 1 END) = 1 THEN 'review' ELSE 'ok' END AS severity FROM j GROUP BY o_orderpriority, status
""")
def total_reconcile(spark: SparkSession, d: str) -> DataFrame:
    own = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))), 2)
    computed = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(own.alias("computed"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_totalprice", "o_orderpriority")
    found = reconcile.totals(orders.withColumn("o_total", F.struct("o_totalprice", "o_orderpriority")), computed,
        ["orderkey"], "o_total", "computed", F.abs(F.col("o_total.o_totalprice") - F.col("computed")) < 0.01)
    severity = F.when(F.col("status") == "match", "ok").when(F.col("status") == "mismatch", "fail").otherwise("review")
    g = found.select(F.col("o_total.o_orderpriority").alias("o_orderpriority"), "status",
        (F.col("computed") > F.col("o_total.o_totalprice")).alias("over"))
    return g.groupBy("o_orderpriority", "status").agg(F.count(F.lit(1)).alias("n"),
        F.count_if("over").alias("n_over")).withColumn("severity", severity)


@query("""
WITH RECURSIVE n AS (SELECT l_orderkey AS k, l_linenumber AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) AS i FROM lineitem),
g AS (SELECT k, i, CASE WHEN v = 1 THEN 1 ELSE 0 END AS a FROM n WHERE i = 1 UNION ALL SELECT n.k, n.i, CASE WHEN n.v = g.a + 1 THEN n.v ELSE g.a END FROM g JOIN n ON n.k = g.k AND n.i = g.i + 1)
SELECT k AS l_orderkey, max(i) AS n_lines, CAST(max(a) AS BIGINT) AS accepted FROM g GROUP BY k
""")
def sequence_gate(spark: SparkSession, d: str) -> DataFrame:
    return lines.greedy_sequence(table(spark, d, "lineitem"), "l_orderkey",
        ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"], "l_linenumber")


@query("""
WITH g AS (SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(*) AS n, count(DISTINCT l_linenumber) AS u FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, n, n - u AS n_repeats, hi - u AS n_missing, lo = 1 AND hi = n AND u = n AS continuous FROM g
""")
def numbering_gap(spark: SparkSession, d: str) -> DataFrame:
    return gates.continuity(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("""
SELECT c_custkey AS custkey, 'right' AS missing_in FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT DISTINCT o_custkey, 'left' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def paper_mapping(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.coverage(table(spark, d, "customer").select(F.col("c_custkey").alias("custkey")),
        table(spark, d, "orders").select(F.col("o_custkey").alias("custkey")), "custkey")


@query("""
SELECT n_nationkey, n_name FROM nation n WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9900) OR EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000)
""")
def or_semi_join(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "customer").where("c_acctbal > 9900").select("c_nationkey",
        F.lit(None).cast("int").alias("s_nationkey")).union(
        table(spark, d, "supplier").where("s_acctbal > 9000").select(F.lit(None).cast("int"), "s_nationkey"))
    nations = table(spark, d, "nation")
    return reconcile.semi_any(nations, both, [("n_nationkey", "c_nationkey"),
        ("n_nationkey", "s_nationkey")]).select("n_nationkey", "n_name")


@query("""
WITH e AS (SELECT l_orderkey AS k, l_linenumber AS s, max_by(l_partkey, l_partkey) AS p FROM lineitem GROUP BY l_orderkey, l_linenumber),
w AS (SELECT o_orderkey AS k, unnest(range(1, 4)) AS s FROM orders)
SELECT w.k AS orderkey, CAST(w.s AS INTEGER) AS suffix, e.p AS l_partkey, p_brand, e.p IS NOT NULL AS bound FROM w LEFT JOIN e ON w.k = e.k AND w.s = e.s LEFT JOIN part ON p_partkey = e.p
""")
def atomize_bind(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"),
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("suffix"))
    entries = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("suffix"), "l_partkey")
    bound, _ = reconcile.bind(wanted, entries, ["orderkey", "suffix"], ["l_partkey"])
    brands = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return bound.join(brands, "l_partkey", "left").select("orderkey", "suffix", "l_partkey", "p_brand",
        F.col("l_partkey").isNotNull().alias("bound"))


@query("""
WITH e AS (SELECT l_orderkey AS k, l_linenumber AS s, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT e.k AS orderkey, e.s AS suffix, e.n AS n_rows FROM e WHERE e.s > 3
""")
def unmatched_entries(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"),
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("suffix"))
    entries = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("suffix")).agg(F.count(F.lit(1)).alias("n_rows"))
    _, unmatched = reconcile.bind(wanted, entries, ["orderkey", "suffix"], ["n_rows"])
    return unmatched.select("orderkey", "suffix", "n_rows")


@query("""
WITH c AS (SELECT a.p_partkey AS l, b.p_partkey AS r, round(1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name)), 6) AS ratio
  FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
SELECT l AS left_key, arg_min(r, (1 - ratio) * 1000000 + r / 1e9) AS right_key, max(ratio) AS ratio FROM c GROUP BY l
""")
def fuzzy_pair_score(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    keys = ["p_brand", "p_type", "p_size"]
    a = part.select(*keys, F.col("p_partkey").alias("l"), F.col("p_name").alias("a"))
    b = part.select(*keys, F.col("p_partkey").alias("r"), F.col("p_name").alias("b"))
    ratio = F.round(1 - F.levenshtein("a", "b") / F.greatest(F.length("a"), F.length("b")), 6)
    scored = a.join(b, keys).where("l < r").select("l", "r", ratio.alias("ratio"))
    return scored.groupBy(F.col("l").alias("left_key")).agg(F.min_by("r",
        F.struct(-F.col("ratio"), F.col("r"))).alias("right_key"), F.max("ratio").alias("ratio"))


@query()
def greedy_fuzzy_pair(spark: SparkSession, d: str) -> DataFrame:
    half = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name"))
    other = F.when(F.col("p_partkey") % 2 == 1, F.col("p_name"))
    folder = F.concat_ws("/", "p_brand", "p_type", F.col("p_size").cast("string"))
    grouped = table(spark, d, "part").groupBy(folder.alias("folder")).agg(F.collect_list(half).alias("a"),
        F.collect_list(other).alias("b"))
    return reconcile.greedy_pairs(grouped, "folder", "a", "b", 0.5)


@query("""
WITH g AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS pool, sum(CAST(l_quantity AS BIGINT)) AS s FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, CAST(sum(CASE WHEN pool IS NULL THEN s ELSE least(s, 40) END) AS BIGINT) AS closable FROM g GROUP BY l_orderkey
""")
def pool_capped_sum(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("marks", F.col("l_quantity").cast("long"))
    return gates.capped_sum(rows, "l_orderkey", "marks", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), 40)


@query("""
WITH l AS (SELECT l_orderkey AS orderkey, CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS v FROM lineitem),
t AS (SELECT l_orderkey AS orderkey, sum(CAST(l_quantity AS BIGINT)) AS total FROM lineitem GROUP BY 1),
g AS (SELECT orderkey, count(*) - count(v) AS m, coalesce(sum(v), 0) AS s FROM l GROUP BY orderkey)
SELECT g.orderkey, CAST(total - s AS BIGINT) AS recovered FROM g JOIN t USING (orderkey) WHERE m = 1 AND total - s > 0
""")
def missing_cell_recovery(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey"),
        F.col("l_quantity").cast("long").alias("q"), "l_linenumber")
    printed = rows.groupBy("orderkey").agg(F.sum("q").alias("total"))
    return gates.recover_missing(rows.withColumn("v", F.when(F.col("l_linenumber") != 2, F.col("q"))), printed,
        "orderkey", "v", "total")


@query("""
WITH e AS (SELECT *, max(CASE WHEN event_type <> 'view' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target FROM events)
SELECT target AS event_id, count(CASE WHEN event_type = 'view' THEN 1 END) AS n_notes, coalesce(string_agg(CASE WHEN event_type = 'view' THEN CAST(event_id AS VARCHAR) END, ',' ORDER BY ts, event_id), '') AS notes
FROM e WHERE target IS NOT NULL GROUP BY target
""")
def retry_demote(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, 0)
    is_note = F.col("event_type") == "view"
    owned = e.withColumn("target", F.max(F.when(~is_note, F.col("event_id"))).over(w)).where("target is not null")
    notes = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(is_note, F.struct("ts", "event_id")))),
        lambda x: x.event_id.cast("string")), ",")
    return owned.groupBy(F.col("target").alias("event_id")).agg(F.count_if(is_note).alias("n_notes"),
        notes.alias("notes"))


@query("""
WITH b AS (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS y, l_orderkey, (row_number() OVER (PARTITION BY l_returnflag, l_linestatus, year(l_shipdate) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 400 AS batch FROM lineitem)
SELECT l_returnflag, l_linestatus, CAST(y AS INTEGER) AS y, CAST(batch AS INTEGER) AS batch, count(*) AS n, min(l_orderkey) AS first_key FROM b GROUP BY ALL
""")
def batch_keys_400(spark: SparkSession, d: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus", "y"]
    rows = table(spark, d, "lineitem").withColumn("y", F.year("l_shipdate")).withColumn("o",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return gates.batches(rows, keys, "o").groupBy(*keys, "batch").agg(F.count(F.lit(1)).alias("n"),
        F.min("l_orderkey").alias("first_key"))


@query("""
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS n_large, count(*) FILTER (WHERE value <= 50) AS n_small, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type
""")
def census_filter_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value") > 50).alias("n_large"), F.count_if(F.col("value") <= 50).alias("n_small"),
        F.countDistinct("user_id").alias("n_users"))


@query("""
SELECT user_id, sha256(string_agg(CAST(event_id AS VARCHAR), chr(10) ORDER BY CAST(event_id AS VARCHAR))) AS ids_sha256, count(*) AS n FROM events GROUP BY user_id
""")
def ordered_id_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d,
        "events").groupBy("user_id").agg(identity.set_id(F.collect_list(F.col("event_id").cast("string"))).alias("ids_sha256"),
        F.count(F.lit(1)).alias("n"))


@query("""
WITH a AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events WHERE event_type = 'click'),
b AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events WHERE event_type = 'view')
SELECT coalesce(a.user_id, b.user_id) AS user_id, count(CASE WHEN a.i IS NOT NULL AND b.i IS NOT NULL THEN 1 END) AS n_matched, count(CASE WHEN b.i IS NULL THEN 1 END) AS n_left, count(CASE WHEN a.i IS NULL THEN 1 END) AS n_right
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id AND a.i = b.i GROUP BY 1
""")
def label_bijection(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return gates.bijection(e.where("event_type = 'click'"), e.where("event_type = 'view'"), "user_id", "event_id",
        "event_id")


@query("""
WITH u AS (SELECT r_regionkey, r_name, row_number() OVER (ORDER BY r_regionkey) AS u FROM region),
t AS (SELECT n_nationkey, n_name, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS t FROM nation)
SELECT 'U' || u AS code, 1 AS level, r_name AS title, CAST(NULL AS VARCHAR) AS parent FROM u
UNION ALL SELECT 'U' || u || '-T' || t, 2, n_name, 'U' || u FROM t JOIN u ON n_regionkey = r_regionkey
UNION ALL SELECT 'U' || u || '-T' || t || '-S' || s, 3, c_mktsegment, 'U' || u || '-T' || t FROM
  (SELECT c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS s FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)) JOIN t ON c_nationkey = n_nationkey JOIN u ON n_regionkey = r_regionkey
""")
def outline_tree(spark: SparkSession, d: str) -> DataFrame:
    number = lambda df, key, order, name: df.withColumn(name,
        F.row_number().over(W.partitionBy(key).orderBy(order)))
    units = number(table(spark, d, "region").withColumn("all", F.lit(1)), "all", "r_regionkey", "u").withColumn("ucode",
        F.concat(F.lit("U"), F.col("u").cast("string")))
    topics = number(table(spark, d, "nation"), "n_regionkey", "n_nationkey", "t").join(F.broadcast(units),
        F.col("n_regionkey") == F.col("r_regionkey")).withColumn("tcode",
        F.concat("ucode", F.lit("-T"), F.col("t").cast("string")))
    subs = number(table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct(), "c_nationkey",
        "c_mktsegment", "s").join(topics, F.col("c_nationkey") == F.col("n_nationkey"))
    return (units.select(F.col("ucode").alias("code"), F.lit(1).alias("level"), F.col("r_name").alias("title"),
        F.lit(None).cast("string").alias("parent"))
            .union(topics.select("tcode", F.lit(2), "n_name",
            "ucode")).union(subs.select(F.concat("tcode", F.lit("-S"), F.col("s").cast("string")), F.lit(3),
            "c_mktsegment", "tcode")))


_TREE = """
WITH RECURSIVE e AS (SELECT 'r' || r_regionkey AS id, 'world' AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation),
t(id, depth, path) AS (SELECT 'world', 0, 'world' UNION ALL SELECT e.id, t.depth + 1, t.path || '/' || e.name FROM t JOIN e ON e.parent = t.id)
SELECT id, depth, path FROM t
"""


@query(_TREE)
def recursive_tree(spark: SparkSession, d: str) -> DataFrame:
    regions, nations = table(spark, d, "region"), table(spark, d, "nation")
    tree = _TREE.replace("FROM region", "FROM {regions}").replace("FROM nation",
        "FROM {nations}").replace("'world', 0, 'world'", "CAST('world' AS STRING), 0, CAST('world' AS STRING)")
    return spark.sql(tree, regions=regions, nations=nations)


@query("""
SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2
""")
def props_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH l AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events),
s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM l)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY 1, 2
""")
def session_islands(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    opens = F.coalesce(F.col("ts") - F.lag("ts").over(w) > F.expr("INTERVAL 30 MINUTES"), F.lit(True))
    marked = lines.islands(table(spark, d, "events").withColumn("opens", opens), "user_id", ["ts", "event_id"],
        F.col("opens"), "session")
    return marked.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"))


@query("""
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2
""")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""
SELECT 'lineitem' AS child, 'orders' AS parent, count(*) AS n_dangling FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'lineitem', 'supplier', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'orders', 'customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for child, a, parent, b in (("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey")):
        lost = gates.dangling(table(spark, d, child), [a], table(spark, d, parent).select(F.col(b).alias(a)))
        row = lost.agg(F.count(F.lit(1)).alias("n_dangling")).select(F.lit(child).alias("child"),
            F.lit(parent).alias("parent"), "n_dangling")
        out = row if out is None else out.union(row)
    return out


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return gates.repeated_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH g AS (SELECT l_orderkey AS k, sum(CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) END) AS s, count(CASE WHEN l_returnflag = 'R' THEN NULL ELSE 1 END) AS c, count(*) AS n FROM lineitem GROUP BY 1),
p AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_quantity AS BIGINT)) - (l_orderkey % 3) AS BIGINT) AS t FROM lineitem GROUP BY l_orderkey)
SELECT CAST(k AS VARCHAR) AS subject, 'mark_sum' AS check_id, CASE WHEN c < n THEN 'review' WHEN s <> t THEN 'fail' ELSE 'ok' END AS severity, concat_ws('/', CAST(CAST(s AS BIGINT) AS VARCHAR), CAST(t AS VARCHAR)) AS detail FROM g JOIN p USING (k)
""")
def mark_sum_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"),
        F.col("l_quantity").cast("long").alias("q"), "l_returnflag")
    printed = rows.groupBy("k").agg(F.sum("q").alias("s")).select("k", (F.col("s") - F.col("k") % 3).alias("total"))
    return gates.mark_sums(rows.withColumn("marks", F.when(F.col("l_returnflag") != "R", F.col("q"))), printed, "k",
        "marks", "total")
