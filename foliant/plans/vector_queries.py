"""Queries over embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import vectors as v
from foliant.operators import vectors
from foliant.plans.registry import query, table

_COS = "list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) / (sqrt(list_dot_product(CAST({a} AS DOUBLE[]), CAST({a} AS DOUBLE[]))) * sqrt(list_dot_product(CAST({b} AS DOUBLE[]), CAST({b} AS DOUBLE[]))))"


def _moved(e: DataFrame) -> DataFrame:
    """vec_id, old and new vectors: new has every eighth entry turned."""
    new = F.transform("embedding", lambda x, i: F.when(i % 8 == 0, -x.cast("double")).otherwise(x.cast("double")))
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("old"), new.alias("new"))


_MOVED = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS old, list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: CASE WHEN (i - 1) % 8 = 0 THEN -x ELSE x END) AS new FROM embeddings"


@query(f"SELECT a.vec_id, round({_COS.format(a='a.embedding', b='b.embedding')}, 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(other, "vec_id").select("vec_id",
        F.round(v.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query(f"""
WITH m AS ({_MOVED}), c AS (SELECT round({_COS.format(a='old', b='new')}, 6) AS s FROM m), l AS (SELECT list_sort(list(s)) AS xs FROM c)
SELECT CAST(len(xs) AS BIGINT) AS n, round(list_median(xs), 6) AS median_similarity, xs[1] AS min_similarity, xs[len(xs) // 10 + 1] AS p10, list_median(xs) >= 0.85 AS passed FROM l
""")
def drift_gate(spark: SparkSession, d: str) -> DataFrame:
    """In the SQL a row without a vector counts as null, and a vector without length has NaN."""
    m = _moved(table(spark, d, "embeddings"))
    cosine = F.when(v.dot(F.col("old"), F.col("old")) == 0, float("nan")).when(F.col("old").isNotNull(),
        v.cosine(F.col("old"), F.col("new")))
    found = vectors.drift(m.select(F.round(cosine, 6).alias("similarity")), "similarity", missing=True)
    return found.withColumn("n", F.nullif("n", F.lit(0)))


@query(f"""
WITH p AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, round(1 - {_COS.format(a='q.embedding', b='r.embedding')}, 6) AS distance, 1 - {_COS.format(a='q.embedding', b='r.embedding')} AS exact
  FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0),
w AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(exact, 12), neighbour_id) AS rank FROM p)
SELECT query_id, neighbour_id, CAST(rank AS INTEGER) AS rank, distance FROM w WHERE rank <= 10
""")
def knn_top10(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    found = vectors.nearest(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding")
    return found.withColumn("distance", F.round("distance", 6))


@query(f"""
WITH m AS ({_MOVED}), q AS (SELECT * FROM m WHERE vec_id % 100 = 0),
p AS (SELECT q.vec_id AS id, m.vec_id AS n, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(1 - {_COS.format(a='q.old', b='m.old')}, 12), m.vec_id) AS a,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY round(1 - {_COS.format(a='q.new', b='m.old')}, 12), m.vec_id) AS b FROM q JOIN m ON q.vec_id <> m.vec_id)
SELECT id AS vec_id, round(count(CASE WHEN a <= 10 AND b <= 10 THEN 1 END) / count(CASE WHEN a <= 10 OR b <= 10 THEN 1 END), 6) AS overlap FROM p GROUP BY id
""")
def neighbour_jaccard(spark: SparkSession, d: str) -> DataFrame:
    m = _moved(table(spark, d, "embeddings"))
    rows = m.select("vec_id", F.col("old").alias("embedding"))
    near = lambda c, name: vectors.nearest(rows,
        m.where("vec_id % 100 = 0").select("vec_id", F.col(c).alias("embedding")), "vec_id",
        "embedding").groupBy(F.col("query_id").alias("vec_id")).agg(F.collect_set("neighbour_id").alias(name))
    both = near("old", "a").join(near("new", "b"), "vec_id")
    return both.select("vec_id", F.round(v.jaccard(F.col("a"), F.col("b")), 6).alias("overlap"))


@query("""
SELECT vec_id, label FROM (SELECT vec_id, label, CASE WHEN vec_id % 17 = 0 THEN NULL ELSE embedding END AS e, 1 + label % 3 AS rev FROM embeddings) WHERE e IS NULL OR rev < 2 ORDER BY vec_id LIMIT 100
""")
def tranche_selector(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "label",
        F.when(F.col("vec_id") % 17 != 0, F.col("embedding")).alias("e"), (1 + F.col("label") % 3).alias("rev"))
    return vectors.tranche(e, "e", "rev", 2, "vec_id", 100).select("vec_id", "label")


@query("SELECT CAST(len(embedding) AS INTEGER) AS dimension, count(*) AS n FROM embeddings GROUP BY 1")
def dimension_census(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d,
        "embeddings").groupBy(F.size("embedding").alias("dimension")).agg(F.count(F.lit(1)).alias("n"))


@query()
def vector_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return vectors.fingerprint(table(spark, d, "embeddings"), "vec_id", "embedding")
