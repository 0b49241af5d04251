import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from foliant.llm import quality, simhash, toxicity
from foliant.llm.queries import ORACLES, QUERIES


def test_stages(spark, sf):
    """Each stage's decisions take effect, and all but the last keep the columns of documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "simhash_near_dedup", "secret_scan", "packing"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = [docs]
    for _, f in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.common.written(f(spark, seen[-1], sf), "test"))
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in seen]
    assert all(x.columns == docs.columns for x in seen[:-1])
    assert ids[1] == {r.doc_id for r in toxicity.toxicity(docs, labels).where("not toxic").collect()}
    assert ids[2] == {r.doc_id for r in quality.quality_report(seen[1]).where("kept").collect()}
    assert ids[3] == {r.component_id for r in simhash.near_duplicates(seen[2]).collect()}
    assert ids[4] == ids[3] == ids[5]
    assert seen[4].where("text rlike '[0-9a-f]{24}'").count() == 0
    whole = seen[5].groupBy("doc_id", "doc_tokens").sum("length").where("doc_tokens <> `sum(length)`")
    assert whole.count() == 0
    got = corpus_pipeline.run(spark, sf)
    assert got.select("doc_id", "start", "length",
        "ids_crc32").exceptAll(seen[5].select("doc_id", "start", "length", "ids_crc32")).count() == 0


def test_empty_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.written(f(spark, docs, sf), "empty")
    assert docs.count() == 0


def test_odd_rows_go_through_all_stages(spark, sf, odd):
    """Nulls, repeated rows, copies, very long texts and clashing names: what stays, stays whole, and once."""
    rng = random.Random(6)
    good = lambda n: " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou")
        for _ in range(rng.randint(1, 4))) for _ in range(n))
    one, two, three, long = good(90), good(90), good(90), good(60_000)
    rows = [(100, one), (100, one), (101, one), (None, two), (None, two), (102, three + " token=abcdefgh1"),
        (103, long)]
    more = spark.createDataFrame([(i, t, *["x"] * (len(odd.columns) - 2)) for i, t in rows], odd.schema)
    docs = odd.union(more).repartition(5)
    for name, f in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.common.written(f(spark, docs, sf), f"odd-{name}")
        if name != "packing":
            assert docs.columns == odd.columns and docs.dtypes == odd.dtypes
            if name != "secret_scan":
                assert docs.exceptAll(before).count() == 0
        else:
            last = before
    assert sorted((r.doc_id or 0, r.text) for r in last.collect()) == sorted([(100, one), (0, two),
        (102, three + " <SECRET>"), (103, long)])
    assert {r.rejected_by for r in last.collect()} == {"x"}
    encode = corpus_pipeline.packing.load_encoder()
    total = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert total == {r.doc_id: len(encode(r.text)) + 1 for r in last.collect()}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_run(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = spark.read.parquet(f"{sf}/{'pages' if 'html' in name else 'documents'}.parquet").count()
    assert df.count() >= rows and df.schema == QUERIES[name](spark, sf).schema


def test_eleven_queries():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
