"""Every registered query against its SQL."""

import math
import os

import duckdb
import pytest

from foliant.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return c


def rows(records):
    def one(v):
        return repr(float(v)) if isinstance(v, float) and not math.isnan(v) else str(v)

    return sorted(sorted((k, one(v)) for k, v in r.items()) for r in records)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    got = [r.asDict() for r in QUERIES[name](spark, sf).collect()]
    want = con.sql(ORACLES[name]).to_arrow_table().to_pylist()
    assert rows(got) == rows(want)


def test_oracles_are_of_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_queries_without_sql_have_a_test_of_their_own():
    assert set(QUERIES) - set(ORACLES) == {"greedy_fuzzy_pair", "vector_fingerprint"}


def test_greedy_pairs_by_hand(spark):
    sf = "/root/testdata/sf0.01"  # no two names are alike enough in the smaller tables
    from collections import defaultdict
    from difflib import SequenceMatcher

    from foliant.plans.registry import table

    folders = defaultdict(lambda: ([], []))
    for r in table(spark, sf, "part").collect():
        folders[f"{r.p_brand}/{r.p_type}/{r.p_size}"][r.p_partkey % 2].append(r.p_name)
    want = []
    for folder, (left, right) in folders.items():
        free = sorted(right)
        for x in sorted(left):
            scored = [(-SequenceMatcher(None, x, y).ratio(), k) for k, y in enumerate(free)]
            if scored and -min(scored)[0] >= 0.5:
                want.append((folder, x, free.pop(min(scored)[1])))
    got = sorted((r.folder, r.left, r.right) for r in QUERIES["greedy_fuzzy_pair"](spark, sf).collect())
    assert got == sorted(want) and len(got) > 0


def test_fuzzy_pairs_are_greedy(spark):
    from difflib import SequenceMatcher

    from foliant.operators.reconcile import greedy_pairs

    df = spark.createDataFrame([("f", ["ab1", "ab2", "zz"], ["ab2", "ab3"])],
        "folder string, a array<string>, b array<string>")
    got = [(r.left, r.right) for r in greedy_pairs(df, "folder", "a", "b", 0.6).collect()]
    assert got == [("ab1", "ab2"), ("ab2", "ab3")]
    assert SequenceMatcher(None, "ab1", "ab2").ratio() >= 0.6


def test_vector_digest(spark, sf):
    import hashlib
    import struct

    from foliant.plans.registry import table

    got = {r.id: r.sha256 for r in QUERIES["vector_fingerprint"](spark, sf).collect()}
    for r in table(spark, sf, "embeddings").collect():
        assert got[r.vec_id] == hashlib.sha256(struct.pack(f"<{len(r.embedding)}f", *r.embedding)).hexdigest()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
