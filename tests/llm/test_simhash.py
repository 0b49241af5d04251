import random

import numpy as np
import pytest
import xxhash

from foliant.llm import simhash


def brute(text):
    w = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, radius=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \t\x0b", "One", "a b", "A b C", "a B c d É ß é", "x y z " * 40, "a b c"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_links(radius):
    rng = random.Random(radius)
    rows, starts = [], [0]
    for size in (1, 2, 63, 64, 65, 200):
        base = rng.getrandbits(64)
        for _ in range(size):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            rows.append(x)
        starts.append(len(rows))
    i, j = simhash.bit_sliced_links(np.array(rows, np.uint64), np.array(starts), radius)
    want = {(a, b) for s, e in zip(starts, starts[1:]) for a in range(s, e) for b in range(a + 1, e)
        if bin(rows[a] ^ rows[b]).count("1") <= radius}
    assert set(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("bucket", [2048, 3])
def test_components_against_brute_force(spark, bucket):
    rng = random.Random(4)
    fps = []
    for _ in range(25):  # clusters, chains through bits of every field, and strays
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 14)):
            fps.append(x)
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
    fps = list(dict.fromkeys(fps))
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    edges = simhash.links(df, bucket).collect()
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, bucket)).collect()}
    got = [roots.get(simhash._signed(x), simhash._signed(x)) for x in fps]
    want = groups(fps)
    assert len(edges) < 7 * 36 * len(fps)
    assert [got.index(g) for g in got] == [want.index(w) for w in want]


def test_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    fps = [brute(r.text) for r in rows]
    root = groups(fps)
    least = {}
    for r, g in zip(rows, root):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {r.doc_id: (simhash._signed(f), least[g]) for r, f, g in zip(rows, fps, root)}


def test_odd_rows(spark, odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.fp == 0} == {1}
    same = [r.component_id for r in got if r.doc_id in (5, 6)]
    assert same == [5, 5, 5]
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(str(x)
        for x in {r.component_id for r in got})
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_rows_without_ids_keep_one(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "d e f g")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(df).collect()) == ["a b c", "d e f g"]


def test_chain_needs_many_rounds(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)}
    assert simhash.components(edges.limit(0)).count() == 0
