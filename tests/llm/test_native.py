"""Operators made of DataFrame functions alone."""

import hashlib
import math
import random
import re
import time
import uuid
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from foliant.llm import quality, secrets, sharding, warc
from foliant.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(set(ORACLES)))
def test_oracles(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLES[name]).to_arrow_table().to_pylist()
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(key(r.asDict()) for r in got.collect()) == sorted(key(r) for r in want)


@pytest.mark.parametrize("name", ["op2_secret_markov", "op4_quality_cascade", "op8_extendible_sharding"])
def test_no_python_in_the_plan(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|BatchEval", plan)


def repeats(text):
    w = WORD.findall(text or "")
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = {x for x, c in Counter(g).items() if c > 1}
    return len({k for i, x in enumerate(g) if x in many for k in (i, i + 1, i + 2)})


def test_repeated_words(spark):
    rng = random.Random(3)
    texts = ["", "a", "a a a a", "a b c a b c", "x " * 500] + [" ".join(rng.choice("abcdefgh"[: rng.randint(2, 8)])
        for _ in range(rng.randint(1, 90))) for _ in range(150)]
    texts += [" ".join(f"w{rng.randint(0, 400)}" for _ in range(900)) + " " + " ".join(f"v{i}"
        for i in range(60)) + " " + " ".join(f"v{i}" for i in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.quality_report(df).collect()}
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        ls = [x for x in t.split("\n") if WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words, got[i].n_dup_lines) == (len(w),
            sum(map(len, w)), repeats(t), len(ls) - len(set(ls)))


def test_quality_of_odd_rows(odd, none):
    got = quality.quality_report(odd).collect()
    assert len(got) == odd.count()
    assert all(not r.kept for r in got) and all(r.n_words is not None for r in got)
    assert quality.quality_report(none).count() == 0
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.keep_good(none).count() == 0
    # columns of the same names stay as they are
    clash = odd.withColumn("quality_words", odd.source).withColumn("Quality__n", odd.source)
    table, own = quality.measured(clash)
    assert own == "quality___" and table.select(clash.columns).exceptAll(clash).count() == 0
    out = quality.cascade(clash, quality.rules()[:1])
    assert out.columns == [*clash.columns, "rejected_by_"] and out.drop("rejected_by_").exceptAll(clash).count() == 0


def test_cascade_keeps_the_same_whatever_the_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = quality.rules()
    a = {r.doc_id for r in docs.where(quality.verdict(rules).isNull()).collect()}
    b = {r.doc_id for r in docs.where(quality.verdict(rules[::-1]).isNull()).collect()}
    report = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    assert a == b == report == {r.doc_id for r in quality.keep_good(docs).collect()}
    none = quality.cascade(docs, [])
    assert none.where("rejected_by is not null").count() == 0


def test_further_rules_by_hand(spark):
    plain = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    texts = {
        "symbols": " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)} # $" for i in range(60)),
        "repeated_lines": "\n".join([plain] + [f"q{chr(97 + i // 3)}" for i in range(60)]),
        "word_length": " ".join(chr(97 + i % 26) for i in range(26)) + " " + " ".join("x" * 90 + chr(97 + i)
        for i in range(26)),
        "marks": " ".join(f"{i * 7919:07d}" for i in range(60)),
        "top_word": " ".join(w for i in range(30) for w in (f"a{chr(97 + i % 26)}{chr(97 + i // 26)}b", "the",
        "the")[: 3 if i % 2 else 2] + ("the",)),
        "open_lines": "\n".join(w + (" ..." if i % 3 else "") for i, w in enumerate(plain.split(" "))),
        "bullets": "\n".join("* " + w for w in plain.split(" ")), None: plain,
    }
    df = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    alone = {r.doc_id: [n for n, x in r.asDict().items() if n != "doc_id" and x]
        for r in df.select("doc_id", *[x.rejects.alias(x.name) for x in quality.rules()]).collect()}
    table, own = quality.measured(df)
    ready = {r.doc_id: [n for n, x in r.asDict().items() if n != "doc_id" and x]
        for r in table.select("doc_id", *[x.rejects.alias(x.name)
        for x in quality.base_rules(own) + quality.further_rules(own)]).collect()}
    assert alone == ready
    for i, name in enumerate(texts):
        assert (name in alone[i]) if name else alone[i] == [], (name, alone[i])


def test_order_is_greedy_on_what_is_left(spark, monkeypatch):
    """By rejections per second; a rule whose rejections another has taken goes last."""
    df = spark.range(100).selectExpr("id as doc_id", "cast(id as string) as text")
    rule = lambda name, sql: quality.Rule(name, F.expr(sql))
    given = [rule("a", "doc_id < 40"), rule("b", "doc_id < 50"), rule("c", "doc_id >= 90"),
        rule("null", "cast(null as boolean)")]
    monkeypatch.setattr(quality, "costs", lambda part, rules: [1.0, 1.0, 0.5, 0.1])
    found = quality.order(df, given)
    assert [(r.name, round(share, 3)) for r, _, share in found] == [("b", 0.5), ("c", 0.2), ("null", 0.0), ("a", 0.0)]
    monkeypatch.undo()
    slow = quality.Rule("slow", F.expr("size(filter(sequence(1, 20000), x -> sha2(concat(text, x), 256) = '')) > 0"))
    timed = quality.costs(df, [given[0], slow])
    assert timed[1] > 5 * timed[0]


def test_rules_behind_a_rejection_do_not_run(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    fails = quality.Rule("fails", F.expr("raise_error(text) is null"))
    out = df.withColumn("by", quality.verdict([quality.Rule("all", F.lit(True)), fails]))
    assert [r.by for r in out.collect()] == ["all", "all"]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    t = text or ""
    s = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(s)


def test_secret_spans(spark):
    hexed = hashlib.sha1(b"a").hexdigest()
    texts = [
        None, "", "plain words only", f'token = "{hexed}" tail', "secret: token: abcdef",
        "password=token=abcdefgh PassWord : x1y2z3w4", "AKIA" + "A" * 15, "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 20,
        f"é😀 {hexed[:24]} {hexed[:23]}", "api_key='abc' apikey=\"abcdefg", "\x01 token=abcdefgh \x01",
        " ".join(f"token={hashlib.md5(str(i).encode()).hexdigest()}" for i in range(300)), "api-key = abcdefgh",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = secrets.train(secrets.samples(spark, df.limit(0)))
    got = {r.doc_id: r for r in secrets.secrets_report(df, model).collect()}
    for i, t in enumerate(texts):
        want = base(t)
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), t
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == x for _, k, _ in want)
            for x in range(3))
        assert set(filter(None, joined.split(","))) <= set(filter(None, got[i].spans.split(",")))


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return secrets.train(secrets.samples(spark, docs))


def found_in(spark, model, strings):
    df = spark.createDataFrame([(i, f"see {x} here") for i, x in enumerate(strings)], "doc_id long, text string")
    return {r.doc_id for r in secrets.secrets_report(df,
        model).where("n_markov + n_hex + n_access + n_assign > 0").collect()}


#: Forms of random strings, none made as the training's are; least share to be found.
FORMS = {
    "letters 16": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 16, "{}", 0.9),
    "letters 24": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 24, "{}", 0.97),
    "letters 40": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 40, "{}", 0.99),
    "base32 20": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 20, "{}", 0.95),
    "lower 24": ("abcdefghijklmnopqrstuvwxyz0123456789", 24, "{}", 0.95), "hex 20": ("0123456789abcdef", 20, "{}", 0.9),
    "HEX 32": ("0123456789ABCDEF", 32, "{}", 0.97),
    "base64 43": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 43, "{}=", 0.97),
    "json 32": ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-", 32, '{{"key": "{}"}}', 0.97),
    "address 24": ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 24, "https://x.example/a?k={}&b=1", 0.95),
}


@pytest.mark.parametrize("form", FORMS)
def test_recall_by_form(spark, trained, form):
    alphabet, n, frame, least = FORMS[form]
    rng = random.Random(form)
    strings = [frame.format("".join(rng.choice(alphabet) for _ in range(n))) for _ in range(300)]
    assert len(found_in(spark, trained, strings)) >= least * 300


def test_uuids(spark, trained):
    rng = random.Random(5)
    strings = [str(uuid.UUID(int=rng.getrandbits(128), version=4)) for _ in range(300)]
    assert len(found_in(spark, trained, strings)) >= 285


def test_ordinary_names_are_left_alone(spark, trained, sf):
    rng = random.Random(12)
    german = "Donau Dampf Schiff Fahrt Gesellschaft Kapitän Wetter Dienst Straßen Verkehr Ordnung Versicherung Arbeit Geber Verband Recht Schutz Bund Amt".replace("ä",
        "a").replace("ß", "ss").split()
    english = "get user account number from customer order line total value default network connection manager abstract factory bean proxy internal server error message handler request response body parser config file".split()
    cases = {
        "camel": ["".join(w.title() for w in rng.sample(english, 5)) for _ in range(200)],
        "lowerCamel": ["get" + "".join(w.title() for w in rng.sample(english, 4)) for _ in range(200)],
        "snake": ["_".join(rng.sample(english, 5)) for _ in range(200)],
        "const": ["_".join(rng.sample(english, 4)).upper() for _ in range(200)],
        "kebab": ["-".join(rng.sample(english, 6)) for _ in range(200)],
        "path": ["/".join(["", "usr", "share", *rng.sample(english, 4)]) for _ in range(200)],
        "address": ["https://www.example.com/2024/05/17/" + "-".join(rng.sample(english, 6)) + ".html"
        for _ in range(200)],
        "german": ["".join(w if k == 0 else w.lower() for k, w in enumerate(rng.sample(german, 4)))
        for _ in range(200)], "rules": ["-" * 40, "=" * 60, "_" * 30] * 10,
        "numbers": ["".join(rng.choice("0123456789") for _ in range(20)) for _ in range(200)],
        "dates": ["2024-05-17/2024-06-30", "1999-12-31_2000-01-01"] * 20,
    }
    false = {name: len(found_in(spark, trained, strings)) / len(strings) for name, strings in cases.items()}
    assert all(x <= 0.02 for x in false.values()), false
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert secrets.secrets_report(docs, trained).where("n_markov > 0").count() <= 0.002 * docs.count()


def test_model_and_ratio_by_direct_computation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = secrets.samples(spark, docs, rows=40, strings=60).collect()
    model = secrets.train(spark.createDataFrame([(r.string, r.random) for r in given], "string string, random int"))
    seen = [Counter(), Counter()]
    for r in given:
        s = [2, *(ord(c) for c in r.string), 2]
        seen[r.random].update((a, b) for a, b in zip(s, s[1:]) if a < 128 and b < 128)
    alphabet = sorted({x for c in seen for pair in c for x in pair})
    want = [0] * secrets.SIZE**2
    for a in alphabet:
        odds = []
        for c in seen:
            total = sum(c[a, b] for b in alphabet)
            odds.append({b: (c[a, b] + 0.5) / (total + 0.5 * len(alphabet)) for b in alphabet})
        for b in alphabet:
            want[a * 128 + b] = round(1000 * math.log(odds[1][b] / odds[0][b]))
    assert model == want
    tokens = [r.string for r in given[::37]] + ["a", "Zz9+/=_-"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    for r in df.select("t", secrets.ratio(F.col("t"), model).alias("x")).collect():
        s = [2, *map(ord, r.t), 2]
        assert r.x == sum(want[a * 128 + b] for a, b in zip(s, s[1:]))


def test_model_does_not_depend_on_the_layout(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.limit(20)).union(spark.createDataFrame([(3, "another text under an id"), (None, "no id"),
        (None, None)], "doc_id long, text string"))
    one, many = (secrets.train(secrets.samples(spark, d, 60, 200))
        for d in (docs.coalesce(1), docs.repartition(8).orderBy("text")))
    assert one == many
    assert sum(r.random == 0 for r in secrets.samples(spark, docs, 60, 0).collect()) > 1000


def test_spans_lie_outside_the_base(spark, trained):
    """What a base span leaves of a token is judged on its own."""
    rng = random.Random(8)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    text = "AKIA" + "B" * 16 + "/" + key + " token=abcdefgh and " + "0123456789abcdef" * 2 + "+" + key
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = [x.split(":") for x in secrets.secrets_report(df, trained).first().spans.split(",")]
    assert [k for k, *_ in spans] == ["access", "markov", "assign", "hex", "markov"]
    assert [text[int(s) : int(e)].strip("/+") for k, s, e in spans if k == "markov"] == [key, key]
    assert secrets.redact(df, trained).first().text == "<SECRET> <SECRET> and <SECRET>"


def test_pieces_between_spans(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        text = "".join(rng.choice("aé😀b\n") for _ in range(rng.choice([0, 3, 70, 1023, 1024, 1025, 5000])))
        spans = sorted((s, 0, min(len(text), s + rng.randint(1, rng.choice([3, 2500]))))
            for s in (rng.randrange(len(text)) for _ in range(rng.choice([0, 1, 5, 200]) if text else 0)))
        rows.append((i, text, spans))
    df = spark.createDataFrame(rows, "id int, text string, spans array<struct<s:int,k:int,e:int>>")
    got = df.select("id", secrets.cut(F.col("text"), secrets.gaps(F.col("spans"), F.length("text")), lambda p, i,
        gs: p).alias("p")).collect()
    for (_, text, spans), r in zip(rows, sorted(got)):
        want, at = [], 0
        for k, (s, _, e) in enumerate(spans):
            if k == 0 or s > at:
                want.append(text[at:s])
            at = max(at, e)
        assert r.p == [*want, text[at:]]


def test_time_grows_with_the_text(spark, trained):
    def took(n):
        text = " ".join(f"token=abcdefg{i} {hashlib.md5(str(i).encode()).hexdigest()}" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string").cache()
        df.count()
        best = []
        for f in (secrets.secrets_report, secrets.redact):
            times = []
            for _ in range(2):
                began = time.perf_counter()
                f(df, trained).collect()
                times.append(time.perf_counter() - began)
            best.append(min(times))
        df.unpersist()
        return best

    took(500)
    small, mid, large = took(4000), took(8000), took(32000)
    assert all(z < 6 * y + 1 and y < 3.5 * x + 1 for x, y, z in zip(small, mid, large)), (small, mid, large)


def test_secrets_of_odd_rows(odd, none):
    model = secrets.train(secrets.samples(odd.sparkSession, odd))
    got = secrets.secrets_report(odd, model).collect()
    assert len(got) == odd.count() and all(r.n_assign == 0 for r in got)
    clean = secrets.redact(odd, model)
    assert clean.columns == odd.columns and clean.exceptAll(odd).count() == 0 and odd.exceptAll(clean).count() == 0
    assert secrets.secrets_report(none, model).count() == 0 and secrets.redact(none, model).count() == 0
    assert secrets.train(secrets.samples(odd.sparkSession, none).limit(0)) == [0] * secrets.SIZE**2


def test_redaction(spark):
    h = hashlib.sha1(b"b").hexdigest()
    df = spark.createDataFrame([(1, f'a é token = "{h}" b {h} c', 9), (2, "clean", 5), (3, None, None),
        (4, f"token={h}", 1)], "doc_id long, text string, n_chars long")
    model = secrets.train(secrets.samples(spark, df))
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(df, model).collect()}
    assert got == {1: ('a é <SECRET>" b <SECRET> c', 26), 2: ("clean", 5), 3: (None, None), 4: ("<SECRET>", 8)}


def shards(rows, limit):
    """(depth, prefix) of each (hash, bytes) by splitting one bucket at a time."""
    out = [None] * len(rows)
    todo = [(0, 0, list(range(len(rows))))]
    while todo:
        d, p, at = todo.pop()
        if sum(rows[i][1] for i in at) <= limit or len({rows[i][0] for i in at}) <= 1:
            for i in at:
                out[i] = (d, p)
            continue
        for bit in (0, 1):
            todo.append((d + 1, 2 * p + bit, [i for i in at if rows[i][0] >> (59 - d) & 1 == bit]))
    return out


def test_sharding_by_splits(spark):
    rng = random.Random(5)
    data = [(i, "x" * rng.choice([0, 10, 100, 3000])) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    rows = [(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), len(t)) for i, t in data]
    want = {i: f"{d}:{p}" for (i, _), (d, p) in zip(data, shards(rows, 4000))}
    got = sharding.shard(df, limit=4000).collect()
    assert {r.doc_id: r.shard for r in got} == want
    assert all(r.shard_bytes <= 4000 and not r.oversized for r in got)


def test_sharding_of_repeated_keys_and_large_rows(spark, odd, none):
    df = spark.createDataFrame([(1 if i < 60 else i, "x" * 500) for i in range(90)] + [(1, "y" * 9000)],
        "doc_id long, text string")
    got = sharding.shard(df, limit=2000).collect()
    assert len(got) == 91
    assert [r.n_bytes for r in got if r.oversized] == [9000]
    sums = Counter()
    for r in got:
        sums[r.shard] += r.n_bytes
    assert all(sums[r.shard] == r.shard_bytes for r in got)
    found = sharding.shard(odd, limit=100).collect()
    assert len(found) == odd.count()
    assert sharding.shard(none).count() == 0


def record(spark, rows):
    return spark.createDataFrame(rows, warc.RECORD)


def test_revisits(spark):
    h = {"etag": "x", "date": "1", "content-type": "t", "vary": "a"}
    rows = [
        ("a", "response", "http://www.A.org:80/p/?b=2&a=1#f", 100, '"x"', "m1", h, "d1"),
        ("b", "response", "https://a.org/p?a=1&b=2&utm_source=q", 200, '"y"', None, None, "d2"),
        ("c", "response", "https://a.org/p?a=1&b=2", 200, '"z"', "m2", h, "d3"),
        ("r1", "revisit", "http://a.org/p?b=2&a=1", 150, 'W/"x"', None,
        {"date": "9", "content-type": "no", "server": "s"}, None),
        ("r2", "revisit", "http://a.org/p?b=2&a=1", 200, '"x"', None, None, None),
        ("r3", "revisit", "http://a.org/p?b=2&a=1", 300, '"x"', None, None, None),
        ("r4", "revisit", "http://a.org/p?b=2&a=1", 900_000, None, "m2", {"etag": "new"}, None),
        ("r5", "revisit", "http://a.org/p?b=2&a=1", 100, None, None, None, None),
        ("r6", "revisit", None, 100, None, None, None, None),
        ("r7", "revisit", "http://a.org/p?b=2&a=1", None, '"x"', None, None, None),
        ("r8", "revisit", "http://a.org/p?b=2&a=1", 900_000, None, None, None, None),
        ("r8", "revisit", "http://a.org/p?b=2&a=1", 900_000, None, None, None, None),
    ]
    got = warc.resolve(record(spark, rows)).collect()
    assert sum(r.record_id == "r8" for r in got) == 2
    by = {r.record_id: r for r in got}
    assert {k: (r.status, r.response_id) for k, r in by.items()} == {
        "r1": ("resolved", "a"), "r2": ("resolved", "a"), "r3": ("validator_mismatch", "c"), "r4": ("resolved", "c"),
        "r5": ("no_earlier", None), "r6": ("no_earlier", None), "r7": ("no_earlier", None), "r8": ("no_validator", "c")}
    assert by["r1"].headers == {"etag": "x", "date": "9", "content-type": "t", "vary": "a"} and by["r1"].digest == "d1"
    assert by["r4"].headers["etag"] == "new" and by["r3"].headers is None
    assert warc.resolve(record(spark, rows).limit(0)).count() == 0


def test_hot_url_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(f"x{i}", rng.choice(["response", "revisit"]), "http://hot.org/" if rng.random() < 0.7
        else f"http://h{rng.randint(0, 9)}.org/", rng.randint(0, 400_000), None, None, None, None) for i in range(800)]
    got = {r.record_id: r.response_id for r in warc.resolve(record(spark, rows)).collect()}
    for i, kind, url, t, *_ in rows:
        if kind == "revisit":
            full = [(tt, r) for r, k, u, tt, *_ in rows if k == "response" and u == url and tt < t]
            assert got[i] == (max(full)[1] if full else None)


def test_captures_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None, "c"), (None, "http://x.org", "", "c"), (3, "", "<p>", "c"),
        (3, "", "<p>", "c")], "page_id long, url string, html string, t0 string")
    assert warc.revisits(spark, pages).where("status is null").count() == 0
    assert warc.revisits(spark, pages.limit(0)).count() == 0
