"""Operators that run in Python workers: brute force, round trips and held-out accuracy."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from foliant.llm import html, lz, packing, toxicity

TEXTS = [
    "", " ", "  ", "a", "\n", "\n\n", "a \nb", "a  b", "  x  ", "\n a", " \n", "▁", "a▁b ▁", "é́ 😀 ﬁ", "\ta\t",
    "x" * 100 + " y", "ab" * 300 + "  " + "(" * 77, "a\n\n  b\r\nc ", "\x00\x01",
    "<|endoftext|> it's we'll 123456 ..." + " " * 40 + "end", "The quick brown fox. Él lleva años, über alles!",
]


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_ids_are_those_of_the_vocabulary(spark, sf):
    texts = TEXTS + ["a" * 30000, " " * 30000, "é" * 9000] + [r.text
        for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    encode, t = packing.load_encoder(), tokenizer()
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x<|endoftext|", "  <|endoftext|>  \n",
        "<|endoftext|>" * 300 + "y", "x<|EndOfText|>", "<|endoftext|>" + " " * 30000 + "é" * 9000 + "<|endoftext|>"]
    assert encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    for x in texts:
        assert encode(x).tolist() == t.encode(x, add_special_tokens=False).ids


def check_packing(rows, texts, length):
    """Every id in one piece, sequences gapless, no sequence padded."""
    t = tokenizer()
    ids = [t.encode(x or "", add_special_tokens=False).ids + [packing.END] for x in texts]
    left = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        left[r.sequence_id].append(r)
    for seq in left.values():
        at = 0
        for r in seq:
            assert r.offset == at
            at += r.length
        assert at == length or (at < length and at & (at - 1) == 0)
    pool = defaultdict(list)
    for r in rows:
        pool[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    return ids, pool, left


@pytest.mark.parametrize(("length", "windows", "fan"), [(2048, 16, 64), (64, 2, 2), (16, 1, 2)])
def test_packing(spark, sf, length, windows, fan):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(7).cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs, length, windows, fan).collect()
    ids, pool, left = check_packing(rows, list(texts.values()), length)
    for (doc_id, _), own in zip(texts.items(), ids):
        at = 0
        for start, n, crc, total in sorted(pool[doc_id]):
            assert start == at and total == len(own) and crc == zlib.crc32(np.array(own[at : at + n], "<u4").tobytes())
            at += n
        assert at == len(own)
    short = [sum(r.length for r in s) for s in left.values() if sum(r.length for r in s) < length]
    assert len(short) == len(set(short)) and sum(short) < length
    docs.unpersist()


def test_packer_fits_best():
    out = []
    p = packing.Packer(out.append, 16, 2)
    for n in (10, 12, 4, 6, 5):
        p.add(packing.Piece(n, 0, n, np.zeros(n, np.uint32)))
    # 4 goes best to the 12, 6 to the 10; 5 opens a window
    assert [[x.doc_id for x in w.pieces] for w in out] == [[12, 4], [10, 6]] and [w.fill for w in p.open] == [5]


def place(lengths, size, windows):
    """Sequences and open windows as lists of (document, ids), straight from the rules."""
    out, open_ = [], []
    for d, n in enumerate(lengths):
        while n >= size:
            out.append([(d, size)])
            n -= size
        if not n:
            continue
        room = {k: size - sum(x for _, x in w) for k, w in enumerate(open_)}
        fit = [k for k in room if room[k] >= n]
        if fit:
            k = min(fit, key=lambda k: (room[k], k))
            open_[k].append((d, n))
            if room[k] == n:
                out.append(open_.pop(k))
            continue
        if len(open_) == windows:
            k = min(room, key=lambda k: (room[k], k))
            open_[k].append((d, room[k]))
            n -= room[k]
            out.append(open_.pop(k))
        open_.append([(d, n)])
    return out, open_


@pytest.mark.parametrize(("size", "windows"), [(16, 1), (16, 3), (64, 4), (128, 16)])
def test_packer_against_its_rules(size, windows):
    rng = random.Random(size * windows)
    for _ in range(40):
        lengths = [rng.choice([1, 2, rng.randint(1, size), rng.randint(1, 3 * size)])
            for _ in range(rng.randint(0, 80))]
        emitted = []
        p = packing.Packer(emitted.append, size, windows)
        for d, n in enumerate(lengths):
            p.add(packing.Piece(d, 0, n, np.arange(n, dtype=np.uint32)))
            assert len(p.open) <= windows
        shape = lambda ws: [[(x.doc_id, len(x.ids)) for x in w.pieces] for w in ws]
        assert (shape(emitted), shape(p.open)) == place(lengths, size, windows)
        ids = {}
        for w in (*emitted, *p.open):
            for x in w.pieces:
                assert x.ids.tolist() == list(range(x.start, x.start + len(x.ids)))
                ids.setdefault(x.doc_id, []).extend(x.ids.tolist())
        assert {d: sorted(v) for d, v in ids.items()} == {d: list(range(n)) for d, n in enumerate(lengths)}


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack(odd, 64).collect()
    check_packing(rows, [], 64)
    own = [len(packing.load_encoder()(r.text or "")) + 1 for r in odd.select("text").collect()]
    assert sum(r.length for r in rows) == sum(own)
    assert packing.pack(none).count() == 0


def phrases(data):
    """LZ78 phrases by definition."""
    seen, at, out = set(), 0, []
    while at < len(data):
        n = 1
        while at + n <= len(data) and data[at : at + n] in seen:
            n += 1
        if at + n > len(data):
            break
        seen.add(data[at : at + n])
        out.append(data[at : at + n])
        at += n
    return out


def test_phrases():
    rng = random.Random(2)
    for _ in range(40):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 300)))
        state = lz.Phrases().feed(data)
        assert len(state.known) == len(phrases(data))
        cut = rng.randint(0, len(data))
        half = lz.Phrases().feed(data[:cut])
        copy = half.copy().feed(b"zzz")
        assert half.feed(data[cut:]).hashes == state.hashes and copy.at is not None


def test_sketch_estimates_shared_phrases():
    rng = random.Random(3)
    for share in (0.0, 0.3, 0.6, 0.9, 1.0):
        common = [rng.getrandbits(60) for _ in range(int(3000 * share))]
        a, b = (np.array(common + [rng.getrandbits(60) for _ in range(3000 - len(common))], np.uint64)
            for _ in range(2))
        union = 6000 - len(common)
        assert abs(lz.likeness(lz.sketch(a), lz.sketch(b)) - len(common) / union) < 0.13
    assert lz.likeness(lz.sketch(np.array([], np.uint64)), lz.sketch(np.array([5], np.uint64))) == 0


def test_report_against_brute_force(spark, sf):
    import hashlib

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in lz.fingerprint_report(docs).collect()}
    fp = lambda t: lz.Phrases().feed(t.encode()).sketch()
    for k, (i, t) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        e = lz.edit(t, other)
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t),
            hashlib.sha256(e.encode()).hexdigest(), lz.text_of(fp(t)), lz.text_of(fp(e)))
        assert (r.near_edited, r.near_next) == (lz.likeness(fp(t), fp(e)), lz.likeness(fp(t), fp(other)))
    near = sorted(r.near_edited for r in got.values())
    far = sorted(r.near_next for r in got.values())
    assert near[len(near) // 10] > far[len(far) * 8 // 10]


def test_fingerprints_of_odd_rows(spark, odd, none):
    got = lz.fingerprint_report(odd).collect()
    assert len(got) == odd.count()
    assert len({r.fingerprint for r in got if r.doc_id in (5, 6)}) == 1
    assert {r.near_edited for r in got if r.n_chars == 0} == {1.0}
    assert lz.fingerprint_report(none).count() == 0
    one = lz.fingerprint_report(odd.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_main_text_of_held_out_pages():
    rng = random.Random(99)
    made = [html.labelled_page(rng) for _ in range(150)]
    got = html.texts(made, html.model())
    exact = 0
    for page, text in zip(made, got):
        p = html.parse(page, marks=True)
        exact += text == "\n".join(t for n, t in p.segments if p.mark[n] == "y")
    assert exact >= 142


def test_main_text_of_pages(spark, sf):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    for r in pages.collect():
        inner = re.sub("<[^>]*>", "", re.sub("</?(?:h1|p)>", "\x00",
            re.sub("<br>", " ", r.html[r.html.index("<article>") : r.html.index("</article>")])))
        want = "\n".join(x for x in (" ".join(unescape(t).split()) for t in inner.split("\x00")) if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_decoding_is_consistent():
    rng = random.Random(7)
    batch = html.Batch([html.parse(html.labelled_page(rng)) for _ in range(30)])
    score = np.array([rng.uniform(-2, 2) for _ in batch.tag])
    keep = html.decode(batch, score)
    assert all(keep[p] for k, p in zip(keep, batch.parent) if k and p >= 0)

    def best(n):  # by definition, over the subtree
        own = score[n] * (batch.chars[n] + 1) + sum(max(0.0, best(c)) for c in np.flatnonzero(batch.parent == n))
        return own

    for root in np.flatnonzero(batch.parent == -1)[:10]:
        rows = [n for n in range(len(keep)) if batch.page[n] == batch.page[root]]
        assert abs(sum(score[n] * (batch.chars[n] + 1) for n in rows if keep[n]) - sum(max(0.0, best(r)) for r in rows
            if batch.parent[r] == -1)) < 1e-6


def test_odd_pages(spark):
    odd = [None, "", "no markup", "<<<>>>< p", "<div><a href='x\"'>t", "<p>a<p>b", "<script>x", "<!-- ",
        "<table><tr><td>a<td>b<tr><td>c", "</div></p>", "<div>" * 3000 + "deep", "<p " + "a='" * 2000,
        "&#x110000;&bogus;", "<ul><li>a<li>b</ul>" * 500]
    df = spark.createDataFrame([(i, None, h, "clash") for i, h in enumerate(odd)] + [(None, "u", "<p>x", "clash")],
        "page_id long, url string, html string, text string")
    got = html.extract(df).collect()
    assert len(got) == len(odd) + 1 and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert html.extract(df.limit(0)).count() == 0
    assert html.parse("<p>a &amp; b<br>c</p><p>d").segments == [(0, "a & b c"), (1, "d")]


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    assert model.cuts == sorted(model.cuts) and len(model.weights) <= toxicity.FEATURES
    held = toxicity.score(docs, model).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "label"),
        "doc_id").collect()
    yes, no = [r for r in held if r.label], [r for r in held if not r.label]
    assert sum(r.toxic for r in no) <= 0.01 * len(no)
    assert sum(r.toxic for r in yes) >= 0.8 * len(yes)
    assert all(0 <= r.expected_severity <= len(model.cuts) for r in held)


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 600)
    pairs = [[(0, np.log1p(int(g) * 3 + 1)), (1 + int(rng.integers(5)), np.log(2))] for g in grades]
    w, cuts = toxicity.train(pairs, grades, 6)
    model = toxicity.OrdinalModel({str(i): float(x) for i, x in enumerate(w)}, list(cuts))
    x = np.array([sum(w[i] * c for i, c in p) for p in pairs])
    expected = model.expected(x)
    means = [expected[grades == g].mean() for g in range(4)]
    assert means == sorted(means) and list(cuts) == sorted(cuts) and np.abs(expected - grades).mean() < 0.5


def test_regression_against_a_plain_solver():
    """Without a penalty the loss comes down to where plain gradient descent, run to rest, brings it; weights have both signs."""
    rng = np.random.default_rng(2)
    x = (rng.random((300, 3)) < 0.5) * rng.random((300, 3))
    score = 2 * x[:, 0] - 3 * x[:, 1] + rng.logistic(size=300)
    grades = np.searchsorted([-1.0, 0.3, 1.5], score)
    pairs = [[(j, float(v)) for j, v in enumerate(row) if v] for row in x]
    over = grades[:, None] > np.arange(3)[None, :]

    def loss(w, b):
        p = 1 / (1 + np.exp(b[None, :] - (x @ w)[:, None]))
        return -np.where(over, np.log(p), np.log(1 - p)).sum() / 300

    w, b = np.zeros(3), np.array([-1.0, 0.0, 1.0])
    for _ in range(20_000):
        e = (1 / (1 + np.exp(b[None, :] - (x @ w)[:, None])) - over) / 300
        w, b = w - 0.5 * x.T @ e.sum(axis=1), b + 0.5 * e.sum(axis=0)
    got, cuts = toxicity.train(pairs, grades, 3, steps=6000, l1=0.0)
    assert loss(got, cuts) < loss(w, b) + 1e-3 and np.abs(got - w).max() < 0.15 and got[0] > 1 and got[1] < -1
    sparse, _ = toxicity.train(pairs, grades, 3, l1=1.0)
    assert not sparse.any()


def test_windows():
    for n in (0, 1, 99, 100, 101, 149, 150, 151, 1000):
        hits = [(i, i) for i in range(0, n, 3)]
        got = list(toxicity.windows(n, hits))
        starts = [0] if n <= 100 else [*range(0, n - 100, 50), n - 100]
        assert got == [(min(n, 100), [i for i, _ in hits if s <= i < s + 100]) for s in starts]


def test_severity_does_not_follow_length(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = docs.join(labels,
        "doc_id").where("lang = 'en' and length(text) between 600 and 1400").orderBy("doc_id").select("text",
        "toxic").collect()
    of = model.scorer()
    severity = lambda t: float(model.expected(np.array([of(t)]))[0])
    clean = [r.text for r in rows if not r.toxic and of(r.text) <= 0][:200]
    filler = " ".join(clean)
    bad = [r.text for r in rows if r.toxic and of(r.text) > model.cuts[0] + 1][:40]
    assert len(bad) >= 15 and len(filler) > 100_000
    alone = np.array([severity(t) for t in bad])
    often, within = (np.array([severity(f(t)) for t in bad])
        for f in (lambda t: " ".join([t] * 30), lambda t: f"{filler} {t} {filler}"))
    assert alone.min() > 0.5 and within.min() > 0.5
    for other in (often, within):  # windows fall otherwise, so single ones differ a little either way
        assert abs((other - alone).mean()) < 0.35 and np.abs(other - alone).mean() < 0.45


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (4, 0, 0), (None, 1, 1), (5, None, None), (99, 1, 1)],
        "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == odd.count() and all(r.toxic is not None for r in got)
    assert len({r.expected_severity for r in got if r.doc_id in (5, 6)}) == 1
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns
    assert toxicity.toxicity(none, labels).count() == 0
    assert not any(r.toxic for r in toxicity.toxicity(odd, labels.limit(0)).collect())


@pytest.mark.parametrize("page", [
    '<p>one</p><svg class="x"/><p>two</p><p>three</p>',
    '<p>one</p><svg-icon name="a"></svg-icon><p>two</p><p>three</p>',
    "<p>one</p><title-bar>two</title-bar><p>three</p>",
    "<p>one</p><template-x></template-x><style-x>two</style-x><p>three</p>",
    "<p>one</p><!--><p>two</p><!---><p>three</p><!-- no -->",
    "<p>one</p><svg><title>no</title></svg ><p>two</p><p>three</p>",
    "<html><head><meta charset=x><title>no</title><p>one</p><p>two</p><p>three</p>",
    "<head><title>no</title>one<p>two</p>three", "<head><link rel=x><script>no</script><b>one</b> two<p>three",
    "<p>one</p><svg a='>' /><p>two</p><script>no</script x><p>three</p>",
])
def test_pages_are_read_to_their_end(page):
    assert " ".join(t for _, t in html.parse(page).segments).split() == ["one", "two", "three"]


def test_features_do_not_depend_on_other_pages():
    own = html.parse("<p>one two</p><div><p>three</p></div><p>four</p>")
    alone = html.Batch([own]).features()
    for other in ("<p>x", "<div>" + "<p>y</p>" * 40 + "</div>"):
        assert np.array_equal(html.Batch([html.parse(other), own]).features()[-len(alone):], alone)
