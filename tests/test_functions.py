import hashlib

import pytest
from pyspark.sql import functions as F

from foliant.functions import identity, register, text, vectors


@pytest.fixture
def q(spark):
    return lambda value, f, kind="string": spark.createDataFrame([(value,)],
        f"x {kind}").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(("given", "want"), [("a &amp;lt; &#65;", "a &lt; A"), ("&#x1F600; &#233;", "😀 é"),
    ("&#xD800; &#x110000; &foo; &", "&#xD800; &#x110000; &foo; &"), ("plain", "plain"), (None, None)])
def test_entities(q, given, want):
    assert q(given, text.decode_entities) == want


def test_char_map_takes_the_longest_and_does_not_rescan(q):
    assert q("abc\x01\tz", lambda x: text.map_chars(x, {"a": "b", "ab": "a", "c": "", "b": "X"})) == "a \tz"


@pytest.mark.parametrize(("given", "want"), [("(a) State the law.", "state"),
    ("Copper is extracted. Show that it melts.", "show that"), ("Showing off.", None),
    ("(a) (ii) Name, then list.", "name"), ("Deduce", "deduce"), (None, None)])
def test_command_words(q, given, want):
    assert q(given, text.command_word) == want


def test_hint(q):
    assert q("One two. Three", text.summary_hint) == "One two."
    long = q("word " * 80, text.summary_hint)
    assert len(long) <= 200 and long.endswith("word") and q("  ", text.summary_hint) is None


def test_mark_points(q):
    got = q("a or b ecf (1) any two from (2) dependent on MP1, MP 2", text.mark_points)
    assert [(p.ordinal, p.text, p.marks, p.alternatives, p.ecf, p.any_two, p.dependent_on) for p in got] == [
        (1, "a", 1, ["b ecf"], True, False, []), (2, "any two from", 2, [], False, True, []),
        (3, "dependent on MP1, MP 2", None, [], False, False, ["MP1", "MP2"])]
    assert q("no marker", text.mark_points) == [] and q("(1)", text.mark_points) == []


@pytest.mark.parametrize(("given", "want"), [("a-i", "(a)(i)"), ("*14", ""), ("12(b)(ii)", "(b)(ii)"), ("(c)", "(c)")])
def test_suffix(q, given, want):
    assert q(given, text.suffix) == want


def test_small_ones(q):
    assert q("Q u e s  t i", text.collapse_spaced) == "Ques ti" and q("a bc d", text.collapse_spaced) == "a bc d"
    assert q(r"a $x$ \$ $", text.inline_math_count) == 1
    assert q("Do not accept: x", text.note_kind) == "reject" and q("Do not accept: x", text.note_text) == "x"
    assert q("MP2 dependent on MP1", text.guidance_kind) == "dependent" and q("Example graph",
        text.guidance_kind) == "example-diagram"
    assert q("The only correct answer is B", text.correct_letter) == "B" and q("(c)",
        text.correct_letter) == "c" and q("Because A", text.correct_letter) is None
    assert q("abcde", text.estimated_tokens) == 2


def test_identity(spark, q):
    h = hashlib.sha256(b"x").hexdigest()
    n, want = int(h[:32], 16), ""
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    while n:
        n, k = divmod(n, 62)
        want = alphabet[k] + want
    assert q(h, identity.base62) == want
    got = q(" ABC ", lambda x: identity.document_id(x, F.lit("E"), F.lit(None).cast("string")))
    d = hashlib.sha256(b"sha256:abc|engine:e|version:").hexdigest()
    assert got == f"{d[:8]}-{d[8:12]}-5{d[13:16]}-{'89ab'[int(d[16], 16) % 4]}{d[17:20]}-{d[20:32]}"


def test_images(q):
    png = bytes.fromhex("89504e470d0a1a0a0000000d49484452") + (640).to_bytes(4, "big") + (480).to_bytes(4, "big")
    gif = b"GIF89a" + (3).to_bytes(2, "little") + (5).to_bytes(2, "little")
    assert q(bytearray(png), identity.mime, "binary") == "image/png" and tuple(q(bytearray(png), identity.size_of_image,
        "binary")) == (640, 480)
    assert tuple(q(bytearray(gif), identity.size_of_image, "binary")) == (3, 5) and q(bytearray(b"xx"), identity.mime,
        "binary") is None
    assert q(bytearray(b"RIFF0000WEBP"), identity.mime, "binary") == "image/webp"


def test_vectors_and_names(spark):
    row = spark.sql("SELECT array(1D, 0D) a, array(1D, 1D) b, array(0D, 0D) z")
    got = row.select(vectors.cosine(F.col("a"), F.col("b")), vectors.cosine(F.col("a"), F.col("z")),
        vectors.jaccard(F.array(), F.array())).first()
    assert abs(got[0] - 0.5**0.5) < 1e-12 and got[1] == 0.0 and got[2] == 1.0
    assert len(register.register(spark)) == 4
    assert spark.sql("SELECT foliant_suffix('a-i'), foliant_estimated_tokens('abcde')").first()[:] == ("(a)(i)", 2)


def test_written_tables(spark):
    from foliant.operators.shared import own_dir, written

    df = spark.createDataFrame([(1, None)], "id int, t string")
    out = written(df, "x")
    assert out.collect() == df.collect() and out.schema == df.schema
    path = out.inputFiles()[0]
    assert spark.sparkContext.applicationId in path and own_dir(spark).removeprefix("file://") in path
