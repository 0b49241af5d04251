"""Secret scan in DataFrame functions: three pattern kinds, and character Markov models for random strings.

Two first-order Markov chains over characters are trained from labelled samples: one of random strings (keys,
digests, base-64), one of ordinary identifiers.  A candidate token is a secret if the log-likelihood ratio of the
chains, in whole thousandths of a nat, passes `MARGIN`.  The trained table has 128 x 128 entries on any corpus.

Matches are found by putting a mark around each one (`regexp_replace`), splitting at the marks and summing the
lengths of the pieces: places are code points, ends exclusive.  U+0001, the mark, is read as U+0002 in texts; no
pattern matches either.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import let

# The kinds of the contract, in their order, with patterns in Java's dialect.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

TOKEN = r"[A-Za-z0-9+/_=-]+"
MIN_TOKEN, MARGIN = 16, 10_000
TRAIN_DOCS, TRAIN_STRINGS, PRIOR = 1_000, 3_000, 0.5
SIZE = 128
EDGE = "\x02"  # stands for the start and the end of a string
MARK = "\x01"
BLOCK = 1024  # characters
CODE_MODULES = ("os", "string", "logging", "unittest", "http", "http.client", "email.message", "threading", "socket",
    "subprocess", "argparse", "datetime", "decimal", "calendar", "csv", "json", "zipfile", "tarfile",
                "urllib.request", "xml.dom.minidom", "sqlite3", "statistics", "inspect", "html.entities",
                "pyspark.sql.functions", "pyspark.sql", "pyarrow.compute", "pandas", "numpy")
CODE_TIMES = 20
EMPTY = "array<struct<s:int,k:int,e:int>>"


def before(values: Column, join, levels: int = 3) -> Column:
    """For each place of an array of ints, 0 and all values before it joined by join(a, b), which is associative.

    Values are taken in blocks of 64, the blocks' results again, so that the cost of long arrays grows with their length.
    """
    none = F.array().cast("array<int>")

    def run(a: Column) -> Column:
        step = F.aggregate(a, F.struct(F.lit(0).alias("n"), none.alias("out")), lambda s,
            x: F.struct(join(s.n, x).alias("n"), F.concat(s.out, F.array(s.n)).alias("out")))
        return step.getField("out")

    if levels == 1:
        return run(values)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / 64).cast("int")),
        lambda b: F.slice(values, b * 64 + 1, 64))
    whole = lambda a: F.aggregate(a, F.lit(0), join)
    return let(blocks, lambda bs: let(F.transform(bs, whole), lambda totals: F.flatten(
        F.zip_with(F.transform(bs, run), before(totals, join, levels - 1), lambda own,
        off: F.transform(own, lambda x: join(off, x))))))


def gaps(spans: Column, length: Column) -> Column:
    """(s, e) of what lies between spans, which are sorted by start; spans that touch or overlap leave nothing between.

    The first gap starts at 0 and the last ends at length; both may be empty.
    """
    far = let(spans, lambda xs: let(before(F.transform(xs, lambda x: x.e), lambda a, b: F.greatest(a, b)),
        lambda reach: F.filter(
        F.zip_with(xs, F.transform(reach, lambda r, i: F.struct(r.alias("r"), i.alias("i"))), lambda x,
        y: F.when((x.s > y.r) | (y.i == 0), F.struct(y.r.alias("s"), x.s.alias("e")))),
        lambda g: g.isNotNull())))
    end = F.aggregate(spans, F.lit(0), lambda a, x: F.greatest(a, x.e))
    return F.when(F.size(spans) == 0, F.array(F.struct(F.lit(0).alias("s"), length.alias("e")))).otherwise(F.concat(far,
        F.array(F.struct(end.alias("s"), length.alias("e")))))


def cut(text: Column, places: Column, then) -> Column:
    """then(piece, i, places) for each (s, e) of an array of places in text.

    The text is cut once into blocks, so that a piece costs its length and a block or two, wherever it lies.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def piece(bs: Column, g: Column) -> Column:
        a, z = F.floor(g.s / BLOCK).cast("int"), F.floor((g.e - 1) / BLOCK).cast("int")
        block = lambda k: F.get(bs, k)
        return F.when(g.s >= g.e, F.lit("")).when(a == z,
            F.substring(block(a), g.s % BLOCK + 1, g.e - g.s)).otherwise(F.concat(
            F.substring(block(a), g.s % BLOCK + 1, F.lit(BLOCK)),
            F.array_join(F.slice(bs, a + 2, F.greatest(z - a - 1, F.lit(0))), ""),
            F.substring(block(z), F.lit(1), g.e - z * BLOCK)))

    return let(blocks, lambda bs: let(places, lambda gs: F.transform(gs, lambda g, i: then(piece(bs, g), i, gs))))


def matches(text: Column, pattern: str, kind: int, good) -> Column:
    """Spans of the leftmost matches, not overlapping, whose string passes good(Column); places in text."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)

    def spans(p: Column) -> Column:
        starts = before(F.transform(p, lambda x: F.length(x)), lambda a, b: a + b)
        each = F.zip_with(p, starts, lambda x, s: F.struct(s.alias("s"), F.lit(kind).alias("k"),
            (s + F.length(x)).alias("e"), x.alias("x")))
        found = F.filter(each, lambda y, i: (i % 2 == 1) & good(y.x))
        return F.transform(found, lambda y: F.struct(y.s.alias("s"), y.k.alias("k"), y.e.alias("e")))

    return let(pieces, lambda p: F.when(F.size(p) < 2, F.array().cast(EMPTY)).otherwise(spans(p)))


def clear(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), MARK, EDGE)


def base_spans(text: Column) -> Column:
    """Spans of the three kinds in a cleared text, by start, then kind as listed.

    The dear search with marks runs only where a plain search finds something: hex digits and access keys in the
    least number that counts (a shorter run cannot hold a longer one), assignments as they are.
    """
    none = F.array().cast(EMPTY)
    assign = F.when(text.rlike(ASSIGN), matches(text, ASSIGN, 0,
        lambda x: F.length(F.regexp_extract(x, ASSIGN, 2)) >= MIN_ASSIGN)).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")),
        matches(text, ACCESS, 1, lambda x: F.length(x) >= MIN_ACCESS)).otherwise(none)
    # a run of 24 or more has a digit or letter of 0-9a-f at every place, so also 24 in a row
    hexed = F.when(text.rlike(f"[0-9a-f]{{{MIN_HEX}}}"),
        matches(text, f"[0-9a-f]{{{MIN_HEX},}}", 2, lambda x: F.length(x) >= MIN_HEX)).otherwise(none)
    return F.sort_array(F.concat(assign, access, hexed))


def random_strings(spark: SparkSession, strings: int = TRAIN_STRINGS, salt: str = "") -> DataFrame:
    """(form, string): `strings` seeded random strings of 16 to 64 characters in each of the forms that keys have."""
    i = F.col("id").cast("string")
    digest = lambda s: F.sha2(F.concat(F.lit(s + salt), i), 512)
    plain = lambda s: F.regexp_replace(F.base64(F.unhex(digest(s))), "[+/=\r\n]", "")
    n = (16 + F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(49))).cast("int")
    b64 = F.regexp_replace(F.base64(F.unhex(digest("b"))), "[=\r\n]", "")
    hexed = digest("u")
    dashed = F.concat_ws("-", *(F.substring(hexed, at, size) for at,
        size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    forms = {
        "hex": F.substring(digest("h"), F.lit(1), n), "HEX": F.upper(F.substring(digest("H"), F.lit(1), n)),
        "base64": F.substring(b64, F.lit(1), n), "url": F.translate(F.substring(b64, F.lit(9), n), "+/", "-_"),
        "letters": F.substring(plain("l"), F.lit(1), n), "lower": F.lower(F.substring(plain("w"), F.lit(1), n)),
        "base32": F.substring(F.translate(F.upper(plain("c")), "0189", "2345"), F.lit(1), n), "uuid": dashed,
    }
    made = spark.range(strings, numPartitions=4).select(F.explode(F.map_from_arrays(F.array(*map(F.lit, forms)),
        F.array(*forms.values()))).alias("form", "string"))
    return made


def joined_names(words: Column) -> Column:
    """Identifiers as code and addresses have them, made of three words in a row at every third place."""
    threes = F.filter(F.transform(words, lambda x, k: F.when(k % 3 == 0, F.slice(words, k + 1, 3))),
        lambda x: x.isNotNull())
    lower = lambda ws: F.transform(ws, lambda w: F.lower(w))
    big = lambda ws: F.transform(ws, lambda w: F.initcap(w))
    made = F.transform(threes, lambda ws, k: F.when(k % 7 == 0, F.array_join(big(ws), "")).when(k % 7 == 1,
        F.array_join(lower(ws), "_")).when(k % 7 == 2, F.upper(F.array_join(ws, "_")))
                       .when(k % 7 == 3, F.array_join(lower(ws), "-")).when(k % 7 == 4,
                       F.concat(F.lit("/"), F.array_join(lower(ws), "/"))).when(k % 7 == 5, F.array_join(lower(ws), ""))
                       .otherwise(F.concat(F.array_join(lower(ws), "_"), (k * 37 % 1000).cast("string"))))
    return made


def names_of_code() -> list[str]:
    """Words of the public names in modules of Python's library and of what it runs on: what identifiers are made of."""
    import importlib

    found = set()
    for module in CODE_MODULES:
        m = importlib.import_module(module)
        for name in dir(m):
            inner = dir(getattr(m, name)) if isinstance(getattr(m, name), type) else []
            for n in (name, *inner):
                found.update(w.lower() for w in re.findall("[A-Z]?[a-z]+", n) if len(w) > 2)
    return sorted(found)


def samples(spark: SparkSession, docs: DataFrame, rows: int = TRAIN_DOCS, strings: int = TRAIN_STRINGS) -> DataFrame:
    """(string, random): labelled samples, the same for the same documents, however they are laid out.

    random = 1: random_strings.  random = 0: the tokens of `rows` documents, those of the least hashes of doc_id,
    without what the three kinds match; words of names in code; identifiers made of both; numbers, dates and rules.
    """
    i = F.col("id")
    made = spark.range(strings, numPartitions=4)
    n = (3 + F.pmod(F.xxhash64("id"), F.lit(30))).cast("int")
    numbers = made.select(F.explode(F.array(
        F.substring(F.translate(F.sha2(F.concat(F.lit("n"), i.cast("string")), 256), "abcdef", "012345"), F.lit(1), n),
        F.concat_ws("-", (1970 + i % 80).cast("string"), F.lpad((1 + i % 12).cast("string"), 2, "0"),
        F.lpad((1 + i % 28).cast("string"), 2, "0")),
        F.repeat(F.element_at(F.array(*map(F.lit, "-=_/+")), (1 + i % 5).cast("int")), n))).alias("string"),
        F.lit(0).alias("random"))
    h = F.xxhash64(F.col("doc_id").cast("string"))
    # a range of hashes that some four times as many rows fall into, so that the ids of all rows are never shuffled
    count = docs.count()
    near = docs.where(h <= F.lit(-(2**63) + min(2**64 - 1, 4 * rows * 2**64 // max(count, 1))))
    least = near.select(h.alias("h")).distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    part = near.where(h <= F.lit(least if least is not None
        else 0)).groupBy(h.alias("h")).agg(F.min("text").alias("t"))  # one text for each id
    t = clear(F.col("t"))
    for pattern in (ASSIGN, f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}", f"[0-9a-f]{{{MIN_HEX},}}"):
        t = F.regexp_replace(t, pattern, " ")
    own = part.select(F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0)).alias("w"))
    names = F.from_json(F.lit(json.dumps(names_of_code())), "array<string>")
    shuffled = F.transform(F.array_sort(F.transform(names,
        lambda w: F.struct(F.xxhash64(w, F.col("id")).alias("h"), w.alias("w")))), lambda x: x.w)
    code = spark.range(0, CODE_TIMES if strings else 0, 1, CODE_TIMES).select(shuffled.alias("w"))
    ordinary = own.union(code).select(F.explode(F.concat("w",
        joined_names(F.col("w")))).alias("string")).where("length(string) > 2").withColumn("random", F.lit(0))
    return random_strings(spark, strings).select("string", F.lit(1).alias("random")).union(numbers).union(ordinary)


def train(labelled: DataFrame) -> list[int]:
    """Log-likelihood ratio (random over ordinary) of each pair of ASCII characters, in thousandths of a nat.

    Entry 128 * a + b belongs to b after a; character 2 stands for either end.  Without samples all are 0.
    """
    chars = F.split(F.concat(F.lit(EDGE), "string", F.lit(EDGE)), "")
    codes = labelled.where("string is not null and random is not null").select("random",
        F.filter(F.transform(chars, lambda c: F.ascii(c)), lambda x: (x > 0) & (x < SIZE)).alias("c"))
    pairs = codes.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1),
        lambda i: F.element_at("c", i) * SIZE + F.element_at("c", i + 1))).alias("pair"))
    got = pairs.groupBy("random", "pair").count().collect()  # at most 2 x 128 x 128 rows
    alphabet = sorted({r.pair // SIZE for r in got} | {r.pair % SIZE for r in got})
    seen = {(r.random, r.pair): r["count"] for r in got}
    out = [0] * (SIZE * SIZE)
    for a in alphabet:
        total = [sum(seen.get((y, a * SIZE + b), 0) for b in alphabet) + PRIOR * len(alphabet) for y in (0, 1)]
        for b in alphabet:
            p = [(seen.get((y, a * SIZE + b), 0) + PRIOR) / total[y] for y in (0, 1)]
            out[a * SIZE + b] = round(1000 * math.log(p[1] / p[0]))
    return out


def ratio(token: Column, model: list[int]) -> Column:
    """Log-likelihood ratio of a token of ASCII characters, in thousandths of a nat."""
    table = F.from_json(F.lit(str(model)), "array<int>")
    codes = F.transform(F.split(F.concat(F.lit(EDGE), token, F.lit(EDGE)), ""), lambda c: F.ascii(c))
    pairs = let(codes, lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a,
        b: a * SIZE + b + 1))
    return let(pairs, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + F.element_at(table, x)))


def markov_spans(text: Column, base: Column, model: list[int]) -> Column:
    """Spans of what the models call random among the tokens outside of the base spans, which cut tokens."""
    long_enough = f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN}}}"
    hide = lambda piece, i, gs: F.concat(piece, F.when(i + 1 < F.size(gs),
        F.repeat(F.lit(EDGE), F.get(gs, i + 1).s - F.get(gs, i).e)).otherwise(F.lit("")))
    outside = F.when(F.size(base) == 0, text).otherwise(F.array_join(cut(text, gaps(base, F.length(text)), hide), ""))
    found = let(outside, lambda t: matches(t, f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}", len(KINDS),
        lambda x: ratio(x, model) > MARGIN))
    return F.when(text.rlike(long_enough), found).otherwise(F.array().cast(EMPTY))


def scan(docs: DataFrame, model: list[int], base: str = "base_spans", every: str = "all_spans") -> DataFrame:
    """docs with two more columns (named by the caller), arrays of (s start, k kind number, e end) by start and kind.

    Kind 3 is the Markov models'.  Null and empty texts have no spans; repeated rows are scanned alike.
    """
    work = f"{every}_text"
    cleared = docs.withColumn(work, clear(F.col("text")))
    with_base = cleared.withColumn(base, base_spans(F.col(work)))
    return with_base.withColumn(every, F.sort_array(F.concat(base,
        markov_spans(F.col(work), F.col(base), model)))).drop(work)


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "markov")])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x.k + 1), x.s.cast("string"),
        x.e.cast("string"))), ",")


def secrets_report(docs: DataFrame, model: list[int] | None = None) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, all spans as kind:start:end, and the Markov count."""
    model = train(samples(docs.sparkSession, docs)) if model is None else model
    found = scan(docs.select("doc_id", "text"), model)
    count = lambda k: F.size(F.filter("all_spans", lambda x: x.k == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"), joined(F.col("all_spans")).alias("spans"),
        count(len(KINDS)).alias("n_markov"))


def redact(docs: DataFrame, model: list[int] | None = None, mask: str = "<SECRET>") -> DataFrame:
    """docs with every found span of text replaced by mask (spans that touch become one); n_chars follows the text.

    Rows and columns stay; null texts stay null.
    """
    model = train(samples(docs.sparkSession, docs)) if model is None else model
    every = next(n for n in ("secret_spans" + "_" * k for k in range(1000)) if not {n, f"{n}_base", f"{n}_text"}
        & set(docs.columns))
    found = scan(docs, model, f"{every}_base", every)

    def rebuilt(spans: Column) -> Column:
        return F.array_join(cut(F.col("text"), gaps(spans, F.length("text")), lambda piece, i, gs: piece), mask)

    text = F.when(F.size(every) > 0, rebuilt(F.col(every))).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(every) > 0,
            F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
