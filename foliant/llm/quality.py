"""Quality rules as a short-circuit cascade, all in DataFrame functions.

`order` estimates each rule's cost (seconds over a sample, net of a rule that does nothing, the least of some warmed
runs) and selectivity (the share that it rejects of what the rules before it left), takes the rule with the most
rejections per second first, then goes on with the rows that are left.  `verdict` evaluates the rules in this order as
one CASE: a document that a rule rejects is not looked at by the later ones.  The order changes what is computed, never
which documents are kept.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import free, let, words, written

SAMPLE_ROWS, RUNS, SAMPLE_PARTS = 2_000, 2, 4
MIN_WORDS, MAX_REPEAT_PERCENT, MAX_DUP_LINE_PERCENT, MAX_SYMBOL_PERCENT = 50, 50, 50, 50
MAX_MARK_PERCENT, MAX_TOP_WORD_PERCENT, MAX_OPEN_LINE_PERCENT, MAX_BULLET_PERCENT = 50, 60, 50, 90
MEAN_WORD = (2, 25)
SYMBOLS = "[#*$%&|<>]"
MARKS = r"[\x21-\x40\x5B-\x60\x7B-\x7E]"  # ASCII digits, punctuation and symbols
OPEN_LINE, BULLET = r"(?:\.\.\.|…)[\x20\x09-\x0D]*\z", r"^[\x20\x09-\x0D]*(?:[-*•‣◦])[\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """rejects: a Boolean Column on the text's column; true rejects the document (null does not)."""

    name: str
    rejects: Column


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_repeat_words(ws: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the array of words.

    Windows are hashed; only texts with a repeated hash are looked at further.  The places of repeated windows are
    found by lookup where up to 32 hashes repeat, else by sorting (hash, place); the words that they cover, in order
    of place, are summed by min(3, gap).
    """

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))

    def shifted(a: Column, start: int) -> Column:
        return F.slice(a, start, F.greatest(F.size(a) - 1, F.lit(0)))

    def twice(h: Column) -> Column:
        return let(F.sort_array(h), lambda s: F.array_distinct(F.filter(F.zip_with(shifted(s, 1), shifted(s, 2),
            lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())))

    def few(h: Column, dup: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(dup, x), i)), lambda x: x.isNotNull())

    def many(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        same = let(pairs, lambda p: F.zip_with(shifted(p, 1), shifted(p, 2), lambda a,
            b: F.when(a.h == b.h, F.array(a.at, b.at))))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))

    def places(h: Column) -> Column:
        return let(twice(h), lambda dup: F.when(F.size(dup) <= 32, few(h, dup)).otherwise(many(h)))

    def covered(at: Column) -> Column:
        return F.aggregate(F.zip_with(shifted(at, 1), shifted(at, 2), lambda a, b: F.least(F.lit(3), b - a)), F.lit(3),
            lambda s, x: s + x)

    counted = let(ws, lambda w: F.when(F.size(w) < 4,
        F.lit(0)).otherwise(let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h),
        F.lit(0)).otherwise(let(places(h), covered)))))
    return counted.cast("long")


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def n_marks(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(MARKS)).cast("long")


def n_lines_like(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: x.rlike(pattern))).cast("long")


def n_top_word(ws: Column) -> Column:
    """How often the most frequent word comes; 0 without words.  Runs of equal words are counted in the sorted array."""
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("run"), F.lit(0).alias("top"))

    def step(s: Column, w: Column) -> Column:
        run = F.when(s.w == w, s.run + 1).otherwise(F.lit(1))
        return F.struct(w.alias("w"), run.alias("run"), F.greatest(s.top, run).alias("top"))

    return F.aggregate(F.sort_array(ws), start, step, lambda s: s.top).cast("long")


MEASURES = ("words", "lines", "n_lines", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with the base measures (MEASURES), and the beginning of these columns' names, which no column of docs has.

    Null and empty texts have no words, lines or symbols.
    """
    t = F.col("text")
    own = "quality_"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    out = docs.withColumns({f"{own}words": words(t), f"{own}lines": lines_with_words(t)})
    ws, ls = F.col(f"{own}words"), F.col(f"{own}lines")
    return out.withColumns({
        f"{own}n_lines": F.size(ls).cast("long"), f"{own}n_words": F.size(ws).cast("long"),
        f"{own}word_chars": word_chars(ws), f"{own}n_symbols": n_symbols(t),
        f"{own}n_dup_lines": (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
        f"{own}n_repeat_words": n_repeat_words(ws),
    }), own


def base_rules(own: str | None = None, ws: Column | None = None) -> list[Rule]:
    """The two rules that the base measures decide; see further_rules."""
    if own:
        n, repeated = F.col(f"{own}n_words"), F.col(f"{own}n_repeat_words")
        return [Rule("few_words", n < MIN_WORDS), Rule("repeated_words", 100 * repeated > MAX_REPEAT_PERCENT * n)]
    with_words = lambda body: body(ws) if ws is not None else let(words(F.col("text")), body)
    return [Rule("few_words", with_words(lambda w: F.size(w) < MIN_WORDS)),
        Rule("repeated_words", with_words(lambda w: 100 * n_repeat_words(w) > MAX_REPEAT_PERCENT * F.size(w)))]


def further_rules(own: str | None = None, ws: Column | None = None) -> list[Rule]:
    """The other standard rules, in whole numbers, so that SQL gives the same.

    Each stands alone on the column text, or takes its words (ws) where these are at hand, or reads what `measured` has
    (own: the beginning of its names).  Marks, the most frequent word, open lines and bullets are work of their own, done only for rows that come to them.
    """
    t = F.col("text")
    m = lambda name, alone: F.col(f"{own}{name}") if own else alone
    with_words = lambda body: body(F.col(f"{own}words")) if own else body(ws) if ws is not None else let(words(t),
        body)
    with_lines = lambda body: body(F.col(f"{own}lines")) if own else let(lines_with_words(t), body)
    chars = lambda w: m("word_chars", word_chars(w))
    return [
        Rule("symbols", with_words(lambda w: 100 * m("n_symbols", n_symbols(t)) > MAX_SYMBOL_PERCENT * F.size(w))),
        Rule("repeated_lines", with_lines(lambda ls: 100 * m("n_dup_lines",
        F.size(ls) - F.size(F.array_distinct(ls))) > MAX_DUP_LINE_PERCENT * F.size(ls))),
        Rule("word_length", with_words(lambda w: (chars(w) < MEAN_WORD[0] * F.size(w))
        | (chars(w) > MEAN_WORD[1] * F.size(w)))),
        Rule("marks", with_words(lambda w: 100 * n_marks(t) > MAX_MARK_PERCENT * chars(w))),
        Rule("top_word", with_words(lambda w: 100 * n_top_word(w) > MAX_TOP_WORD_PERCENT * F.size(w))),
        Rule("open_lines", with_lines(lambda ls: 100 * n_lines_like(ls,
        OPEN_LINE) > MAX_OPEN_LINE_PERCENT * F.size(ls))),
        Rule("bullets", with_lines(lambda ls: 100 * n_lines_like(ls, BULLET) > MAX_BULLET_PERCENT * F.size(ls))),
    ]


def rules(ws: Column | None = None) -> list[Rule]:
    """All standard rules, each on the column text, or with its words at hand."""
    return base_rules(ws=ws) + further_rules(ws=ws)


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About `rows` documents from all partitions, in few files; its size doesn't grow with the table."""
    n = docs.count()
    part = docs.sample(min(1.0, rows / n) if n else 1.0, seed=17)
    return written(part.repartition(SAMPLE_PARTS), "quality-sample")  # else every partition of a large table would leave a file


def costs(part: DataFrame, given: list[Rule], runs: int = RUNS) -> list[float]:
    """Seconds of each rule over part beyond those of a rule that reads all columns and decides nothing."""
    read = [F.count(c) for c in part.columns]

    def took(rejects: Column) -> float:
        best = float("inf")
        for k in range(runs + 1):
            began = time.perf_counter()
            part.agg(F.sum(rejects.cast("int")), *read).collect()
            if k:  # the first one warms
                best = min(best, time.perf_counter() - began)
        return best

    empty = took(F.lit(False))
    return [max(took(r.rejects) - empty, 1e-4) for r in given]


def order(part: DataFrame, given: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected of what is left) in the order of evaluation; part is a bounded sample."""
    if not given:
        return []
    hits = F.array(*[F.coalesce(r.rejects, F.lit(False)) for r in given])
    left = {tuple(r.hits): r.n
        for r in part.groupBy(hits.alias("hits")).agg(F.count(F.lit(1)).alias("n")).collect()}  # no more than the sample's rows
    seconds, out, open_ = costs(part, given), [], list(range(len(given)))
    while open_:
        total = sum(left.values())
        share = {i: sum(n for h, n in left.items() if h[i]) / total if total else 0.0 for i in open_}
        best = min(open_, key=lambda i: (-share[i] / seconds[i], seconds[i], given[i].name))
        out.append((given[best], seconds[best], share[best]))
        left = {h: n for h, n in left.items() if not h[best]}
        open_.remove(best)
    return out


def verdict(ordered: list[Rule]) -> Column:
    """Name of the first rule, in this order, that rejects the row; null if it is kept.  Later rules aren't computed."""
    out = F
    for r in ordered:
        out = out.when(F.coalesce(r.rejects, F.lit(False)), F.lit(r.name))
    return out if ordered else F.lit(None).cast("string")


def cascade(docs: DataFrame, given: list[Rule] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with one more column, rejected_by (null: kept), or rejected_by_ and so on where docs have that.

    Null and empty texts fall to the rule on few words.
    """
    found = [r for r, *_ in order(sample(docs, rows), rules() if given is None else given)]
    return docs.withColumn(free("rejected_by", docs.columns), verdict(found))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that no rule rejects, columns as they came.

    A text is cut into words once, for the sample as for the rules' CASE.
    """
    part = written(sample(docs.select("text")).withColumn("words", words(F.col("text"))), "quality-words")
    found = [r.name for r, *_ in order(part, rules(F.col("words")))]

    def rejected(ws: Column) -> Column:
        by_name = {r.name: r for r in rules(ws)}
        return verdict([by_name[n] for n in found])

    return docs.where(let(words(F.col("text")), rejected).isNull())


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept (false if base_failed, else the cascade's verdict) for every row.

    The measures are asked for, so they are computed for every row; the further rules only where the base rules pass.
    """
    table, own = measured(docs.select("doc_id", "text"))
    base, further = base_rules(own), further_rules(own)
    part = sample(docs.select("text"))
    passed = ~(base[0].rejects | base[1].rejects)
    found = [r for r, *_ in order(written(measured(part)[0].where(passed), "quality-sample"), further)]
    out = table.withColumn(f"{own}by", verdict(base + found))
    return out.select(
        "doc_id", *[F.col(own + c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words")],
        F.coalesce(F.col(f"{own}by").isin(*(r.name for r in base)), F.lit(False)).alias("base_failed"),
        F.col(f"{own}by").isNull().alias("kept"))


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
f AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM g),
p AS (SELECT r, least(3, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -9)) AS k FROM f WHERE c > 1),
n AS (SELECT r, sum(k) AS n_repeat_words FROM p GROUP BY r),
v AS (SELECT r, max(c) AS n_top_word FROM (SELECT r, word, count(*) AS c FROM (SELECT r, unnest(ws) AS word FROM w) GROUP BY r, word) GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(t) - length(regexp_replace(t, '[\x21-\x40\x5B-\x60\x7B-\x7E]', '', 'g')) AS n_marks,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             len(list_filter(ls, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\x09-\x0D]*\z'))) AS n_open_lines,
             len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*(?:[-*•‣◦])[\x20\x09-\x0D]'))) AS n_bullets,
             coalesce(n_top_word, 0) AS n_top_word,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN n USING (r) LEFT JOIN v USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 50 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 100 * n_marks > 50 * word_chars OR 100 * n_top_word > 60 * n_words
            OR 100 * n_open_lines > 50 * n_lines OR 100 * n_bullets > 90 * n_lines) AS kept FROM m
"""
