"""Toxicity: cumulative-link ordinal regression over sparse word features of a text's windows.

P(grade > k | x) = sigmoid(w.x - b_k) with one weight vector for all thresholds b_0 <= b_1 <= ...  The expected
severity is the sum of these probabilities over k.  A text is read in windows of `WINDOW` words, every `STRIDE` words,
the last one flush with its end; it is called toxic if P(grade > 0) passes the threshold in any.  Its w.x is the mean
over the windows that pass, or the largest if none does.  So a passage in a long text counts as it does alone, and
severity says how bad the bad passages are, not how long the text is.

x holds log(1 + rate) of words and of word beginnings of `PREFIXES` letters (insults inflect); the rate is how often
the feature comes in a window of full size, for short texts held down by `SMOOTH` words more.  Features are those
whose share of toxic and of clean labelled documents differs beyond chance, in either direction; weights are signed.

Grades.  The labels name toxic documents (0/1).  Grade 0 is a document labelled clean; a toxic one is graded 1 to 3 by
its rate of marker words, the mean over the windows that have any: below `GRADE_RATES[0]`, below `GRADE_RATES[1]`, the
rest.  Markers are words with a feature at least `MARKER_RATIO` times as frequent, by document, in toxic labelled
documents as in clean ones.  The mean x of these windows is trained on, or the first window's where none has markers.

Bounds.  The classifier is fitted on at most `TRAIN_ROWS` labelled rows, chosen by a hash of doc_id, with at most
`FEATURES` features; only the counts of these features reach the driver.  The model is as large on any corpus.
Scoring reads every word of every document.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import texts, written

TRAIN_ROWS, FEATURES, PREFIXES = 8_000, 4_000, (4, 5, 6, 7)
MIN_DOCS, MIN_SHARE, MIN_Z = 8, 0.01, 5.0
THRESHOLD = 0.3
WINDOW, STRIDE, SMOOTH = 100, 50, 25
MARKER_RATIO, GRADE_RATES = 25.0, (3.0, 4.0)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class OrdinalModel:
    """Weights by feature and increasing thresholds."""

    weights: dict[str, float]
    cuts: list[float]

    def expected(self, x: np.ndarray) -> np.ndarray:
        return self.over(x).sum(axis=1)

    def over(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and k."""
        return 1 / (1 + np.exp(np.clip(np.array(self.cuts)[None, :] - np.asarray(x, float)[:, None], -50, 50)))

    def scorer(self, threshold: float = THRESHOLD) -> Callable[[str | None], float]:
        """text -> mean w.x of the windows that pass the threshold, else the largest; what features words have is
        remembered up to a bound."""
        least = self.cuts[0] + math.log(threshold / (1 - threshold))
        known: dict[str, tuple[str, ...]] = {}
        weights = self.weights
        heads = {f.rstrip("*")[:4] for f in weights}  # all features of a word begin as it does

        def hits(words: list[str]) -> list[tuple[int, tuple[str, ...]]]:
            out = []
            for i, word in enumerate(words):
                if word[:4] in heads:
                    own = known.get(word)
                    if own is None:
                        if len(known) > 50_000:
                            known.clear()
                        own = known[word] = tuple(f for f in features(word) if f in weights)
                    if own:
                        out.append((i, own))
            return out

        def score(text: str | None) -> float:
            words = words_of(text)
            found = hits(words)
            if not found:
                return 0.0
            best, bad, n = -math.inf, 0.0, 0
            for size, own in windows(len(words), found):
                counts = Counter(f for fs in own for f in fs)
                x = sum(weights[f] * rate(c, size) for f, c in sorted(counts.items()))
                best = max(best, x)
                if x >= least:
                    bad += x
                    n += 1
            return bad / n if n else best

        return score


def windows(n: int, hits: list[tuple[int, object]]) -> Iterator[tuple[int, list]]:
    """(words, what hits hold) of each window of a text of n words; hits: (place, anything) in order."""
    if n <= WINDOW:
        yield n, [x for _, x in hits]
        return
    lo = hi = 0
    for start in (*range(0, n - WINDOW, STRIDE), n - WINDOW):
        while lo < len(hits) and hits[lo][0] < start:
            lo += 1
        while hi < len(hits) and hits[hi][0] < start + WINDOW:
            hi += 1
        yield WINDOW, [x for _, x in hits[lo:hi]]


def rate(count: int, size: int) -> float:
    """log(1 + how often in a window of full size), smoothed for short texts."""
    return math.log1p(count * (WINDOW + SMOOTH) / (size + SMOOTH))


def words_of(text: str | None) -> list[str]:
    """Lower-case words of letters; null and empty texts have none."""
    return _WORD.findall((text or "").lower())


def features(word: str) -> list[str]:
    """The word, and its beginnings marked by *."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) >= k)]


def labelled(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, text) of at most `rows` labelled documents, by hash of doc_id (all, if there are no more).

    Null labels and ids are left out; a document labelled twice has its higher label; repeated documents count once.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
        F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    own = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Train on a bounded labelled sample.  Without both classes (or rows) the model calls nothing toxic."""
    sample = written(labelled(docs, labels, rows), "labelled")
    n = {bool(r.toxic): r.n
        for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return OrdinalModel({}, [50.0])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, found = [], []
            for t, y in zip(b.column("text"), b.column("toxic").to_pylist()):
                own = {f for w in set(words_of(t.as_py())) for f in features(w)}
                found += own
                toxic += [int(y > 0)] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(toxic, pa.int32())],
                names=["f", "toxic"])

    by = sample.mapInArrow(split, "f string, toxic int").groupBy("f").agg(F.sum("toxic").alias("yes"),
        F.count(F.lit(1)).alias("all"))
    ratio = (F.col("yes") / n[True]) / ((F.col("all") - F.col("yes") + 0.5) / n[False])
    # how far the shares of toxic and of clean rows lie apart, in standard errors
    share = F.col("all") / (n[True] + n[False])
    z = (F.col("yes") / n[True] - (F.col("all") - F.col("yes")) / n[False]) / F.sqrt(share * (1 - share) * (1 / n[True] + 1 / n[False]))
    least = max(MIN_DOCS, MIN_SHARE * n[True])
    telling = (by.where((F.col("all") >= least) & (share < 1)).select("f", ratio.alias("ratio"),
        z.alias("z")).where(F.abs("z") >= MIN_Z)
               .orderBy(F.desc(F.abs("z")), "f").limit(FEATURES).collect())
    used = {r.f: i for i, r in enumerate(telling)}
    marked = {r.f for r in telling if r.ratio >= MARKER_RATIO}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column("text"):
                words = words_of(t.as_py())
                hits = [(i, own) for i, w in enumerate(words) if (own := [f for f in features(w) if f in used])]
                marks, x, n = 0.0, Counter(), 0
                for size, own in windows(len(words), hits):
                    held = sum(any(f in marked for f in fs) for fs in own)
                    if held:
                        marks += held * (WINDOW + SMOOTH) / (size + SMOOTH)
                        n += 1
                        for f, c in sorted(Counter(f for fs in own for f in fs).items()):
                            x[used[f]] += rate(c, size)
                if not n:
                    size, own = next(windows(len(words), hits))
                    n, x = 1, {used[f]: rate(c, size) for f, c in Counter(f for fs in own for f in fs).items()}
                out.append((list(x), [v / n for v in x.values()], marks / n))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("toxic").cast(pa.int32()),
                pa.array([o[0] for o in out], pa.list_(pa.int32())),
                pa.array([o[1] for o in out], pa.list_(pa.float64())), pa.array([o[2] for o in out], pa.float64())],
                names=["doc_id", "toxic", "at", "rates", "marks"],
            )

    got = sorted((r.doc_id, r.toxic, r.marks, sorted(zip(r.at, r.rates)))
        for r in sample.mapInArrow(counted,
        "doc_id long, toxic int, at array<int>, rates array<double>, marks double").collect())
    grades = np.array([0 if toxic <= 0 else 1 + sum(marks >= g for g in GRADE_RATES) for _, toxic, marks, _ in got])
    weights, cuts = train([p for *_, p in got], grades, len(used))
    names = list(used)
    return OrdinalModel({names[i]: float(weights[i]) for i in np.flatnonzero(weights)}, [float(c) for c in cuts])


def train(pairs: list[list[tuple[int, float]]], grades: np.ndarray, size: int, steps: int = 1500,
        l1: float = 5e-5) -> tuple[np.ndarray, np.ndarray]:
    """Proximal AdaGrad on the mean log-loss over all thresholds, with an L1 penalty.  pairs: (feature, value) by row."""
    levels = np.unique(grades[grades > 0])
    grades = np.searchsorted(levels, grades, side="right")  # grades that no row has need no threshold
    top = len(levels)
    rows = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
    cols = np.array([i for p in pairs for i, _ in p], np.int64)
    vals = np.array([c for p in pairs for _, c in p], float)
    over = (grades[:, None] > np.arange(top)[None, :]).astype(float)
    w, b = np.zeros(size), np.full(top, 1.0) + np.arange(top)
    gw, gb = np.full(size, 1e-8), np.full(top, 1e-8)
    for _ in range(steps):
        x = np.bincount(rows, vals * w[cols], minlength=len(pairs))
        e = (1 / (1 + np.exp(np.clip(b[None, :] - x[:, None], -50, 50))) - over) / len(pairs)
        g = np.bincount(cols, vals * e.sum(axis=1)[rows], minlength=size)
        h = -e.sum(axis=0)
        gw += g * g
        gb += h * h
        step = 0.3 / np.sqrt(gw)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b = np.maximum.accumulate(b - 0.3 / np.sqrt(gb) * h)
    return w, b


def score(docs: DataFrame, model: OrdinalModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, expected_severity, severity (the grade passed with probability over one half), toxic; for every row.

    Null or empty text has the severity of a text without words.  Equal texts score alike; empty input: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, m = shared.value.scorer(threshold), shared.value
        for b in batches:
            over = m.over(np.array([of(t.as_py()) for t in b.column(1)], float))
            cols = [b.column(0), pa.array(over.sum(axis=1)), pa.array((over > 0.5).sum(axis=1), pa.int32()),
                pa.array(over[:, 0] >= threshold)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "expected_severity", "severity", "toxic"])

    return texts(docs).mapInArrow(run, "doc_id long, expected_severity double, severity int, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on labelled documents, score all."""
    return score(docs, fit(docs, labels, rows), threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that the model calls toxic; columns as they came, rows as often as they came."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of, m = shared.value.scorer(threshold), shared.value
        for s in texts:
            yield pd.Series(m.over(np.array([of(t) for t in s], float))[:, 0] < threshold, dtype=bool)

    return docs.where(clean("text"))
