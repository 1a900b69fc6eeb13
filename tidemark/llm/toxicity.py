"""Toxicity: class-conditional Kneser-Ney models of word spelling.

Words are read as bytes between word bounds. Each class has its own interpolated
Kneser-Ney counts for the long contexts (orders ``SHARED + 1`` to ``ORDER``); the
short ones are continuation counts shared by both classes, so an expression that
neither class has seen much of backs off to the same counts and says nothing. A text's
evidence is the log-likelihood difference (toxic minus ordinary), normalised by its
length, and that of its most telling word; a logistic fit on documents scored by models
that have not seen them turns it into a probability.

The classes' n-gram counts are grouped sums over a bounded sample of labelled
rows; what reaches the driver and the workers are byte n-grams of that sample.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_words, col, fold, stage, unstage

ORDER, SHARED, DISCOUNT = 5, 2, 0.75
_MEMO = 300_000


def spelled(word: bytes) -> bytes:
    return b"\x01" + word + b"\x02"


def grams(words: Counter) -> Counter:
    """Byte n-grams of order ORDER (shorter at a word's start) with their counts."""
    out: Counter = Counter()
    for w, n in words.items():
        t = spelled(w)
        for i in range(1, len(t)):
            out[t[max(0, i - ORDER + 1):i + 1]] += n
    return out


def _shorter(counts: dict, order: int) -> Counter:
    """Continuation counts of the next lower order: in how many ways a gram is extended
    to the left; at a word's start there is none, so the counts themselves."""
    out: Counter = Counter()
    for g, n in counts.items():
        out[g[-(order - 1):] if order > 1 else b""] += n if g[0] == 1 and len(g) < order else 1
    return out


class _Level:
    def __init__(self, counts: dict):
        self.counts, self.total, self.kinds = counts, Counter(), Counter()
        for g, n in counts.items():
            self.total[g[:-1]] += n
            self.kinds[g[:-1]] += 1

    def mixed(self, context: bytes, byte: bytes, lower: float) -> float:
        n = self.total.get(context, 0)
        if not n:
            return lower
        return (max(self.counts.get(context + byte, 0) - DISCOUNT, 0) + DISCOUNT * self.kinds[context] * lower) / n


class Model:
    """Built from the two classes' gram counts (ordinary, toxic)."""

    def __init__(self, classes: tuple[dict, dict]):
        self.own, ends = ([], []), []
        for levels, counts in zip(self.own, classes):
            for order in range(ORDER, SHARED, -1):
                levels.insert(0, _Level(counts))
                counts = _shorter(counts, order)
            ends.append(Counter(counts))
        counts, self.shared = ends[0] + ends[1], []
        for order in range(SHARED, 0, -1):
            self.shared.insert(0, _Level(counts))
            counts = _shorter(counts, order)
        self.reset()

    def reset(self):
        self.steps: dict[bytes, float] = {}
        self.known: dict[bytes, float] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("steps", "known")}

    def __setstate__(self, d):
        self.__dict__.update(d)
        self.reset()

    def step(self, gram: bytes) -> float:
        """log P(last byte | those before) under toxic minus under ordinary."""
        got = self.steps.get(gram)
        if got is None:
            last, before = gram[-1:], gram[:-1]
            p = 1 / 256
            for order, level in enumerate(self.shared, 1):
                p = level.mixed(before[len(before) - order + 1:] if order <= len(before) + 1 else before, last, p)
            both = [p, p]
            for c in (0, 1):
                for order, level in enumerate(self.own[c], SHARED + 1):
                    both[c] = level.mixed(before[max(0, len(before) - order + 1):], last, both[c])
            got = self.steps[gram] = math.log(both[1] / both[0])
        return got

    def word(self, w: bytes) -> float:
        got = self.known.get(w)
        if got is None:
            if len(self.known) > _MEMO:
                self.known.clear()
            if len(self.steps) > 4 * _MEMO:
                self.steps.clear()
            t = spelled(w)
            got = self.known[w] = sum(self.step(t[max(0, i - ORDER + 1):i + 1]) for i in range(1, len(t)))
        return got

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """(mean difference per word, that of the most toxic word, log(1 + words)); zeros for no words."""
        words = ascii_words(text)
        if not words:
            return 0.0, 0.0, 0.0
        x = np.fromiter(map(self.word, words), float, len(words))
        return float(x.mean()), float(x.max()), math.log1p(len(words))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; columns standardised; returns
    weights on the raw columns, then the intercept."""
    mu, sd = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - mu) / sd, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    pen = np.diag([ridge * len(x) / 100] * x.shape[1] + [1e-9])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + pen, z.T @ (y - p) - pen @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / sd, w[-1] - (w[:-1] * mu / sd).sum())


def _sample(rows: DataFrame, max_docs: int, max_chars: int) -> DataFrame:
    """Per class the first documents by hash of id and text, until either bound."""
    parts = []
    for y in (0, 1):
        one = rows.where(F.col("y") == y).orderBy("h", "text").limit(max_docs)
        run = Window.orderBy("h", "text").rowsBetween(Window.unboundedPreceding, -1)
        parts.append(one.withColumn("before", F.coalesce(F.sum(F.length("text")).over(run), F.lit(0)))
                     .where(F.col("before") < max_chars).drop("before"))
    return parts[0].union(parts[1])


def _count(sample: DataFrame) -> dict[tuple[int, int], Counter]:
    """Gram counts by (class, half)."""
    def run(batches):
        seen: dict = {}
        for b in batches:
            for y, half, text in zip(*(b.column(c).to_pylist() for c in ("y", "half", "text"))):
                seen.setdefault((y, half), Counter()).update(ascii_words(text))
        for (y, half), words in seen.items():
            g = grams(words)
            yield pa.RecordBatch.from_pydict({"y": pa.array([y] * len(g), pa.int32()), "half": pa.array([half] * len(g), pa.int32()),
                                              "g": pa.array(list(g), pa.binary()), "n": pa.array(list(g.values()), pa.int64())})
    out: dict = {(y, h): Counter() for y in (0, 1) for h in (0, 1)}
    t = sample.select("y", "half", "text").mapInArrow(run, "y int, half int, g binary, n long").groupBy("y", "half", "g").agg(F.sum("n").alias("n")).toArrow()
    for y, h, g, n in zip(*(t.column(c).to_pylist() for c in ("y", "half", "g", "n"))):
        out[y, h][g] = n
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        learn=lambda id_col: F.lit(True), max_docs: int = 4_000,
        max_chars: int = 20_000_000) -> tuple[Model, np.ndarray] | None:
    """Model and logistic weights, or None if a class has no labelled text. At most
    ``max_docs`` documents and about ``max_chars`` characters of each class are used, of ids
    for which the column ``learn(name)`` is true; documents of conflicting labels or with a NULL label are not."""
    y = labels.where(col(label_col).isin(0, 1)).groupBy(col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y1"))
    y = stage(y.where((F.col("y") == F.col("y1")) & learn("id")).select("id", F.col("y").cast("int").alias("y")), "labels")
    # the documents are chosen by their labels alone, so that texts need not be shuffled to
    # meet them: at most 2 * max_docs ids are broadcast
    ids = [y.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(max_docs) for c in (0, 1)]
    rows = (docs.select(col(id_col).alias("id"), col(text_col).alias("text")).where("text is not null")
            .join(F.broadcast(ids[0].union(ids[1])), "id").withColumn("h", F.xxhash64("id", "text")))
    sample = stage(_sample(rows, max_docs, max_chars).withColumn("half", F.pmod(F.shiftright("h", 7), F.lit(2)).cast("int")), "toxic")
    counts = _count(sample)
    prior = {r.y: r["count"] for r in y.groupBy("y").count().collect()}
    if any(not counts[k] for k in counts):
        unstage(sample)
        return None
    halves = docs.sparkSession.sparkContext.broadcast([Model((counts[0, 1 - h], counts[1, 1 - h])) for h in (0, 1)])

    def run(batches):
        for b in batches:
            got = [halves.value[h].evidence(t) for h, t in zip(b.column("half").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("y"), *(pa.array(c, pa.float64()) for c in zip(*got))], names=["y", "a", "b", "c"]) \
                if got else pa.RecordBatch.from_pydict({k: pa.array([], t) for k, t in zip("yabc", [pa.int32()] + [pa.float64()] * 3)})

    t = sample.select("y", "half", "text").mapInArrow(run, "y int, a double, b double, c double").toPandas()
    unstage(sample)
    w = logistic(t[["a", "b", "c"]].to_numpy(float), t["y"].to_numpy(float))
    # the sample is balanced; the labelled rows are not
    used = t["y"].value_counts()
    w[-1] += math.log(prior[1] / prior[0]) - math.log(used[1] / used[0])
    return Model((counts[0, 0] + counts[0, 1], counts[1, 0] + counts[1, 1])), w


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4,
          held_fold: int = 2, threshold: float = 0.3, **fit_options) -> DataFrame:
    """One row per document row: id, held_out, score (0 to 1), predicted.

    Labels are learnt from rows whose fold is not ``held_fold``. NULL and empty texts get
    the score of no evidence; repeated and NULL ids give a row each; other columns
    are ignored; an empty table gives an empty result; if one class has no labels
    every score is 0."""
    got = fit(docs, labels, id_col, text_col, learn=lambda c: fold(c, folds) != held_fold, **fit_options)
    src = docs.select(col(id_col).alias("id"), (fold(id_col, folds) == held_fold).alias("held_out"), col(text_col).alias("text"))
    if got is None:
        out = src.withColumn("score", F.lit(0.0))
    else:
        model = docs.sparkSession.sparkContext.broadcast(got)

        def run(batches):
            m, w = model.value
            for b in batches:
                x = np.array([m.evidence(t) for t in b.column(2).to_pylist()], float).reshape(-1, 3)
                s = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s)], names=["id", "held_out", "score"])

        out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
