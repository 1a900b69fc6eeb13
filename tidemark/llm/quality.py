"""Quality: regularised quadratic discriminant over transformed text statistics.

Each class is a normal density whose covariance is shrunk towards the pooled one and
its diagonal; a document's score is the difference of the Mahalanobis log-densities
(by the classes' cached Cholesky factors) passed through a logistic fit. Means and
covariances are grouped sums over all labelled training rows; the texts are read once.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _SPACE, ascii_words, col, fold, stage
from .toxicity import logistic

NAMES = ("words", "word_bytes", "word_spread", "distinct", "top_word", "entropy", "repeated_next", "upper", "digits", "symbols",
         "sentence_marks", "exclamations", "lines", "line_words", "repeated_lines", "ends_in_mark", "high_bytes")
_KIND = np.zeros(256, np.int64)         # 0 other ASCII letters and controls
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[*range(35, 39), *range(42, 44), 47, *range(60, 63), 64, *range(91, 97), *range(123, 127)]] = 3
_KIND[[44, 46, 58, 59, 63]] = 4
_KIND[33] = 5
_KIND[128:] = 6
_KIND[_SPACE] = 7


def _share(k: float, n: float) -> float:
    """Log-odds of a share, kept finite."""
    return math.log((k + 0.5) / (max(n - k, 0) + 0.5)) / 4


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; a text without words has those of
    zero counts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = ascii_words(text)
    n, b = len(words), len(raw)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8) if b else np.zeros(8)
    ink = b - kinds[7]
    count = Counter(words)
    sizes = np.fromiter(map(len, words), float, n)
    freq = np.fromiter(count.values(), float, len(count))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(w[-1] in b".,;:!?" for w in words)
    return [
        math.log1p(n), math.log1p(sizes.mean()) if n else 0.0, math.log1p(sizes.std()) if n else 0.0,
        _share(len(count), n), _share(freq.max() if n else 0, n),
        float(-(freq / n * np.log(freq / n)).sum() / math.log(n + 1)) if n else 0.0,
        _share(sum(x == y for x, y in zip(words, words[1:])), n), _share(kinds[1], ink), _share(kinds[2], ink), _share(kinds[3], ink),
        _share(kinds[4], ink), _share(kinds[5], ink), math.log1p(len(lines)), math.log1p(n / max(1, len(lines))),
        _share(len(lines) - len(set(lines)), len(lines)), _share(ends, n), _share(kinds[6], ink),
    ]


@dataclass
class Model:
    means: np.ndarray       # (2, d)
    factors: list           # Cholesky factors of the precision side: inverses of those of the covariances
    offsets: np.ndarray     # minus half the log-determinants
    weights: np.ndarray     # logistic: difference of log-densities, intercept

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log-density of class 1 minus that of class 0, signed square root of large values."""
        d = [o - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, o in zip(self.means, self.factors, self.offsets)]
        return np.arcsinh(d[1] - d[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.difference(x) * self.weights[0] + self.weights[1], -30, 30)))


def _moments(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """(n, sum, sum of outer products) by class, over all rows, in one grouped sum."""
    d = len(NAMES)
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    prods = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    out = {}
    for r in rows.groupBy("y").agg(F.count("*").alias("n"), *sums, *prods).collect():
        p = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[r.y] = (r.n, np.array([r[f"s{i}"] for i in range(d)]), p)
    return out


def _gauss(moments: dict, shrink: float) -> Model:
    d = len(NAMES)
    means = np.array([moments[y][1] / moments[y][0] for y in (0, 1)])
    covs = [moments[y][2] / moments[y][0] - np.outer(means[y], means[y]) for y in (0, 1)]
    n = [moments[y][0] for y in (0, 1)]
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / sum(n)
    target = 0.5 * pooled + 0.5 * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
    factors, offsets = [], []
    for y in (0, 1):
        a = max(shrink, d / (d + n[y]))     # few rows: more of the common target
        c = np.linalg.cholesky((1 - a) * covs[y] + a * target)
        factors.append(np.linalg.inv(c))
        offsets.append(-np.log(np.diag(c)).sum())
    return Model(means, factors, np.array(offsets), np.array([1.0, 0.0]))


def fit(rows: DataFrame, shrinkages=(0.02, 0.1, 0.3), max_rows: int = 50_000) -> Model | None:
    """``rows``: x, y, h. Shrinkage and logistic fit come from densities of four fifths
    of the rows seen on at most ``max_rows`` of the other fifth; the final densities use all."""
    part = F.pmod(F.col("h"), F.lit(5)) == 0
    most = _moments(rows.where(~part))
    if set(most) != {0, 1}:
        return None
    held = rows.where(part).orderBy("h").limit(max_rows).select("x", "y").toPandas()
    best = (np.inf, shrinkages[0], np.array([1.0, 0.0]))
    if held["y"].nunique() == 2:
        x, y = np.array(held["x"].tolist()), held["y"].to_numpy(float)
        for s in shrinkages:
            diff = _gauss(most, s).difference(x)
            w = logistic(diff[:, None], y)
            p = np.clip(1 / (1 + np.exp(-np.clip(diff * w[0] + w[1], -30, 30))), 1e-9, 1 - 1e-9)
            loss = float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
            if loss < best[0]:
                best = (loss, s, w)
    model = _gauss(_moments(rows), best[1])
    model.weights = best[2]
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 3, held_fold: int = 1, threshold: float = 0.5) -> DataFrame:
    """One row per document row: id, held_out, score (0 to 1), predicted.

    Labels are learnt from rows whose fold is not ``held_fold``; a NULL label or
    conflicting labels of an id teach nothing. NULL text counts as empty and has the
    statistics of zero counts; NULL and repeated ids give a row each; other columns are
    ignored; an empty table gives an empty result; if a class has no labels every score
    is 0.5."""
    src = docs.select(col(id_col).alias("id"), (fold(id_col, folds) == held_fold).alias("held_out"), col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in b.column(2).to_pylist()], float)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["id", "held_out", "x"])

    kind = src.schema["id"].dataType.simpleString()
    seen = stage(src.mapInArrow(run, f"id {kind}, held_out boolean, x array<double>"), "quality")
    y = labels.where(col(label_col).isin(0, 1)).groupBy(col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y1"))
    rows = seen.where("not held_out").join(y.where("y = y1").select("id", F.col("y").cast("int").alias("y")), "id")
    rows = stage(rows.select("x", "y", F.xxhash64("id", "x").alias("h")), "labelled")
    model = fit(rows)
    if model is None:
        out = seen.select("id", "held_out", F.lit(0.5).alias("score"))
    else:
        m = docs.sparkSession.sparkContext.broadcast(model)

        def scores(batches):
            for b in batches:
                x = np.array(b.column(2).to_pylist(), float).reshape(-1, len(NAMES))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(m.value.score(x))], names=["id", "held_out", "score"])

        out = seen.mapInArrow(scores, f"id {kind}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
