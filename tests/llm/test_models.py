"""Toxicity and quality: held-out accuracy, edge rows; LM scores: exact base scores
against brute force, the filter, edge rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tidemark.llm import lm, quality, toxicity
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def crc(d, k):
    return zlib.crc32(("null" if d is None else str(d)).encode()) % k


def auc(s, y):
    s, y = np.array(s), np.array(y)
    a, b = s[y == 1], s[y == 0]
    return ((a[:, None] > b).mean() + 0.5 * (a[:, None] == b).mean())


@pytest.mark.parametrize("name,label,k,r,least", [("op3_toxicity", "toxic", 4, 2, 0.9), ("op6_quality", "quality", 3, 1, 0.9)])
def test_held_out(spark, name, label, k, r, least):
    got = {x.doc_id: x for x in QUERIES[name](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(x.held_out == (crc(d, k) == r) and 0 <= x.score <= 1 for d, x in got.items())
    assert all(x.predicted == int(x.score >= (0.3 if label == "toxic" else 0.5)) for x in got.values())
    rows = [(got[x.doc_id].score, x[label]) for x in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[x.doc_id].held_out]
    assert auc(*zip(*rows)) >= least


@pytest.mark.parametrize("fn", [toxicity.score, quality.score])
def test_classifier_edges(spark, fn):
    docs = spark.createDataFrame([(i, f"word{i % 9} " * (i + 1) + ("BAD!! " * 9 if i % 3 == 0 else "fine."), 1, "x") for i in range(60)]
                                 + [(100, None, 1, "x"), (101, "", 1, "x"), (None, "a b", 1, "x"), (5, "again", 1, "x"), (102, "z" * 60000, 1, "x")],
                                 "doc_id long, text string, y int, held_out string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (7, None, None), (8, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = fn(docs, labels)
    assert got.count() == 65 and got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert fn(docs.limit(0), labels).count() == 0
    assert {r.score for r in fn(docs, labels.limit(0)).collect()} in ({0.0}, {0.5})


def base_scores(rows):
    toks = [((t or "").encode().lower().split(), d) for d, t in rows]
    c = Counter()
    for w, d in toks:
        if crc(d, 5) != 1:
            c.update(w)
            c["END"] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for w, d in toks:
        w = [*w, "END"]
        out.append((d, crc(d, 5) == 1, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in w), 6)))
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_lm_base_is_exact(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_lm_scoring"](spark, SMALL).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=key) == sorted(base_scores(rows), key=key)
    assert all(r.score < 0 for r in got)
    train = [r for r in got if not r.held_out]
    assert sum(r.score for r in train) > sum(r.base_score for r in train)


def test_lm_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a B c"), (4, "A b"), (4, "A b"), (5, "x " * 5000), (6, "é \x85 É"), (11, "unseen words")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, held int, chunk string")
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm.score(df).collect()]
    assert sorted(got, key=key) == sorted(base_scores(rows), key=key)
    assert lm.score(df.limit(0)).count() == 0
    held = [r for r in rows if crc(r[0], 5) == 1] or [(11, "q")]
    one = spark.createDataFrame([(11, "q w")] if crc(11, 5) == 1 else held, "doc_id long, text string")
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in lm.score(one).collect())


def test_filter_counts():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 20000).astype(np.uint64)
    q = rng.integers(1, 9, 20000)
    f = lm.Bits.build(keys, q, 0.01)
    got = f.level(keys)
    assert (got >= q).all() and (got == q).mean() > 0.98
    assert (f.level(rng.integers(0, 2**63, 20000).astype(np.uint64)) > 0).mean() < 0.02
    assert f.size <= 10 * q.sum() and f.hashes == 7
