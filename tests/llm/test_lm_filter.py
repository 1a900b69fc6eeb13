"""The language model's filter in one and many parts, broadcast and probed by shuffle;
scores against a plain model of exact quantised counts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lm


def texts(spark, n=1200, words=60):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 40000, words))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def lm_fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.mark.parametrize("entries", [1, 1000, 300_000])
def test_filter_grows_with_its_entries(entries):
    f = lm.Bits.build(np.arange(entries, dtype=np.uint64), np.ones(entries, np.int64), 0.01)
    assert f.size >= 10 * entries and f.hashes == 7 and f.top == 1


@pytest.mark.parametrize("rate", [0.001, 0.01, 0.1])
def test_false_rate(rate):
    rng = np.random.default_rng(1)
    held = rng.integers(0, 2**63, 200_000).astype(np.uint64)
    f = lm.Bits.build(held, 1 + np.arange(len(held)) % 2, rate)
    assert (f.level(held) >= 1 + np.arange(len(held)) % 2).all()
    absent = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    assert (f.level(absent) > 0).mean() < 1.3 * rate
    assert f.level(absent).max() <= 2


def test_probe_by_shuffle_equals_broadcast(spark):
    docs = texts(spark)
    key = lambda r: r.doc_id
    small = sorted(lm.score(docs, bucket_keys=20_000).collect(), key=key)
    large = sorted(lm.score(docs, broadcast_bits=0, bucket_keys=20_000).collect(), key=key)
    assert len(large) == 1200 and small == large
    whole = sorted(lm.score(docs, broadcast_bits=0, false_rate=1e-9).collect(), key=key)
    parts = sorted(lm.score(docs, broadcast_bits=0, false_rate=1e-9, bucket_keys=3000).collect(), key=key)
    assert whole == parts
    assert lm.score(docs.limit(0), broadcast_bits=0).count() == 0


def test_answers_come_from_all_buckets(spark):
    chunks = lm.chunk_documents(texts(spark, 900), "doc_id", "text", 5, 1)
    got = lm.answers(chunks, 7, 0.01, True).collect()
    n = chunks.count()
    assert {(r.asker is None, r.bucket) for r in got} == {(x, b) for x in (True, False) for b in range(7)}
    assert len([r for r in got if r.asker is not None]) == 7 * n > 7


def model(rows, weight=0.4):
    """{id: log10 probability} with exact levels."""
    toks = [(i, [*(t or "").lower().split(), "END"]) for i, t in rows]
    train = [w for i, w in toks if lm_fold(i) != 1]
    one, two = Counter(x for w in train for x in w), Counter(p for w in train for p in zip([None, *w], w))
    level = lambda c: c.bit_length()
    middle = lambda x: 0 if not one[x] else one[x] if x == "END" else (2 ** (level(one[x]) - 1) + 2 ** level(one[x]) - 1) / 2
    mass, v = sum(map(middle, one)), len(one)
    out = {}
    for i, w in toks:
        total = 0
        for a, b in zip([None, *w], w):
            p, context = (middle(b) + 0.5) / (mass + 0.5 * (v + 1)), len(train) if a is None else one[a]
            if context:
                pair = two[a, b]
                p = weight * (2 ** (level(pair) - 1) / context if pair else 0) + (1 - weight) * p
            total += math.log10(p)
        out[i] = total
    return out


@pytest.mark.parametrize("bits", [0, 1 << 40])
def test_scores_against_plain_model(spark, bits):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, int(rng.integers(0, 80))) % 500)) for i in range(300)] + [(900, None), (901, "unseen words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in lm.score(df, false_rate=1e-15, broadcast_bits=bits, bucket_keys=500).collect()}
    want = model(rows)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def test_model_is_a_probability(spark):
    """After each word the model's probabilities of the known words add up to 1 at most."""
    rows = [(i, "x x x x x x x x") for i in range(9)] + [(20 + i, "x y x z y") for i in range(9)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.score < 0 for r in got)
    ids = [i for i in range(200) if lm_fold(i) == 1]
    train = [(i, t) for i, t in rows if lm_fold(i) != 1]
    ends = ["x", "y", "z", "x x", "x y", "x z", "x", "y x", "y y", "y z"]
    probe = spark.createDataFrame([*train, *zip(ids, ends), (ids[-1], "")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm.score(probe, false_rate=1e-12).where("held_out").collect()}
    first = [10 ** score[i] for i, t in zip(ids, ends) if " " not in t]
    assert sum(first[:3]) + 10 ** score[ids[-1]] < 1


def test_pairs_seen_once_count(spark):
    ids = [i for i in range(40) if lm_fold(i) != 1][:2]
    held = next(i for i in range(40) if lm_fold(i) == 1)
    # b follows a once in training and never follows c, which is as frequent
    rows = [(ids[0], "a b"), (ids[1], "c d"), (held, "a b"), (held, "c b")]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).where("held_out").collect()
    assert got[0].base_score == got[1].base_score and got[0].score > got[1].score + 0.3


def test_text_ids_and_clashing_names(spark):
    df = spark.createDataFrame([("a", "x y", 1), (None, "x", 2), ("a", None, 3)], "key string, text string, bucket int")
    got = lm.score(df, id_col="key").collect()
    assert sorted((r.key or "", r.n_tokens) for r in got) == [("", 2), ("a", 1), ("a", 3)]
