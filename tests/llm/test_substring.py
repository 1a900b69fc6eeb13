"""Repeated passages against planted ones and against verbatim search."""

import random

import numpy as np
from tidemark.llm import substring
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_gear_is_the_rolling_hash():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 500).astype(np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = (2 * h + int(substring._GEAR[b])) % 65536
        want.append(h)
    assert substring.gear(data).tolist() == want
    cut = substring.borders(data, 4, 16, 128)
    assert cut[0] == 0 and cut[-1] == 500 and (np.diff(cut)[:-1] >= 16).all() and np.diff(cut).max() <= 128


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_planted_passages(spark):
    rng = random.Random(8)
    docs = [[i, words(rng, rng.randint(80, 400))] for i in range(300)]
    hosts = set()
    for p in range(60):
        passage = words(rng, 51)
        a, b = rng.sample(range(200), 2)
        for d in (a, b):
            t = docs[d][1].split(" ")
            k = rng.randrange(len(t))
            docs[d][1] = " ".join(t[:k] + [passage] + t[k:])
            hosts.add(d)
    docs += [[400, None], [401, ""], [402, "short"], [None, docs[0][1]], [403, docs[250][1]], [404, ("same line of text again " * 8 + "\n") * 40], [405, "a" * 5000]]
    docs.append(list(docs[3]))
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in docs], "doc_id long, text string, e int, first string")
    rows = substring.passages(df).collect()
    found = {r.doc_id for r in rows}
    assert hosts <= found and found - hosts <= {250, 403}, (hosts - found, found - hosts)
    assert {250, 403} <= found
    text = {d: (t or "").encode() for d, t in docs}
    for r in rows:
        s = text[r.doc_id][r.start_byte:r.end_byte]
        assert len(s) >= 128 and any(s[:64] in t for d, t in text.items() if d != r.doc_id) and r.first_doc_id <= r.doc_id
    assert [r.kept for r in rows if r.doc_id == 250] == [True] and [r.kept for r in rows if r.doc_id == 403] == [False]
    assert substring.passages(df.limit(0)).count() == 0


def test_query_finds_long_repeats(spark):
    got = QUERIES["op5_substring_dedup"](spark, SF).collect()
    docs = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen, long = {}, set()
    for d, t in docs.items():
        for i in range(0, len(t) - 400, 1):
            w = t[i:i + 400]
            h = hash(w)
            if seen.setdefault(h, d) != d:
                long |= {d, seen[h]}
    assert long <= {r.doc_id for r in got}
    for r in got:
        s = docs[r.doc_id][r.start_byte:r.start_byte + 64]
        assert any(s in t for d, t in docs.items() if d != r.doc_id)
