"""Pieces against the sentencepiece library, chunked against whole, round trips."""

import random

import numpy as np
import sentencepiece
from tidemark.llm import pieces
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VOC = pieces.Vocabulary.load()
LIB = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)


def odd_texts(n=400, seed=5):
    rng = random.Random(seed)
    alphabets = ["ab ", "the quick brown ", " \n\t", "aeiou", "日本語中文 ", "éàüß ñ", "🙂x ", "0123456789.-", "<>/!-=;(){} ", "́e  "]
    words = "the and international tokenization Straße 日本 naïve http://www.example.com/a?b=1 ;;;; ---- \r\n".split(" ")
    out = ["", " ", "  ", " a ", "a" * 300, " " * 70, "\n\n\n", "a" + " " * 45 + "b", "\x00\x01", "▁x ▁"]
    for _ in range(n):
        a = "".join(rng.choice(alphabets) for _ in range(rng.randint(1, 3)))
        out.append("".join(rng.choice(a) for _ in range(rng.randint(1, 120))))
        out.append(rng.choice([" ", "", "  "]).join(rng.choice(words) for _ in range(rng.randint(1, 30))))
    return out


def test_equal_to_library():
    for t in odd_texts():
        ids = VOC.encode(t)
        assert ids == LIB.encode(t), t
        assert VOC.decode(ids) == t.replace("▁", " ")
    for bad in ([3 + 0xC3], [0, 5], [1, 300, 2], [31999, 3 + 0xFF, 300]):
        assert VOC.decode(bad) == LIB.decode(bad)
    assert VOC.decode([40000]) is None and VOC.decode(None) is None and VOC.decode([1, None]) is None and VOC.decode([]) == ""


def chunked(text, size):
    s = VOC.prepared(text)
    cuts = [*range(0, len(s), size), len(s)]
    spans = list(zip(cuts, cuts[1:]))
    at = pieces.cut_states([VOC.transfer(s, a, b) for a, b in spans])
    return [i for (a, b), x, y in zip(spans, at, at[1:]) for i in VOC.backtrace(s, a, b, x, y)]


def test_chunks_equal_whole():
    for t in odd_texts(150, 9):
        for size in (16, 23, 64):
            if t:
                assert chunked(t, size) == LIB.encode(t), (t, size)


def test_combine_is_associative():
    s = VOC.prepared("internationalization" * 30)
    ms = [VOC.transfer(s, a, min(len(s), a + 40)) for a in range(0, len(s), 40)]
    for a, b, c in zip(ms, ms[1:], ms[2:]):
        x, y = pieces.combine(pieces.combine(a, b), c), pieces.combine(a, pieces.combine(b, c))
        assert np.array_equal(x, y)


def test_query_equals_library(spark):
    got = {r.doc_id: r for r in QUERIES["op1_sentencepiece"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].ids == LIB.encode(d.text) and got[d.doc_id].round_trip and got[d.doc_id].n_tokens == len(got[d.doc_id].ids)


def test_edges_and_giants(spark):
    rng = random.Random(2)
    texts = [None, "", " x  y\n", "a" * 900, "".join(rng.choice("abc de") for _ in range(2000)), "日本" * 300, "▁ q " * 100, " " * 500, "x"]
    rows = [(i, t, 1, "z") for i, t in enumerate(texts)] + [(4, texts[4], 2, "z"), (None, texts[3], 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, _key string")
    whole = pieces.encode(df, giant_chars=10**9)
    split = pieces.encode(df, giant_chars=100, chunk_chars=32)
    assert whole.columns == split.columns
    a, b = ({(r.doc_id, i): r for i, r in enumerate(sorted(x.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)))} for x in (whole, split))
    assert len(a) == len(b) == len(rows)
    for k in a:
        assert (a[k].ids, a[k].n_tokens, a[k].round_trip) == (b[k].ids, b[k].n_tokens, b[k].round_trip)
        t = texts[k[0]] if k[0] is not None else texts[3]
        assert a[k].ids == LIB.encode(t or "") and a[k].round_trip == ("▁" not in (t or ""))
    back = {r.doc_id: r.text for r in pieces.decode(split).collect()}
    assert back[4] == texts[4] and back[0] == "" and back[5] == texts[5]
    assert pieces.encode(df.limit(0)).count() == 0 and pieces.decode(split.limit(0)).count() == 0
