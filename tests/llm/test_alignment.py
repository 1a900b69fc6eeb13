"""Alignment of two tokenizers against the libraries run on whole texts and a plain walk."""

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paths import SF_SMALL
from tidemark.llm import alignment

TEXTS = [None, "", " ", "  ", "a", " a b", "a  b", "a b ", "\n\n x\t y \n", "<s> </s> <unk> <0x41> <|endoftext|> done", "naïve café ▁ mark",
         "▁", "\U0001f600 \U0001f469‍\U0001f680 ok", "\x00 nul \x1c x", "don't we'll  it's 1234567890 ..., !!!", "a b  c 　 d",
         "x" * 3000, "ab " * 2000, "日本語 テキスト です", "The quick brown fox " * 50, "é ​ z", "repeat", "repeat"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(alignment.BYTE_MODEL)
    a.encode_special_tokens = True
    pair = alignment.Pair.load()
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL), pair.a_bytes(), pair.b_bytes()


def walk(text, tools):
    """(A ids, B ids, overlaps, ends-together pairs) of one text, by its byte ranges."""
    a, b, bytes_a, bytes_b = tools
    none = [], [], set(), []
    if not text:
        return none
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw = (" " + text).encode()
    if b"".join(bytes_a[i] for i in x) != raw or b"".join(bytes_b[i] for i in y) != raw:
        return none
    spans = []
    for ids, table in ((x, bytes_a), (y, bytes_b)):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i])))
            at = out[-1][1]
        spans.append(out)
    owner = [[], []]
    for k in (0, 1):
        for n, (s, e) in enumerate(spans[k]):
            owner[k] += [n] * (e - s)
    over = set(zip(*owner))
    last = sorted((i, j) for i, j in over if spans[0][i][1] == spans[1][j][1])
    return x, y, over, last


def brute(texts, tools):
    walks = [walk(t, tools) for t in texts]
    count = Counter((x[i], y[j]) for x, y, _, last in walks for i, j in last)
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    out = []
    for x, y, _, last in walks:
        links, groups, i0, j0 = [(x[i], y[j]) for i, j in last], [], 0, 0
        for i, j in last:
            groups.append(",".join(map(str, x[i0:i + 1])) + "|" + ",".join(map(str, y[j0:j + 1])))
            i0, j0 = i + 1, j + 1
        out.append((len(x), len(y), len(groups), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return out


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("window, slice_chars", [(alignment.WINDOW, alignment.SLICE_CHARS), (40, 64)])
def test_digests_against_walk(spark, tools, monkeypatch, window, slice_chars):
    monkeypatch.setattr(alignment, "SLICE_CHARS", slice_chars)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("part", F.lit("p")).repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in alignment.digests(df, window=window).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, tools)


def test_align_gives_all_overlaps(spark, tools):
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 3, t, i) for i, t in enumerate(TEXTS)], "a long, text string, key int")
    got = {r.key: r for r in alignment.align(df).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        x, y, over, last = walk(t, tools)
        r = got[i]
        assert (r.a, r.b, r.part) == (x, y, 0)
        assert sorted(zip(r.over_a, r.over_b)) == sorted(over)
        assert list(zip(r.last_a, r.last_b)) == last


def test_parts_of_a_long_document_join_up(spark, tools):
    text = " ".join(f"word{i % 37} ab,c" for i in range(500))
    rows = sorted(alignment.align(spark.createDataFrame([(text,)], "text string"), window=64).collect(), key=lambda r: r.part)
    x, y, over, _ = walk(text, tools)
    assert len(rows) > 3 and sum((r.a for r in rows), []) == x and sum((r.b for r in rows), []) == y
    assert sum(len(r.over_a) for r in rows) == len(over)


def test_empty_table_and_text_ids(spark):
    assert alignment.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = alignment.digests(spark.createDataFrame([("x", "a b"), (None, None)], "doc_id string, text string")).collect()
    assert sorted((r.doc_id or "", r.n_a) for r in got) == [("", 0), ("x", 2)]


def test_pairs_are_bounded_by_the_vocabularies():
    assert alignment.Pair.load().pair_bound() < 1_000_000
