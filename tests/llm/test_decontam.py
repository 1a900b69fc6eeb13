"""Leaks against brute force over all item-sized windows."""

import math
from collections import Counter

from tidemark.llm import decontam
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(t):
    return (t or "").encode().lower().split()


def shingles(w):
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(docs, items, threshold=0.8):
    items = [(i, shingles(words(t))) for i, t in items if i is not None and t is not None]
    df = Counter(s for _, x in items for s in set(x))
    weight = lambda s: math.log1p(len(items) / max(1, df[s]))
    out = {}
    for d, t in docs:
        w = words(t)
        sh = shingles(w)
        for i, x in items:
            if not x or not sh or not set(x) & set(sh):
                continue
            m = min(len(x), len(sh))
            ci = Counter(x)
            best = 0
            for a in range(len(sh) - m + 1):
                cw = Counter(sh[a:a + m])
                keys = set(ci) | set(cw)
                hi = sum(weight(s) * max(ci[s], cw[s]) for s in keys)
                best = max(best, sum(weight(s) * min(ci[s], cw[s]) for s in keys) / hi)
            if best >= threshold:
                out[d, i] = round(best, 6)
    return out


def as_dict(df):
    rows = df.collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id): round(r.similarity, 6) for r in rows}


def test_query_finds_what_brute_force_finds(spark):
    read = lambda n: [tuple(r) for r in spark.read.parquet(f"{SF}/{n}.parquet").select(*c[n]).collect()]
    c = {"documents": ("doc_id", "text"), "benchmark": ("item_id", "text")}
    want = brute(read("documents"), read("benchmark"))
    assert want and as_dict(QUERIES["op8_benchmark_decontamination"](spark, SF)) == want


def test_edges_slices_and_filter(spark):
    w = [f"w{i}" for i in range(400)]
    item = " ".join(w[:40])
    near = " ".join(w[100:150] + w[:20] + ["X"] + w[21:40] + w[200:220])       # one word changed: under 0.8
    edit_end = " ".join(w[300:340] + ["y"] + w[1:40] + w[200:220])             # first word changed: over 0.8
    docs = [(1, None), (2, ""), (3, "w1 w2"), (4, item.upper()), (5, "  " + item.replace(" ", "\n\t")), (6, near), (7, edit_end),
            (8, " ".join(w[50:100])), (None, item), (10, " ".join(w * 50 + w[:3])), (11, item + " " + item)]
    items = [(1, item), (2, item), (3, "w1 w2 w3"), (4, None), (None, item), (5, " ".join(w[200:215]))]
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, doc_id string")
    want = brute(docs, items)
    assert as_dict(decontam.leaks(d, b)) == want and {(6, 1), (8, 1)}.isdisjoint(want) and (7, 1) in want
    assert set(as_dict(decontam.leaks(d, b, slice_bytes=100))) == set(want)
    kept = decontam.decontaminate(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {x for x, _ in docs} - {x for x, _ in want}
    assert decontam.leaks(d.limit(0), b).count() == 0 and decontam.leaks(d, b.limit(0)).count() == 0
    assert decontam.decontaminate(d, b.limit(0)).count() == len(docs)


def test_blocks_find_all_within_radius():
    import numpy as np
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"t{x}" for x in rng.integers(0, 9999, 30))) for i in range(300)]
    from collections import defaultdict
    ix = decontam.Index(items, defaultdict(lambda: 1), 300, 5, 0.8, 15)
    for _ in range(50):
        fp = ix.fps[rng.integers(300)] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 20), replace=False)))
        want = [i for i, x in enumerate(ix.fps) if bin(int(x ^ fp)).count("1") <= 15]
        assert sorted(ix.near(fp).tolist()) == want


def test_slices_change_no_similarity(spark):
    """Weights follow the whole benchmark, however many slices it makes."""
    w = [f"w{i}" for i in range(400)]
    common = " ".join(w[300:320])               # in many items, so its shingles weigh little
    items = [(i, " ".join(w[10 * i:10 * i + 30]) + " " + common) for i in range(12)] + [(90, common + " " + " ".join(w[:9]))]
    docs = [(i, "a b c " + t.replace(f"w{10 * i + 1} ", "x ", 1) + " d e f") for i, t in items] + [(200, None), (201, common)]
    docs += [(300 + i, " ".join(["q"] + t.split()[3:])) for i, t in items]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = as_dict(decontam.leaks(d, b))
    assert want == brute(docs, items)
    assert as_dict(decontam.leaks(d, b, slice_bytes=300)) == want
    kept = decontam.decontaminate(d, b, slice_bytes=300)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {x for x, _ in docs} - {x for x, _ in want}
