"""SimHash fingerprints and groups against a brute-force version."""

import re

import xxhash
from pyspark.sql import functions as F
from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    fp = 0
    for b in range(64):
        if sh and 2 * sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in sh) > len(sh):
            fp |= 1 << b
    return fp


def brute_groups(rows, bits=2):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, f"{f:016x}", low.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))]


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op7_simhash_near_dedup"](spark, SF).collect()]
    assert sorted(got) == sorted(brute_groups(rows))


def test_edge_rows(spark):
    rows = [(5, None), (2, ""), (9, " \t\n"), (None, None), (7, "one"), (8, "ONE"), (8, "one"), (3, "ä Ä\x85x y"),
            (11, "a b c d e f " * 3000), (None, "unique text of a row without id")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, component_id int")
    got = [tuple(r) for r in simhash.simhash_components(df).collect()]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(got, key=key) == sorted(brute_groups(rows), key=key)
    kept = simhash.keep_one(df).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [2, 3, 7, 11] and len(kept) == 5
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp", "component_id"}
    assert simhash.simhash_components(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_links_find_all_distances(spark):
    base = 0x0123456789ABCDEF
    vals = {base, base ^ 1, base ^ 3, base ^ 7, base ^ (1 << 63), base ^ (3 << 40), ~base & (1 << 64) - 1}
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in vals], "fp long")
    root = {r.node: r.root for r in simhash.fingerprint_roots(df).collect()}
    assert len(set(root.values())) == 1 and len(root) == len(vals) - 1
    for bits in (1, 3):
        got = {(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in simhash.links(df, bits).collect()}
        near = {frozenset((a, b)) for a in vals for b in vals if a != b and bin(a ^ b).count("1") <= bits}
        assert {frozenset(p) for p in got} == near


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert spark.range(1).select(F.lit(1)).count() == 1
