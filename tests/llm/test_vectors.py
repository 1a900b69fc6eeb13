"""Vector links against brute force, cells, edge rows."""

import numpy as np
from tidemark.llm import vectors
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, t=0.98):
    ok = [(i, y, np.array(x, float)) for i, y, x in rows if i is not None and y is not None and x is not None and len(x)
          and all(e is not None and np.isfinite(e) for e in x) and any(x)]
    root, deg = {i: i for i, _, _ in ok}, {}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in range(len(ok)):
        for b in range(a):
            (i, y, x), (j, z, w) = ok[a], ok[b]
            if y == z and len(x) == len(w) and x @ w / (np.linalg.norm(x) * np.linalg.norm(w)) >= t:
                deg[i], deg[j] = deg.get(i, 0) + 1, deg.get(j, 0) + 1
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    good = {i for i, _, _ in ok}
    return sorted((repr(i), deg.get(i, 0), find(i) if i in good else i, (find(i) if i in good else i) == i) for i, _, _ in rows)


def result(df):
    return sorted((repr(r.vec_id), r.n_links, r.component_id, r.kept) for r in df.collect())


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert result(QUERIES["op4_embedding_near_dedup"](spark, SF)) == brute(rows)


def test_edges_blocks_and_cells(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(60):
        base = rng.standard_normal(24)
        for k in range(6):
            x = base + rng.standard_normal(24) * np.linalg.norm(base) * [0, 0, 0.02, 0.03, 0.045, 0.2][k]
            rows.append((len(rows), c % 2, [float(v) for v in np.float32(x)]))
    bad = [None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] + [1.0] * 23]
    rows += [(1000 + i, 0, x) for i, x in enumerate(bad)] + [(None, 0, rows[0][2]), (2000, None, rows[0][2]), (2001, 1, rows[1][2][:5]), (2002, 1, [-v for v in rows[0][2]])]
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], "vec_id long, label int, embedding array<float>, cell string, block int")
    want = brute(rows)
    assert result(vectors.near_duplicates(df)) == want
    assert result(vectors.near_duplicates(df, block_rows=16)) == want
    got = result(vectors.near_duplicates(df, block_rows=32, cell_rows=40))       # cut by grid cells
    assert sum(w[1] for w in got) >= 0.95 * sum(w[1] for w in want) and all(a[1] <= b[1] for a, b in zip(got, want))
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_count_is_calibrated():
    k = vectors.needed_count(16, 2.0, 0.999)
    p = 0.9545
    assert 10 <= k <= 13 and (np.random.default_rng(0).binomial(16, p, 100000) >= k).mean() > 0.998
    assert vectors.grid(1000, 20_000, 0.999, 0.8, 0.2) == (0, 1)
    g, t = vectors.grid(10**9, 20_000, 0.999, 0.8, 0.2)
    assert g >= 7 and t >= 10


def test_sql_says_the_same():
    import duckdb
    from tidemark.llm.queries import ORACLES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    rows = con.execute("SELECT vec_id, label, embedding FROM embeddings").fetchall()
    got = con.execute("SELECT vec_id, n_links, component_id, kept FROM (" + ORACLES["op4_embedding_near_dedup"] + ")").fetchall()
    assert sorted((repr(a), *rest) for a, *rest in got) == brute(rows)


def test_size_changes_no_method(spark, monkeypatch):
    """A label that would have been cut into cells is compared whole."""
    def cut(*_):
        return 8, 1
    monkeypatch.setattr(vectors, "grid", cut)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 16))
    near = base + rng.standard_normal(base.shape) * 0.02 * np.linalg.norm(base, axis=1)[:, None]
    rows = [(i, 0, [float(e) for e in np.float32(x)]) for i, x in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert result(vectors.near_duplicates(df, block_rows=64)) == brute(rows)
