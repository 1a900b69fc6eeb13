"""DBSCAN by dense cells against a plain one; components against union-find."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cluster as CL
from tidemark.operators.components import components


def plain(x, eps, least, keys):
    near = [np.flatnonzero(np.sqrt(((x - p) ** 2).sum(1)) <= eps) for p in x]
    core = [len(b) >= least for b in near]
    root = {}
    for i in sorted(range(len(x)), key=lambda i: keys[i]):
        if core[i] and i not in root:
            todo = [i]
            while todo:
                j = todo.pop()
                if root.setdefault(j, keys[i]) == keys[i]:
                    todo += [k for k in near[j] if core[k] and k not in root]
    mine = [root.get(i) or min((root[j] for j in near[i] if core[j]), default=None) for i in range(len(x))]
    ids = {k: n for n, k in enumerate(sorted({m for m in mine if m}))}
    return [ids.get(m, -1) for m in mine]


@pytest.mark.parametrize("seed, n, eps, d", [(1, 500, 0.5, 3), (2, 400, 1.2, 7), (3, 300, 0.25, 2)])
def test_labels_of_a_plain_dbscan(spark, seed, n, eps, d):
    rng = np.random.default_rng(seed)
    x = np.round(rng.lognormal(0, 1, (n, d)), 1 if seed == 3 else 6)
    x[: n // 5] = x[0]          # equal rows
    names, keys = [f"f{i}" for i in range(d)], [f"k{i:04d}" for i in range(n)]
    pdf = pd.DataFrame(x, columns=names).assign(symbol=keys, day="a")
    both = pd.concat([pdf, pdf.head(30).assign(day="b")])
    got = CL.cluster_dbscan(spark.createDataFrame(both), eps, 4, group="day", features=names).select("day", "symbol", "dbscan_cluster").toPandas()
    for day, part in both.groupby("day"):
        v = part[names].to_numpy()
        sd = v.std(0)
        want = plain((v - v.mean(0)) / np.where(sd == 0, 1, sd), eps, 4, list(part.symbol))
        assert got[got.day == day].sort_values("symbol").dbscan_cluster.tolist() == want


def test_components_of_groups(spark):
    rng = random.Random(4)
    nodes = [(g, f"n{i:03d}") for g in (None, 1, 2) for i in range(60)]
    edges = [(g, f"n{rng.randrange(60):03d}", f"n{rng.randrange(60):03d}") for g in (None, 1, 2) for _ in range(45)]
    edges += [(1, f"n{i:03d}", f"n{i + 1:03d}") for i in range(20, 50)]
    root = {n: n[1] for n in nodes}
    for _ in nodes:
        for g, u, v in edges:
            root[g, u] = root[g, v] = min(root[g, u], root[g, v])
    got = components(spark.createDataFrame(nodes, "g int, node string"), spark.createDataFrame(edges, "g int, u string, v string")).collect()
    assert {(r.g, r.node): r.root for r in got} == root and len(got) == len(nodes)
    none = components(spark.createDataFrame(nodes, "g int, node string"), spark.createDataFrame([], "g int, u string, v string"))
    assert none.filter(F.col("node") != F.col("root")).count() == 0
