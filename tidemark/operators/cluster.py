"""Clustering of assets by behaviour (K1-K5), on one snapshot or per snapshot.

* K1 ``standardize``: median fill, (x - mean) / population std, zero std →
  divisor 1; statistics are grouped aggregates (global = one group).
* K2 ``cluster_kmeans``: MLlib k-means (distributed Lloyd iterations,
  k-means|| start), best training cost of ``n_init`` seeds.
* K3 ``cluster_hierarchical``: exact Ward (nearest-neighbour chain, O(n^2))
  per group in ``applyInPandas``, or, if the caller asks for ``micro``, on the
  weighted centres of k-means micro-clusters; never chosen by size.
* K4 ``cluster_dbscan``: cells of diagonal eps over all features; dense cells are
  core without a distance, other points meet the cells whose box they reach,
  components by large and small stars (``components``), border points take the
  smallest neighbouring core label, the rest are noise (-1). Labels are numbered by each
  component's smallest key, so they are deterministic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.components import components
from tidemark.operators.series import materialize, sized_join
from tidemark.operators.stats import grouped_quantiles

# The feature list, cluster count, DBSCAN parameters.
CLUSTER_FEATURES = ["price", "market_cap", "volume_24h", "percent_change_24h", "percent_change_7d",
                    "volatility", "market_dominance"]
N_CLUSTERS = 5
DBSCAN_EPS = 1.2
DBSCAN_MIN_SAMPLES = 4


def available(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES) -> list[str]:
    return [f for f in features if f in df.columns]


def standardize(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES, group: str | None = None,
                prefix: str = "z_", accuracy: int | None = None) -> DataFrame:
    """K1: ``z_<f>`` for every available feature."""
    feats = available(df, features)
    g = group or "_std_g"
    base = df if group else df.withColumn(g, F.lit(0))
    meds = materialize(grouped_quantiles(base, g, {f: [0.5] for f in feats}).select(
        g, *[F.col(f"_q_{f}_0").alias(f"_m_{f}") for f in feats]))
    base = sized_join(base, meds, g, "left").withColumns(
        {f"_f_{f}": F.coalesce(F.col(f).cast("double"), F.col(f"_m_{f}")) for f in feats})
    mom = materialize(base.groupBy(g).agg(*[F.avg(f"_f_{f}").alias(f"_mu_{f}") for f in feats],
                                          *[F.stddev_pop(f"_f_{f}").alias(f"_sd_{f}") for f in feats]))
    base = sized_join(base, mom, g, "left")
    out = base.withColumns({
        f"{prefix}{f}": (F.col(f"_f_{f}") - F.col(f"_mu_{f}"))
        / F.when(F.col(f"_sd_{f}") == 0, F.lit(1.0)).otherwise(F.col(f"_sd_{f}")) for f in feats})
    drop = [f"_{p}_{f}" for f in feats for p in ("m", "f", "mu", "sd")]
    out = out.drop(*drop)
    return out if group else out.drop(g)


# --------------------------------------------------------------------------- K2
def cluster_kmeans(df: DataFrame, k: int = N_CLUSTERS, n_init: int = 10, seed: int = 42,
                   features: Sequence[str] = CLUSTER_FEATURES, label: str = "kmeans_cluster") -> DataFrame:
    """K2: k-means on the standardized features; the lowest-cost of
    ``n_init`` seeded runs is kept (each run is a distributed MLlib fit). With fewer
    than ``k`` distinct rows there are as many clusters as those."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    z = standardize(df, features)
    cols = [f"z_{f}" for f in available(df, features)]
    vec = VectorAssembler(inputCols=cols, outputCol="_vec").transform(z)
    vec = materialize(vec)
    k = min(k, vec.select(*cols).distinct().limit(k).count())
    if k < 2:
        return vec.withColumn(label, F.lit(0)).drop("_vec", *cols)
    best = None
    for i in range(n_init):
        model = KMeans(k=k, seed=seed + i, featuresCol="_vec", predictionCol=label).fit(vec)
        cost = model.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, model)
    return best[1].transform(vec).drop("_vec", *cols)


# --------------------------------------------------------------------------- K3
def ward_labels(x: np.ndarray, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Exact Ward clustering into ``k`` groups (nearest-neighbour chain with
    Lance-Williams updates on squared distances; O(n^2) time and memory).
    ``weights`` start clusters with those sizes (for micro-cluster centroids)."""
    n = len(x)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    if n <= k:
        return np.arange(n)
    size = np.ones(n) if weights is None else weights.astype(float).copy()
    sq = (x * x).sum(1)
    d = np.maximum(sq[:, None] + sq[None, :] - 2.0 * x @ x.T, 0.0)
    # Ward merge cost between singletons of sizes a, b: a b / (a + b) * |xa - xb|^2
    d = d * (size[:, None] * size[None, :]) / (size[:, None] + size[None, :])
    np.fill_diagonal(d, np.inf)
    active = np.ones(n, dtype=bool)
    merges = []
    chain: list[int] = []
    while active.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(active)[0]))
        a = chain[-1]
        row = np.where(active, d[a], np.inf)
        row[a] = np.inf
        b = int(np.argmin(row))
        if len(chain) > 1 and row[chain[-2]] <= row[b]:
            b = chain[-2]
        if len(chain) > 1 and b == chain[-2]:
            chain.pop()
            chain.pop()
            dab = d[a, b]
            merges.append((dab, a, b))
            na, nb = size[a], size[b]
            nk = size
            # Lance-Williams for the Ward merge cost
            new = ((na + nk) * d[a] + (nb + nk) * d[b] - nk * dab) / (na + nb + nk)
            d[a] = new
            d[:, a] = new
            d[a, a] = np.inf
            active[b] = False
            d[b] = np.inf
            d[:, b] = np.inf
            size[a] = na + nb
        else:
            chain.append(b)
    # cut: apply the n - k cheapest merges (Ward is reducible, so order by cost)
    parent = np.arange(n)

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for _, a, b in sorted(merges)[: n - k]:
        parent[find(b)] = find(a)
    roots = np.array([find(i) for i in range(n)])
    _, labels = np.unique(roots, return_inverse=True)
    return labels


def cluster_hierarchical(df: DataFrame, k: int = N_CLUSTERS, group: str | None = None,
                         features: Sequence[str] = CLUSTER_FEATURES, key: str = "symbol",
                         label: str = "hierarchical_cluster", method: str = "exact",
                         micro_clusters: int = 256, seed: int = 42) -> DataFrame:
    """K3: Ward into ``k`` clusters on standardized features, per ``group``
    (one snapshot when ``group`` is None).

    The caller names the method; the size of a group never changes it. ``exact`` merges
    all rows of a group in one task (memory grows with the square of the group);
    ``micro`` merges ``micro_clusters`` k-means centres and scales to any group, one
    frame only (``group`` None)."""
    if method not in ("exact", "micro") or method == "micro" and group:
        raise ValueError("method is 'exact', or 'micro' without group")
    z = standardize(df, features, group)
    cols = [f"z_{f}" for f in available(df, features)]
    g = group or "_hg"
    z = materialize(z if group else z.withColumn(g, F.lit(0)))
    if method == "micro":
        labels = _ward_micro(z, cols, g, key, label, k, micro_clusters, seed)
    else:
        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(key)
            lab = ward_labels(pdf[cols].to_numpy(dtype=float), k)
            return pd.DataFrame({g: pdf[g].to_numpy(), key: pdf[key].to_numpy(), label: lab.astype(np.int32)})
        types = dict(z.dtypes)
        labels = z.select(g, key, *cols).groupBy(g).applyInPandas(fit, f"{g} {types[g]}, {key} {types[key]}, {label} int")
    out = z.join(labels, [g, key], "left").drop(*cols)
    return out if group else out.drop(g)


def _ward_micro(part: DataFrame, cols, g, key, label, k, m, seed) -> DataFrame:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    vec = VectorAssembler(inputCols=cols, outputCol="_vec").transform(part)
    model = KMeans(k=m, seed=seed, featuresCol="_vec", predictionCol="_micro").fit(vec)
    assigned = model.transform(vec)
    counts = {r["_micro"]: r["count"] for r in assigned.groupBy("_micro").count().collect()}
    centres = np.array(model.clusterCenters())
    w = np.array([counts.get(i, 0) for i in range(len(centres))], dtype=float)
    keep = w > 0
    lab = np.full(len(centres), -1)
    lab[keep] = ward_labels(centres[keep], k, w[keep])
    mapping = part.sparkSession.createDataFrame(
        [(int(i), int(lab[i])) for i in range(len(centres))], "_micro int, _lab int")
    return (assigned.join(F.broadcast(mapping), "_micro")
            .select(g, key, F.col("_lab").cast("int").alias(label)))


# --------------------------------------------------------------------------- K4
def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, t: s + t))


def _gap(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    """Distance of two boxes."""
    apart = F.zip_with(F.arrays_zip(lo_a.alias("lo"), hi_a.alias("hi")), F.arrays_zip(lo_b.alias("lo"), hi_b.alias("hi")),
                       lambda p, q: F.greatest(F.lit(0.0), p["lo"] - q["hi"], q["lo"] - p["hi"]))
    return F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, t: s + t * t))


def _neighbours(cells: DataFrame, n_cols: int, eps: float, side: float) -> DataFrame:
    """``g, a, b``: ordered pairs of different cells whose boxes are within ``eps``. Cells meet
    by a coarse grid over the (up to three) features with the most occupied slices."""
    used = cells.agg(*[F.approx_count_distinct(F.floor(F.col("lo")[i] / eps)) for i in range(n_cols)]).head()
    dims = sorted(range(n_cols), key=lambda i: -(used[i] or 0))[:3]
    near = cells.select("g", F.col("cell").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"),
                        *[F.floor(F.col("lo")[i] / eps).alias(f"s{i}") for i in dims])
    probe = cells.select("g", F.col("cell").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
    for i in dims:
        first, last = F.floor((F.col("lo_a")[i] - eps - side) / eps), F.floor((F.col("hi_a")[i] + eps) / eps)
        probe = probe.withColumn(f"s{i}", F.explode(F.sequence(first, last)))
    met = probe.join(near, ["g", *[f"s{i}" for i in dims]])
    gap = _gap(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b"))
    return met.where((F.col("a") != F.col("b")) & (gap <= eps * (1 + 1e-9))).select("g", "a", "b")


def cluster_dbscan(df: DataFrame, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES,
                   group: str | None = None, features: Sequence[str] = CLUSTER_FEATURES,
                   key: str = "symbol", label: str = "dbscan_cluster") -> DataFrame:
    """K4: DBSCAN on standardized features, per ``group``.

    Equal rows are one weighted point. Points fall into cells of diagonal ``eps`` over all
    features: a cell of ``min_samples`` rows is core and one cluster without a distance. Points
    of other cells meet the cells whose box is within ``eps``: extreme points of dense cells
    settle most, the rest are compared one by one. Cells or points that the cheap links
    leave in different components are compared exactly. A row with a feature that is NULL
    everywhere in its group is noise."""
    z = standardize(df, features, group)
    cols = [f"z_{f}" for f in available(df, features)]
    d = len(cols)
    rows = z.select((F.col(group) if group else F.lit(0)).alias("g"), F.col(key).alias("key"), F.array(*cols).alias("x"))
    whole = rows.where(reduce(lambda a, b: a & b, [F.col("x")[i].isNotNull() for i in range(d)]))
    side = eps / math.sqrt(d) * (1 - 1e-9)
    pts = materialize(whole.groupBy("g", "x").agg(F.count(F.lit(1)).alias("w"), F.min("key").alias("k"))
                      .withColumn("cell", F.transform("x", lambda v: F.floor(v / side))))
    cells = materialize(pts.groupBy("g", "cell").agg(
        F.sum("w").alias("w"), F.min("k").alias("node"),
        F.array(*[F.min(F.col("x")[i]) for i in range(d)]).alias("lo"), F.array(*[F.max(F.col("x")[i]) for i in range(d)]).alias("hi"),
        F.array_distinct(F.array(*[f("x", F.col("x")[i]) for i in range(d) for f in (F.min_by, F.max_by)])).alias("ends"))
        .withColumn("dense", F.col("w") >= min_samples))
    near = materialize(_neighbours(cells, d, eps, side))
    # the points of cells that are not dense, and the neighbouring cells within reach of each
    own = pts.join(cells.select("g", "cell", "dense", F.col("w").alias("cell_w")), ["g", "cell"])
    thin = materialize(own.where("not dense").select("g", "cell", "k", "x", "w", "cell_w"))
    box = cells.select("g", F.col("cell").alias("b"), "node", "lo", "hi", "ends", "dense")
    reach = thin.join(near.withColumnRenamed("a", "cell"), ["g", "cell"]).join(box, ["g", "b"])
    reach = reach.where(_gap(F.col("x"), F.col("x"), F.col("lo"), F.col("hi")) <= eps * (1 + 1e-9))
    hits = F.size(F.filter("ends", lambda e: _distance(F.col("x"), e) <= eps))
    reach = materialize(reach.select("g", "k", "x", "b", "node", "dense", F.when(F.col("dense"), hits).otherwise(0).alias("hits")))
    other = lambda cond: pts.join(cells.where(cond).select("g", "cell"), ["g", "cell"], "left_semi").select(
        "g", F.col("cell").alias("b"), F.col("x").alias("y"), F.col("w").alias("wy"), F.col("k").alias("ky"))
    close = F.col("dist") <= eps
    pair = lambda left, cond: left.join(other(cond), ["g", "b"]).withColumn("dist", _distance(F.col("x"), F.col("y"))).where(close)
    inside = thin.select("g", F.col("cell").alias("b"), "k", "x")
    thin_pairs = materialize(pair(reach.where("not dense").select("g", "b", "k", "x").union(inside.select("g", "b", "k", "x")), "not dense")
                             .select("g", "k", "ky", "wy"))
    count = (thin_pairs.groupBy("g", "k").agg(F.sum("wy").alias("n"))       # a point finds itself
             .union(reach.where("dense").groupBy("g", "k").agg(F.sum("hits").alias("n")))
             .groupBy("g", "k").agg(F.sum("n").alias("n")))
    open_ = count.where(F.col("n") < min_samples).select("g", "k")
    exact = materialize(pair(reach.where("dense").join(open_, ["g", "k"], "left_semi").select("g", "b", "node", "k", "x"), "dense")
                        .groupBy("g", "k", "node").agg(F.sum("wy").alias("n")))
    full = thin_pairs.select("g", "k", F.col("wy").alias("n")).union(exact.select("g", "k", "n")).groupBy("g", "k").agg(F.sum("n").alias("n"))
    core = materialize(count.where(F.col("n") >= min_samples).select("g", "k")
                       .union(full.where(F.col("n") >= min_samples).select("g", "k")).distinct())
    # links: thin core points with each other and with dense cells, dense cells with each other
    to_cell = materialize(reach.where(F.col("dense") & (F.col("hits") > 0)).select("g", "k", "node").union(exact.select("g", "k", "node")).distinct())
    is_core = lambda name: core.select("g", F.col("k").alias(name))
    thin_links = thin_pairs.where("k < ky").join(core, ["g", "k"], "left_semi").join(is_core("ky"), ["g", "ky"], "left_semi")
    dense = box.where("dense").select("g", F.col("b").alias("cell"), "node", "lo", "hi", "ends")
    left = dense.select("g", F.col("cell").alias("a"), F.col("node").alias("u"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), F.col("ends").alias("ends_a"))
    twins = materialize(near.where("a < b").join(left, ["g", "a"]).join(dense.withColumnRenamed("cell", "b").withColumnRenamed("node", "v"), ["g", "b"])
                        .withColumn("met", F.exists("ends_a", lambda p: F.exists("ends", lambda q: _distance(p, q) <= eps))))
    nodes = materialize(dense.select("g", "node").union(core.select("g", F.col("k").alias("node"))))
    links = materialize(thin_links.select("g", F.col("k").alias("u"), F.col("ky").alias("v"))
                        .union(to_cell.join(core, ["g", "k"], "left_semi").select("g", F.col("k").alias("u"), F.col("node").alias("v")))
                        .union(twins.where("met").select("g", "u", "v")))
    root = components(nodes, links)

    def apart(pairs: DataFrame, u: str, v: str) -> DataFrame:
        """Pairs whose nodes are in different components so far."""
        side_of = lambda n, r: root.select("g", F.col("node").alias(n), F.col("root").alias(r))
        return pairs.join(side_of(u, "_ru"), ["g", u]).join(side_of(v, "_rv"), ["g", v]).where("_ru <> _rv").drop("_ru", "_rv")

    point = lambda cell, name: pts.select("g", F.col("cell").alias(cell), F.col("x").alias(name))
    more = apart(reach.where("dense and hits = 0").select("g", "b", "node", "k", "x").join(core, ["g", "k"], "left_semi"), "k", "node")
    more = pair(more, "dense").select("g", F.col("k").alias("u"), F.col("node").alias("v"))
    left_over = materialize(apart(twins.where("not met"), "u", "v"))
    within = lambda x, lo, hi: _gap(F.col(x), F.col(x), F.col(lo), F.col(hi)) <= eps * (1 + 1e-9)
    ours = left_over.join(point("a", "x"), ["g", "a"]).where(within("x", "lo", "hi")).select("g", "a", "b", "u", "v", "x")
    theirs = left_over.join(point("b", "y"), ["g", "b"]).where(within("y", "lo_a", "hi_a")).select("g", "a", "b", "y")
    last = ours.join(theirs, ["g", "a", "b"]).where(_distance(F.col("x"), F.col("y")) <= eps).select("g", "u", "v")
    new = materialize(more.union(last).distinct())
    if not new.isEmpty():
        root = components(nodes, links.union(new))
    root = materialize(root.select("g", "node", "root"))
    # border points: the smallest cluster among the core points within reach
    edge = (to_cell.select("g", "k", "node").union(thin_pairs.select("g", "k", F.col("ky").alias("node")))
            .join(core, ["g", "k"], "left_anti").join(root, ["g", "node"]).groupBy("g", "k").agg(F.min("root").alias("root")))
    thin_root = core.join(root.withColumnRenamed("node", "k"), ["g", "k"]).select("g", "k", "root").union(edge.select("g", "k", "root"))
    dense_root = dense.join(root, ["g", "node"]).select("g", "cell", F.col("root").alias("cell_root"))
    found = (pts.join(dense_root, ["g", "cell"], "left").join(thin_root, ["g", "k"], "left")
             .select("g", "x", F.coalesce("cell_root", "root").alias("root")).where("root is not null"))
    # one row per cluster root: a small table, numbered 0.. within each group
    ids = found.select("g", "root").distinct().withColumn(label, (F.dense_rank().over(Window.partitionBy("g").orderBy("root")) - 1).cast("int"))
    named = found.join(ids, ["g", "root"]).select(F.col("g").alias("_g"), F.col("x").alias("_x"), label)
    g = F.col(group) if group else F.lit(0)
    out = z.drop(label) if label in z.columns else z
    out = out.join(named, g.eqNullSafe(F.col("_g")) & (F.array(*cols) == F.col("_x")), "left")
    return out.withColumn(label, F.coalesce(F.col(label), F.lit(-1))).drop("_g", "_x", *cols)


def cluster_all(latest: DataFrame, k: int = N_CLUSTERS, key: str = "symbol") -> DataFrame:
    """K5: the three labels on one snapshot."""
    km = cluster_kmeans(latest, k).select(key, "kmeans_cluster")
    hc = cluster_hierarchical(latest, k, key=key).select(key, "hierarchical_cluster")
    db = cluster_dbscan(latest, key=key).select(key, "dbscan_cluster")
    return latest.join(km, key, "left").join(hc, key, "left").join(db, key, "left")
