"""Near-duplicate vectors by collision counting on one-dimensional projections.

Two unit vectors of cosine at least t are at most r = sqrt(2 - 2 t) apart, so on a
Gaussian direction their projections differ by a normal deviate of spread at most r.
Each block of vectors is sorted by each of ``projections`` directions; around every
query's projection a window of ``half_width`` spreads is counted, and pairs with at
least as many collisions as a pair of cosine t reaches with probability ``recall``
(a binomial tail) are verified by their exact cosine.

Equal vectors of a label are one class, found by grouping; only classes are
compared, and copies count through their class's size. All classes of a label are
compared, block against block, whatever its size: the work is quadratic in a label's
distinct vectors, spread over the pairs of blocks. Only a caller that names ``cell_rows``
gets ``tables`` of grid cells over further projections for labels beyond it: the number of grid
directions follows the label's size and the number of tables the wanted recall. A cell
of any size is cut into blocks, and every pair of blocks is a group of its own, so no
group grows with the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, stage, unstage
from .components import components

SEED = 20240613


def directions(dim: int, first: int, n: int) -> np.ndarray:
    """(dim, n) Gaussian directions number ``first`` and on; the same in every task."""
    return np.stack([np.random.default_rng([SEED, dim, first + i]).standard_normal(dim) for i in range(n)], axis=1) if n else np.empty((dim, 0))


def needed_count(projections: int, half_width: float, recall: float) -> int:
    """Most collisions that a borderline pair reaches with probability ``recall``."""
    p = math.erf(half_width / math.sqrt(2))
    tail, k = 0.0, projections
    while k > 0:
        tail += math.comb(projections, k) * p ** k * (1 - p) ** (projections - k)
        if tail >= recall:
            return k
        k -= 1
    return 0


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool, threshold: float, projections: int, half_width: float,
               recall: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i of a, j of b; i < j if both are the same block) of cosine at
    least ``threshold``: collision counts first, then the exact cosine."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    r = math.sqrt(max(0.0, 2 - 2 * threshold))
    d = directions(a.shape[1], 0, projections)
    pa_, pb = (a / na[:, None]) @ d, (b / nb[:, None]) @ d
    counts = np.zeros((len(a), len(b)), np.uint8)
    w = half_width * r + 1e-9
    for j in range(projections):
        order = np.argsort(pb[:, j], kind="stable")
        ranked = pb[order, j]
        lo, hi = np.searchsorted(ranked, pa_[:, j] - w), np.searchsorted(ranked, pa_[:, j] + w, "right")
        for i in range(len(a)):
            counts[i, order[lo[i]:hi[i]]] += 1
    i, j = np.nonzero(counts >= needed_count(projections, half_width, recall))
    if same:
        i, j = i[i < j], j[i < j]
    ok = np.empty(len(i), bool)
    for s in range(0, len(i), 65_536):
        x, y = i[s:s + 65_536], j[s:s + 65_536]
        ok[s:s + 65_536] = np.einsum("ij,ij->i", a[x], b[y]) / (na[x] * nb[y]) >= threshold
    return i[ok], j[ok]


def grid(largest: int, cell_rows: int, recall: float, width: float, r: float) -> tuple[int, int]:
    """(grid directions per table, tables) for the largest label: every direction
    leaves about 0.28 * width of random pairs and keeps 1 - 0.8 r / width of near ones."""
    g = 0 if largest <= cell_rows else math.ceil(math.log(largest / cell_rows) / -math.log(0.283 * width))
    hit = (1 - 0.8 * r / width) ** g
    return g, 1 if g == 0 else math.ceil(math.log(1 - recall) / math.log(1 - hit))


def class_links(classes: DataFrame, threshold: float, projections: int, half_width: float, recall: float, block_rows: int,
                cell_rows: int | None, width: float = 0.8) -> DataFrame:
    """Distinct (u, v, cu, cv): linked classes by id, u < v, and their sizes."""
    g, tables = 0, 1
    if cell_rows is not None:
        largest = classes.groupBy("label", F.size("x").alias("dim")).count().agg(F.max("count")).first()[0] or 0
        g, tables = grid(largest, cell_rows, recall, width, math.sqrt(max(0.0, 2 - 2 * threshold)))
    rows = classes.select("id", "copies", "label", "x", F.size("x").alias("dim"))
    if g == 0:
        cells = rows.withColumn("cell", F.lit("0"))
    else:
        def route(batches):
            for b in batches:
                xs, out = b.column("x").to_pylist(), []
                for x in xs:
                    v = np.array(x, float)
                    d = directions(len(x), projections, g * tables)
                    rng = np.random.default_rng([SEED, len(x)]).random(g * tables)
                    q = np.floor((v / np.linalg.norm(v)) @ d / width + rng).astype(int)
                    out.append([f"{t}:" + ",".join(map(str, q[t * g:(t + 1) * g])) for t in range(tables)])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.string()))], names=[*b.schema.names, "cells"])
        schema = f"id long, copies long, label {classes.schema['label'].dataType.simpleString()}, x array<float>, dim int, cells array<string>"
        cells = rows.mapInArrow(route, schema).withColumn("cell", F.explode("cells")).drop("cells")
    sizes = stage(cells.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")), "cells")
    placed = cells.join(sizes, ["label", "dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id", F.lit(SEED)), "blocks").cast("int"))
    pairs = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))

    def compare(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        lo, hi = key[3].as_py(), key[4].as_py()
        block = t.column("block").to_numpy()
        ids, copies = t.column("id").to_numpy(), t.column("copies").to_numpy()
        x = np.array(t.column("x").combine_chunks().flatten(), np.float64).reshape(len(ids), -1)
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        i, j = near_pairs(x[a], x[b], lo == hi, threshold, projections, half_width, recall) if len(a) and len(b) else (a[:0], b[:0])
        i, j = a[i], b[j]
        keep = ids[i] != ids[j]
        i, j = i[keep], j[keep]
        flip = ids[i] > ids[j]
        i, j = np.where(flip, j, i), np.where(flip, i, j)
        return pa.table({"u": ids[i], "v": ids[j], "cu": copies[i], "cv": copies[j]})

    found = pairs.groupBy("label", "dim", "cell", "lo", "hi").applyInArrow(compare, "u long, v long, cu long, cv long")
    return found.distinct() if tables > 1 else found


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98, projections: int = 16, half_width: float = 2.0, recall: float = 0.999,
                    block_rows: int = 1024, cell_rows: int | None = None) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Only vectors of one label that is not NULL are compared. A vector that is NULL, empty, zero
    or holds NULL or non-finite components, or whose id or label is NULL, links with nothing:
    n_links 0, its own component, kept. Equal vectors link (cosine 1). A repeated id is one
    vertex; each of its rows is a row of the result and counts as a copy. Vectors of different length
    do not link. Other columns are ignored; an empty table gives an empty result."""
    src = vectors.select(col(id_col).cast("long").alias("id"), col(label_col).alias("label"), col(vector_col).cast("array<float>").alias("x"))
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
            & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
            & F.exists("x", lambda e: e != 0))
    src = src.withColumn("good", F.coalesce(good, F.lit(False)))
    # -0.0 and 0.0 are one value to grouping and joining
    classes = stage(src.where("good").groupBy("label", "x").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes")
    links = stage(class_links(classes, threshold, projections, half_width, recall, block_rows, cell_rows), "links")
    degree = (links.select(F.col("u").alias("id"), F.col("cv").alias("c")).union(links.select(F.col("v").alias("id"), F.col("cu").alias("c")))
              .groupBy("id").agg(F.sum("c").alias("others")))
    roots = components(links.select("u", "v"))
    per_class = stage(classes.join(degree, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
                      .select("label", "x", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                              F.coalesce("root", "id").alias("component_id")), "verdicts")
    unstage(links)
    hits = src.where("good").join(per_class, ["label", "x"]).select("id", "n_links", "component_id")
    rest = src.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return hits.union(rest).select(F.col("id").alias(id_col), "n_links", "component_id",
                                   F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
