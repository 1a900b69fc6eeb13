"""Isolation forest, globally (J3) or per group such as a snapshot.

The defaults follow the usual isolation forest: 100 trees, each grown on
min(256, n) rows drawn without replacement, depth limit ceil(log2(psi)),
score 2^(-E[h(x)] / c(psi)), and rows flagged when their score is strictly
above the (1 - contamination) quantile of the group's scores.

Every random choice is a whole-number function of the seed, the group, the row's
key and the node (an md5 of the row's key, then quadratic steps modulo a prime), so
the same rows give the same forest in any partitioning, and plain SQL can repeat it.
Path lengths are whole numbers of 2^-20, so sums do not depend on their order.

Spark plan, with no group ever held whole by one task:
  1. the rows with the smallest draws of each group form its pool (at most
     ``pool_rows``; a top-k, cut before the shuffle);
  2. each tree's sample is drawn from the pool and all trees of a group grow together
     (numpy, level by level), as dense heaps of (feature, threshold or path);
  3. rows of groups that have trees are packed into arrays of about ``rows_per_task``,
     meet their group's trees by one join, and walk them together (numpy, level by level);
  4. the flag compares the summed path with its exact quantile by counting.
Groups of up to ``max_samples`` rows are in every tree's sample whole: their rows meet in
one array, many groups' trees grow together, and a row's path is where growing leaves it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.series import materialize, sized_join, stage

EULER_GAMMA = 0.5772156649015329
PRIME = 2147483647
UNIT = 1 << 20          # path lengths are whole numbers of 1 / UNIT
MAX_SAMPLES = 256
POOL_ROWS = 4096
WALK_ROWS = 1000        # rows that walk the trees together
GROWN_ROWS = 4096       # rows of whole groups whose trees grow together


def c_factor(n: int) -> float:
    """Average path length of an unsuccessful search in a BST of n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def leaf_units(max_samples: int = MAX_SAMPLES) -> list[int]:
    """``c_factor`` of 0..max_samples points in whole units."""
    return [math.floor(c_factor(n) * UNIT + 0.5) for n in range(max_samples + 1)]


def _steps(a: np.ndarray, b) -> np.ndarray:
    """Numbers below PRIME from two: two squarings and a product modulo the prime."""
    first = (a + b * 1000003) % PRIME
    second = (first * first + 12345) % PRIME * 48271 % PRIME
    return (second * second + second + 1) % PRIME


def key_text(df: DataFrame, names: Sequence[str]) -> Column:
    """The named columns as one text; timestamps as microseconds."""
    kind = dict(df.dtypes)
    part = {c: F.unix_micros(F.col(c).cast("timestamp")) if kind[c].startswith("timestamp") else F.col(c) for c in names}
    return F.concat_ws("|", *[F.coalesce(part[c].cast("string"), F.lit("")) for c in names])


def _draw(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % PRIME


def row_key(df: DataFrame) -> list[str]:
    """Columns that tell rows apart: the store's insertion number, else entity and time,
    else all columns."""
    for names in (["ingest_ord"], ["symbol", "snapshot_time"]):
        if set(names) <= set(df.columns):
            return names
    return list(df.columns)


def _grow(x: np.ndarray, nan: np.ndarray | None, point: np.ndarray, size: np.ndarray, draw: np.ndarray, depth: np.ndarray,
          units: np.ndarray, heap: int = 0) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Many trees at once, level by level. ``x`` holds the features, one row a feature, missing
    ones and NaN as NaN; ``nan`` says where a NaN is a value (None: nowhere). Tree ``i`` grows on the
    next ``size[i]`` of ``point`` (columns of ``x``) from ``draw[i]`` down to ``depth[i]``.

    Returns each point's path length in its tree and, if ``heap`` (nodes a tree) is given, the
    nodes in heap order, tree after tree: ``f`` (feature, -1 at a leaf or where there is no
    node) and ``v`` (threshold, or the path length of a leaf)."""
    path = np.empty(len(point))
    tree, node = np.arange(len(size)), np.ones(len(size), np.int64)
    f_out, v_out = (np.full(len(size) * heap, -1, np.int32), np.zeros(len(size) * heap)) if heap else (None, None)
    home, d = np.arange(len(point)), 0
    while len(size):
        start = np.cumsum(size) - size
        here = x[:, point]
        lo, hi = np.fmin.reduceat(here, start, axis=1), np.fmax.reduceat(here, start, axis=1)
        if nan is not None:         # NaN ranks above all numbers
            hi[np.logical_or.reduceat(nan[:, point], start, axis=1)] = np.nan
            usable = (hi > lo) | (np.isnan(hi) & ~np.isnan(lo))
        else:
            usable = hi > lo
        usable &= (size > 1) & (d < depth[tree])
        choices = usable.sum(axis=0)
        inner = choices > 0
        r = _steps(draw[tree], node)
        f = np.argmax(np.cumsum(usable, axis=0) > r % np.maximum(choices, 1), axis=0)
        each = np.arange(len(size))
        with np.errstate(all="ignore"):
            v = lo[f, each] + (hi[f, each] - lo[f, each]) * ((_steps(r, 1) + 0.5) / float(PRIME))
        of = np.repeat(each, size)
        end = (d * UNIT + units[size]).astype(float)
        stop = ~inner[of]
        path[home[stop]] = end[of[stop]]
        if heap:
            at = tree * heap + node - 1
            f_out[at[inner]], v_out[at] = f[inner], np.where(inner, v, end)
            for side in (1, 2):      # until points come: an empty leaf
                v_out[(tree * heap + 2 * node - 2 + side)[inner]] = (d + 1) * UNIT + units[0]
        go = np.flatnonzero(~stop)
        value, cut = here[f[of[go]], go], v[of[go]]
        left = value < cut
        if nan is not None:
            left |= np.isnan(cut) & ~np.isnan(value)
        # points stay in order, those of the left child first
        point, home, size, tree, node = point[go], home[go], size[inner], tree[inner], node[inner]
        if not len(size):
            break
        start = np.cumsum(size) - size
        under = np.add.reduceat(left, start, dtype=np.int64)
        before = np.cumsum(left) - left
        before -= np.repeat(before[start], size)
        first = np.repeat(start, size)
        to = np.where(left, first + before, np.arange(len(left)) + np.repeat(under, size) - before)
        moved = np.empty_like(point)
        moved[to] = point
        point, moved = moved, np.empty_like(home)
        moved[to] = home
        home = moved
        size = np.stack((under, size - under), axis=1).ravel()
        tree, node = np.repeat(tree, 2), np.stack((2 * node, 2 * node + 1), axis=1).ravel()
        some = size > 0
        size, tree, node = size[some], tree[some], node[some]
        d += 1
    return path, f_out, v_out


def _depth(n: np.ndarray) -> np.ndarray:
    """Levels of a tree over so many points: ceil(log2(n))."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def _features(lists: pa.Array, n_cols: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, null) of points whose features stand one after another, one row a feature."""
    flat = lists.flatten()
    x = np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, n_cols).T)
    return x, np.ascontiguousarray(flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, n_cols).T)


def _nan_values(x: np.ndarray, null: np.ndarray) -> np.ndarray | None:
    nan = np.isnan(x) & ~null
    return nan if nan.any() else None


def _sample_trees(pools: DataFrame, n_cols: int, n_trees: int, max_samples: int) -> DataFrame:
    """``_g, _n, _f, _v`` of ``_g, _n, _gd, _d, _x``: each tree grows on the ``max_samples`` points
    of the pool that its own draw puts first."""
    schema = T.StructType([pools.schema["_g"], pools.schema["_n"], T.StructField("_f", T.ArrayType(T.IntegerType())),
                           T.StructField("_v", T.ArrayType(T.DoubleType()))])

    def run(batches):
        units, tree = np.array(leaf_units(max_samples)), np.arange(n_trees)
        for b in batches:
            for i in range(b.num_rows):
                x, null = _features(b.column("_x").slice(i, 1), n_cols)
                psi = min(max_samples, b.column("_n")[i].as_py())
                d = b.column("_d").slice(i, 1).flatten().to_numpy()
                picked = [np.argsort(_steps(d, t), kind="stable")[:psi] if len(d) > psi else np.arange(len(d)) for t in tree]
                depth = int(_depth(np.array(psi)))
                _, f, v = _grow(x, _nan_values(x, null), np.concatenate(picked), np.array([len(p) for p in picked]),
                                _steps(np.int64(b.column("_gd")[i].as_py()), tree), np.full(n_trees, depth), units, (2 << depth) - 1)
                yield pa.RecordBatch.from_arrays([b.column("_g").slice(i, 1), b.column("_n").slice(i, 1), pa.array([f]), pa.array([v])], names=schema.names)

    return pools.mapInArrow(run, schema)


def _whole_paths(n_cols: int, n_trees: int, max_samples: int):
    """A function of (features of a group's rows, one after another; the group's draw): the
    rows' summed path lengths. For groups of up to ``max_samples`` rows, where every tree
    grows on all rows, so each row's path is where growing leaves it."""
    @F.arrow_udf("array<double>")
    def paths(features: pa.Array, draws: pa.Array) -> pa.Array:
        units, tree = np.array(leaf_units(max_samples)), np.arange(n_trees)
        n = features.value_lengths().to_numpy() // n_cols
        ends, out, lo = np.cumsum(n), [], 0
        gd = draws.to_numpy()
        while lo < len(n):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + GROWN_ROWS, "right")))
            x, null = _features(features.slice(lo, hi - lo), n_cols)
            rows = n[lo:hi]
            start = np.cumsum(rows) - rows
            of = np.repeat(np.arange(len(rows)), rows)
            for c in np.flatnonzero(null.any(axis=1)):      # missing: the group's median, as ``percentile``
                order = np.lexsort((x[c], of))
                known = rows - np.add.reduceat(np.isnan(x[c]), start, dtype=np.int64)
                ranked, pos = x[c][order], 0.5 * (known - 1)
                a, z = (ranked[start + np.clip(at(pos).astype(np.int64), 0, None)] for at in (np.floor, np.ceil))
                med = np.where(a == z, a, 0.5 * a + 0.5 * z)
                fill = null[c] & (known > 0)[of]
                x[c][fill], null[c][fill] = med[of[fill]], False
            size = np.repeat(rows, n_trees)
            first = np.repeat(np.repeat(start, n_trees) - (np.cumsum(size) - size), size)
            path, _, _ = _grow(x, _nan_values(x, null), first + np.arange(len(first)), size,
                               _steps(np.repeat(gd[lo:hi], n_trees), np.tile(tree, len(rows))), np.repeat(_depth(rows), n_trees), units)
            out.append(np.bincount(first + np.arange(len(first)), path, len(of)))
            lo = hi
        total = np.concatenate(out) if out else np.empty(0)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(total))
    return paths


def _paths(x: np.ndarray, f: np.ndarray, v: np.ndarray, n_trees: int) -> np.ndarray:
    """Summed path lengths (units) of the rows ``x`` (missing features NaN) in all the trees
    (``f`` and ``v`` of the nodes, tree after tree). Missing goes right; NaN ranks above
    all numbers, as in SQL."""
    size = len(f) // n_trees
    at = np.arange(len(f))
    heap = at % size
    inner = f >= 0
    odd = np.isnan(v) & inner
    cut = np.where(inner, v, -np.inf)               # a leaf sends every row right, to itself
    right = np.where(inner, at + heap + 2, at)
    f = np.maximum(f, 0)
    out = np.empty(len(x))
    for s in range(0, len(x), WALK_ROWS):
        part = np.ascontiguousarray(x[s:s + WALK_ROWS])
        first = (np.arange(len(part)) * part.shape[1])[:, None]
        node = np.tile(np.arange(n_trees) * size, (len(part), 1))
        for _ in range(size.bit_length() - 1):
            value = part.ravel()[first + f[node]]
            left = value < cut[node]
            if odd.any():
                left |= odd[node] & ~np.isnan(value)
            node = right[node] - left
        out[s:s + WALK_ROWS] = v[node].sum(axis=1)
    return out


def _walked(rows: DataFrame, n_trees: int) -> DataFrame:
    """``row, _n, path`` of ``row, _n, x, first, f, v``; the trees stand at the first row of
    each pack and hold for the rows after it."""
    schema = T.StructType([rows.schema["row"], rows.schema["_n"], T.StructField("path", T.DoubleType())])

    def run(batches):
        trees = None
        for b in batches:
            if not b.num_rows:
                continue
            heads = np.flatnonzero(b.column("first").to_numpy(zero_copy_only=False))
            ends = np.append(heads, b.num_rows)
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            path = np.empty(b.num_rows)
            if ends[0] > 0:
                path[:ends[0]] = _paths(x[:ends[0]], *trees, n_trees)
            for lo, hi in zip(heads, ends[1:]):
                trees = [b.column(c)[int(lo)].values.to_numpy(zero_copy_only=False) for c in ("f", "v")]
                path[lo:hi] = _paths(x[lo:hi], *trees, n_trees)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("_n"), pa.array(path)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Over all shuffle partitions: few bytes, but much work a row, so partitions must not
    be merged by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _filled(base: DataFrame, cols: Sequence[str], group: str | None, accuracy: int | None) -> DataFrame:
    """``_x``: the features as doubles, missing ones as the median (of the group)."""
    if group is None:
        from tidemark.operators.stats import quantile_table
        med = quantile_table(base, {c: [0.5] for c in cols}, accuracy)
        return base.withColumn("_x", F.array(*[F.coalesce(F.col(c).cast("double"), med[(c, 0.5)]) for c in cols]))
    from tidemark.operators.stats import grouped_quantiles
    meds = grouped_quantiles(base, group, {c: [0.5] for c in cols}).select(
        F.col(group).alias("_mg"), *[F.col(f"_q_{c}_0").alias(f"_m_{i}") for i, c in enumerate(cols)])
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.col(f"_m_{i}")) for i, c in enumerate(cols)])
    return base.join(meds, F.col(group).eqNullSafe(F.col("_mg")), "left").select(*base.columns, x.alias("_x"))


def forests(df: DataFrame, cols: Sequence[str], group: str | None = None, key: Sequence[str] | None = None, n_trees: int = 100,
            max_samples: int = MAX_SAMPLES, seed: int = 42, pool_rows: int = POOL_ROWS, min_rows: int = 0) -> DataFrame:
    """One row per group of ``df`` (with ``_x``): ``_g, _n, _f, _v``, the trees' nodes."""
    gtext = key_text(df, [group]) if group else F.lit("")
    g = F.col(group) if group else F.lit(0)
    rows = df.select(g.alias("_g"), gtext.alias("_gt"), key_text(df, key or row_key(df)).alias("_k"), "_x")
    rows = rows.withColumn("_d", _draw(F.concat(F.lit(f"{seed}|"), "_k")))
    counts = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.first("_gt").alias("_gt")).where(F.col("_n") >= max(1, min_rows))
    first = Window.partitionBy("_g").orderBy("_d", "_k")
    pool = (rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= max(pool_rows, max_samples))
            .groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("_d", "_k", "_x"))).alias("_pool")))
    both = pool.withColumnRenamed("_g", "_pg").join(counts, F.col("_pg").eqNullSafe(F.col("_g"))).drop("_pg")
    both = both.select("_g", "_n", _draw(F.concat(F.lit(f"{seed}|"), "_gt")).alias("_gd"), F.transform("_pool", lambda p: p["_d"]).alias("_d"),
                       F.flatten(F.transform("_pool", lambda p: p["_x"])).alias("_x"))
    return _sample_trees(_spread(both, "_g"), len(cols), n_trees, max_samples)


def isolation_forest_scores(df: DataFrame, cols: Sequence[str], group: str | None = None, n_trees: int = 100,
                            max_samples: int = MAX_SAMPLES, seed: int = 42, rows_per_task: int = 1000,
                            accuracy: int | None = None, key: Sequence[str] | None = None,
                            pool_rows: int = POOL_ROWS, min_rows: int = 0, checkpoint: bool = True) -> DataFrame:
    """Add ``_if_score`` (higher = more isolated) and ``_if_path`` (the summed path, in
    units) to every row; NULL in groups under ``min_rows``.

    Missing feature values are filled with the median (of the group when ``group`` is
    given), as the reference does before fitting; a value still NULL goes right at every
    node. ``key`` names the columns that tell rows apart (:func:`row_key`); rows that share
    a key share its draw. ``rows_per_task`` rows are scored with one copy of their
    group's trees and changes no result. ``checkpoint=False`` if ``df`` is written rows already."""
    parts = _scored(df, cols, group, n_trees, max_samples, seed, rows_per_task, accuracy, key, pool_rows, min_rows, checkpoint)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.drop("_if_thr")


def _scored(df: DataFrame, cols: Sequence[str], group: str | None, n_trees: int = 100, max_samples: int = MAX_SAMPLES, seed: int = 42,
            rows_per_task: int = 1000, accuracy: int | None = None, key: Sequence[str] | None = None, pool_rows: int = POOL_ROWS,
            min_rows: int = 0, checkpoint: bool = True, contamination: float | None = None) -> list[DataFrame]:
    """The rows with ``_if_score``, ``_if_path`` and ``_if_thr`` (the ``contamination`` quantile of the
    group's paths), by size of their groups: under ``min_rows`` (all NULL), up to
    ``max_samples`` (each group grown and scored in one place), larger."""
    names = df.columns
    # several passes follow: the rows behind them are worked out once
    df = stage(df, checkpoint)
    none = F.lit(None).cast("double")
    blank = [none.alias("_if_score"), none.alias("_if_path"), none.alias("_if_thr")]
    if group is None:
        return [_large(df, cols, None, n_trees, max_samples, seed, rows_per_task, accuracy, key, pool_rows, min_rows, None)]
    sizes = materialize(df.groupBy(F.col(group).alias("_lg")).agg(F.count(F.lit(1)).alias("_ln")).where(F.col("_ln") >= max(1, min_rows)))
    n_whole, n_large = sizes.agg(F.count_if(F.col("_ln") <= max_samples), F.count_if(F.col("_ln") > max_samples)).head()
    if not n_whole + n_large:
        return [df.select(*names, *blank)]
    of_group = F.col(group).eqNullSafe(F.col("_lg"))
    out = []
    if min_rows > 1:
        out.append(df.join(sizes, of_group, "left_anti").select(*names, *blank))
    if n_whole:
        rows = sized_join(df, sizes.where(F.col("_ln") <= max_samples), of_group)
        rows = _spread(rows, "_lg").groupBy("_lg", "_ln").agg(F.collect_list(F.struct(*names)).alias("_rows")).withColumnRenamed("_lg", group)
        features = F.flatten(F.transform("_rows", lambda r: F.array(*[r[c].cast("double") for c in cols])))
        draw = _draw(F.concat(F.lit(f"{seed}|"), key_text(rows, [group])))
        rows = rows.withColumn("_p", _whole_paths(len(cols), n_trees, max_samples)(features, draw))
        rows = rows.select("_ln", _array_quantile("_p", contamination).alias("_if_thr"), F.explode(F.arrays_zip("_rows", "_p")).alias("_e"))
        out.append(rows.select(*[F.col(f"_e._rows.`{c}`").alias(c) for c in names], _score(F.col("_e._p"), F.col("_ln"), n_trees, max_samples).alias("_if_score"),
                               F.col("_e._p").alias("_if_path"), "_if_thr"))
    if n_large:
        rows = df.join(sizes.where(F.col("_ln") > max_samples), of_group, "left_semi")
        out.append(_large(rows, cols, group, n_trees, max_samples, seed, rows_per_task, accuracy, key, pool_rows, min_rows, contamination))
    return out


def _array_quantile(c: str, p: float | None) -> Column:
    """The quantile of an array of numbers, interpolated as ``percentile`` does."""
    if p is None:
        return F.lit(None).cast("double")
    pos = F.lit(float(p)) * (F.size(c) - 1)
    a, z = (F.element_at(F.array_sort(c), (at(pos) + 1).cast("int")) for at in (F.floor, F.ceil))
    return F.when(a == z, a).otherwise((F.ceil(pos) - pos) * a + (pos - F.floor(pos)) * z)


def _score(path: Column, n: Column, n_trees: int, max_samples: int) -> Column:
    mean = F.expr("array(" + ", ".join(f"{c_factor(k) or 1.0!r}D" for k in range(max_samples + 1)) + ")")[F.least(F.lit(max_samples), n).cast("int")]
    return F.pow(F.lit(2.0), -(path / (UNIT * n_trees)) / mean)


def _large(df: DataFrame, cols: Sequence[str], group: str | None, n_trees: int, max_samples: int, seed: int, rows_per_task: int,
           accuracy: int | None, key: Sequence[str] | None, pool_rows: int, min_rows: int, contamination: float | None) -> DataFrame:
    names = df.columns
    base = _filled(df, cols, group, accuracy)
    grown = materialize(forests(base, cols, group, key, n_trees, max_samples, seed, pool_rows, min_rows))
    g = F.col(group) if group else F.lit(0)
    rows = base.select(g.alias("_rg"), _draw(F.concat(F.lit(f"{seed}|"), key_text(base, key or row_key(base)))).alias("_d"),
                       F.struct(*names).alias("row"), F.col("_x").alias("x"))
    sizes = grown.select(F.col("_g").alias("_sg"), (F.col("_n") / rows_per_task).cast("bigint").alias("_parts"))
    parts = sized_join(rows, sizes, F.col("_rg").eqNullSafe(F.col("_sg"))).select(
        "_rg", (F.col("_d") % (F.col("_parts") + 1)).alias("_part"), F.struct("row", "x").alias("r"))
    packed = _spread(parts, "_rg", "_part").groupBy("_rg", "_part").agg(F.collect_list("r").alias("_rows"))
    # one forest without groups: its join has no key, so it must not become a product of partitions
    met = packed.join(grown if group else F.broadcast(grown), F.col("_rg").eqNullSafe(F.col("_g")))
    # the trees stand at a pack's first row only
    once = lambda i, c: F.when(i == 0, F.col(c)).alias(c[1:])
    each = met.select("_n", F.explode(F.transform("_rows", lambda r, i: F.struct(
        r["row"].alias("row"), r["x"].alias("x"), (i == 0).alias("first"), once(i, "_f"), once(i, "_v")))).alias("e"))
    scored = _walked(each.select("e.row", "_n", "e.x", "e.first", "e.f", "e.v"), n_trees)
    out = scored.select(*[F.col(f"row.`{c}`").alias(c) for c in names], _score(F.col("path"), F.col("_n"), n_trees, max_samples).alias("_if_score"),
                        F.col("path").alias("_if_path"))
    if contamination is None:
        return out.withColumn("_if_thr", F.lit(None).cast("double"))
    from tidemark.operators.stats import grouped_quantiles
    out = materialize(out)
    thr = grouped_quantiles(out, group, {"_if_path": [contamination]}).select(F.col(group).alias("_tg"), F.col("_q__if_path_0").alias("_if_thr"))
    return out.join(thr, F.col(group).eqNullSafe(F.col("_tg")), "left").drop("_tg")


def isolation_forest_flags(df: DataFrame, cols: Sequence[str], group: str | None = None,
                           contamination: float = 0.03, seed: int = 42, min_rows: int = 0,
                           flag: str = "is_isolation_forest_anomaly", accuracy: int | None = None,
                           **kw) -> DataFrame:
    """Flag rows whose score is above the group's (1 - contamination)
    quantile (J3 with ``group=None``, J10 with ``group="snapshot_time"``).
    Groups smaller than ``min_rows`` are never flagged.

    A high score is a short path, so the test is path < its ``contamination``
    quantile: the same rows, in whole numbers."""
    if group is None:
        from tidemark.operators.stats import global_quantiles
        scored = materialize(isolation_forest_scores(df, cols, group, seed=seed, accuracy=accuracy, min_rows=min_rows, **kw))
        thr = global_quantiles(scored, "_if_path", [contamination], accuracy)[0]
        return scored.withColumn(flag, F.coalesce(F.col("_if_path") < thr, F.lit(False))).drop("_if_score", "_if_path")
    parts = _scored(df, cols, group, seed=seed, accuracy=accuracy, min_rows=min_rows, contamination=contamination, **kw)
    parts = [p.withColumn(flag, F.coalesce(F.col("_if_path") < F.col("_if_thr"), F.lit(False))).select(*df.columns, flag) for p in parts]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return materialize(out) if len(parts) > 1 or kw.get("checkpoint", True) else out
