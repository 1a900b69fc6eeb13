"""Local Outlier Factor per group (snapshot), exact, without all pairs.

Definition (the usual LOF): k = min(k_max, n - 1) neighbours excluding the
point itself (ties broken by key), Euclidean distance on the raw columns
(missing values filled with the group median), reach(q, o) = max(d(q, o),
kdist(o)), lrd(q) = 1 / (mean reach + 1e-10), lof(q) = mean over neighbours
of lrd(o) / lrd(q). A row is flagged when its lof is strictly above the
group's (1 - contamination) quantile; groups under ``min_rows`` rows are never
flagged.

Exact k-nearest neighbours without comparing all pairs:
  1. rows are ordered within the group by one column (``sort_col``; by default the
     one of largest standard deviation) and cut
     into blocks of ``block_rows`` consecutive rows (``group_rank`` splits
     hot groups); each block's rows become one array, with its value range;
  2. the k nearest rows in that order (a window of ±k rows) give every point
     an upper bound r on its k-distance;
  3. any true neighbour lies within r on ``sort_col``, so only blocks whose
     range meets [x - r, x + r] are scanned (a contiguous run of blocks);
     each (point, block) pair keeps its candidates within r, and the k best
     over all scanned blocks are the exact neighbours.
Blocks hold max(block_rows, sqrt(n)) rows, so per point the block-range
lookup and the scan of the blocks touched cost O(sqrt n); memory per task is
one block.

A group of up to ``WHOLE_ROWS`` rows is small enough to be compared whole: its points meet
in one array and numpy does steps 2 and 3 at once (same definition, same neighbours).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import group_rank, materialize, sized_join
from tidemark.operators.stats import grouped_quantiles

LOF_EPS = 1e-10
WHOLE_ROWS = 256        # rows of a group whose points are compared all together


def _dist(a: Sequence[Column], b: Sequence[Column]) -> Column:
    s = None
    for x, y in zip(a, b):
        t = (x - y) * (x - y)
        s = t if s is None else s + t
    return F.sqrt(s)


def _whole(x: np.ndarray, k_max: int) -> np.ndarray:
    """LOF of the points ``x`` (one a row, in key order)."""
    k = min(k_max, len(x) - 1)
    d = np.zeros((len(x), len(x)))
    for c in x.T:
        d += (c[:, None] - c) ** 2
    d = np.sqrt(d)
    np.fill_diagonal(d, np.nan)             # last in order
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    d = np.take_along_axis(d, near, axis=1)
    total = lambda a: np.add.accumulate(a, axis=1)[:, -1]  # noqa: E731  (one after another, as SQL adds)
    lrd = 1.0 / (total(np.maximum(d, d[near, -1])) / k + LOF_EPS)
    return total(lrd[near] / lrd[:, None]) / k


def _whole_scores(n_cols: int, k_max: int, min_rows: int):
    """A function of the features of a group's points, one after another in key order: the points' scores."""
    @F.arrow_udf("array<double>")
    def scores(features: pa.Array) -> pa.Array:
        n = features.value_lengths().to_numpy() // n_cols
        every = features.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n_cols)
        ends = np.cumsum(n)
        out = np.full(len(every), np.nan)
        for lo, hi in zip(ends - n, ends):
            x = every[lo:hi]
            missing = np.isnan(x)
            if missing.any():
                for c in np.flatnonzero(missing.any(axis=0) & ~missing.all(axis=0)):    # the group's median
                    known = np.sort(x[~missing[:, c], c])
                    a, z = known[(len(known) - 1) // 2], known[len(known) // 2]
                    x[missing[:, c], c] = a if a == z else 0.5 * a + 0.5 * z
                ok = ~np.isnan(x).any(axis=1)
            else:
                ok = slice(None)
            if len(x[ok]) >= min_rows:
                out[lo:hi][ok] = _whole(x[ok], k_max)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(out, mask=np.isnan(out)))
    return scores


def lof_scores(df: DataFrame, cols: Sequence[str], group: str = "snapshot_time", key: str = "symbol",
               k_max: int = 20, min_rows: int = 10, block_rows: int = 1024, sort_col: str | None = None,
               accuracy: int | None = None) -> DataFrame:
    """Add ``lof_score`` (NULL for groups under ``min_rows``)."""
    # the neighbour search reads its input several times: write the narrow
    # projection once instead of re-running the input's plan for each pass
    lof = _lof(materialize(df.select(group, key, *cols)), list(cols), group, key, k_max, min_rows, block_rows, sort_col)
    return df.withColumn("lof_score", F.lit(None).cast("double")) if lof is None else df.join(lof, [group, key], "left")


def _lof(src: DataFrame, cols: list[str], group: str, key: str, k_max: int, min_rows: int, block_rows: int,
         sort_col: str | None) -> DataFrame | None:
    """``group, key, lof_score`` of the points with a score; None if no group has the rows for one."""
    # NULL keys and groups match nothing
    sizes = materialize(src.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("_gn"), F.count_if(F.col(key).isNull()).alias("_gk"),
        F.count_if(F.greatest(*[F.coalesce(F.abs(F.col(c).cast("double")), F.lit(0.0)) for c in cols]) > 1e150).alias("_go"))
        .where(F.col("_gn") >= max(2, min_rows)))
    whole = (F.col("_gn") <= WHOLE_ROWS) & (F.col("_gk") == 0) & (F.col("_go") == 0)      # NaN is above all numbers
    n_whole, n_other = sizes.agg(F.count_if(whole), F.count_if(~whole)).head()
    parts = []
    if n_whole:
        rows = sized_join(src, sizes.where(whole).select(group), group)
        rows = rows.repartition(int(src.sparkSession.conf.get("spark.sql.shuffle.partitions")), group)
        point = F.struct(F.col(key).alias("k"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
        rows = materialize(rows.groupBy(group).agg(F.sort_array(F.collect_list(point)).alias("_pts")))
        twice = F.size(F.array_distinct(F.col("_pts.k"))) < F.size("_pts")
        again = rows.where(twice).select(group)
        if again.count():       # a key's rows count as one point there
            n_other += 1
            sizes = sizes.join(again.withColumn("_ga", F.lit(1)), group, "left")
            whole = whole & F.col("_ga").isNull()
        rows = rows.where(~twice).withColumn("_s", _whole_scores(len(cols), k_max, min_rows)(F.flatten("_pts.x")))
        rows = rows.select(group, F.explode(F.arrays_zip(F.col("_pts.k").alias("k"), F.col("_s").alias("s"))).alias("_e"))
        parts.append(rows.select(group, F.col("_e.k").alias(key), F.col("_e.s").alias("lof_score")).where("lof_score is not null"))
    if n_other:
        rows = sized_join(src, sizes.where(~whole).select(group), group) if n_whole else src
        parts.append(_blocked(rows, cols, group, key, k_max, min_rows, block_rows, sort_col))
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])) if parts else None


def _blocked(src: DataFrame, cols: list[str], group: str, key: str, k_max: int, min_rows: int, block_rows: int,
             sort_col: str | None) -> DataFrame:
    """``group, key, lof_score`` of groups of any size, block by block."""
    # a block must hold k + 1 rows so the in-block bound sees k other points
    block_rows = max(block_rows, k_max + 1)
    feat = [f"_x{i}" for i in range(len(cols))]
    if sort_col is None:
        # the column that rules the distances prunes best
        spread = src.agg(*[F.coalesce(F.stddev_pop(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in cols]).head()
        sort_col = max(cols, key=lambda c: (spread[c], -cols.index(c)))
    meds = grouped_quantiles(src, group, {c: [0.5] for c in cols}).select(
        group, *[F.col(f"_q_{c}_0").alias(f"_m{i}") for i, c in enumerate(cols)])
    base = sized_join(src, materialize(meds), group, "left")
    base = base.withColumns({f: F.coalesce(F.col(c).cast("double"), F.col(f"_m{i}"))
                             for i, (f, c) in enumerate(zip(feat, cols))})
    # a column missing in a whole group stays NULL after the fill: such rows
    # have no distance, so they take no part (score NULL, never flagged)
    valid = None
    for f in feat:
        valid = F.col(f).isNotNull() if valid is None else (valid & F.col(f).isNotNull())
    sx = f"_x{cols.index(sort_col)}"
    pts = base.filter(valid).select(group, key, *feat)
    counts = materialize(pts.groupBy(group).agg(F.count(F.lit(1)).alias("_n")))
    pts = sized_join(pts, counts, group).withColumn("_k", F.least(F.lit(k_max), F.col("_n") - 1))
    pts = pts.filter(F.col("_n") >= min_rows)
    pts = group_rank(pts, group, sx, descending=False, name="_pos", tiebreak=[key])
    # rows per block: at least ``block_rows`` and sqrt(n), so both the block
    # range lookup and the block scan cost O(sqrt n) per point in a huge group
    bsz = F.greatest(F.lit(block_rows), F.ceil(F.sqrt(F.col("_n").cast("double"))))
    last_block = F.greatest(F.floor(F.col("_n") / bsz) - 1, F.lit(0))
    pts = pts.withColumn("_blk", F.least(F.floor((F.col("_pos") - 1) / bsz), last_block))

    # 2. upper bound on the k-distance from the ±k rows in sort order (within the block)
    me = [F.col(f) for f in feat]
    w = Window.partitionBy(group, "_blk").orderBy("_pos").rowsBetween(-k_max, k_max)
    near = F.collect_list(F.struct(F.col(key).alias("k"), *[F.col(f).alias(f) for f in feat])).over(w)
    cand_d = F.transform(F.filter(near, lambda o: o["k"] != F.col(key)),
                         lambda o: _dist([o[f] for f in feat], me))
    pts = pts.withColumn("_r", F.element_at(F.array_sort(cand_d), F.col("_k").cast("int")))

    # 1. blocks as arrays with their value range, and per group the block maxima
    blocks = materialize(pts.groupBy(group, "_blk").agg(
        F.collect_list(F.struct(F.col(key).alias("k"), *[F.col(f).alias(f) for f in feat])).alias("_pts"),
        F.min(sx).alias("_lo"), F.max(sx).alias("_hi")))
    bounds = blocks.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_blk", "_lo", "_hi"))).alias("_bb"))
    q = sized_join(pts, materialize(bounds), group, "left")
    lo_v, hi_v = F.col(sx) - F.col("_r"), F.col(sx) + F.col("_r")
    b_lo = F.size(F.filter("_bb", lambda b: b["_hi"] < lo_v))
    b_hi = F.size(F.filter("_bb", lambda b: b["_lo"] <= hi_v)) - 1
    q = q.withColumn("_scan", F.explode(F.sequence(b_lo, b_hi))).drop("_bb")

    # 3. candidates within r in each scanned block; the k best are the neighbours
    blk = blocks.select(F.col(group).alias("_g2"), F.col("_blk").alias("_scan2"), "_pts")
    qb = q.join(blk, (F.col(group) == F.col("_g2")) & (F.col("_scan") == F.col("_scan2")))
    cands = F.filter(F.transform("_pts", lambda o: F.struct(_dist([o[f] for f in feat], me).alias("d"),
                                                            o["k"].alias("o"))),
                     lambda c: (c["o"] != F.col(key)) & (c["d"] <= F.col("_r")))
    qb = qb.select(group, key, "_k", cands.alias("_c"))
    nb = (qb.groupBy(group, key, "_k").agg(F.flatten(F.collect_list("_c")).alias("_c"))
          .select(group, key, F.slice(F.array_sort("_c"), 1, F.col("_k").cast("int")).alias("_nb")))
    nb = materialize(nb)
    kd = nb.select(F.col(group).alias("_g2"), F.col(key).alias("_o2"),
                   F.element_at("_nb", -1)["d"].alias("_kdist"))

    pairs = nb.select(group, key, F.explode("_nb").alias("_e")).select(
        group, key, F.col("_e")["o"].alias("_o"), F.col("_e")["d"].alias("_d"))
    reach = pairs.join(kd, (F.col(group) == F.col("_g2")) & (F.col("_o") == F.col("_o2")))
    lrd = materialize(reach.groupBy(group, key).agg(
        (F.lit(1.0) / (F.avg(F.greatest("_d", "_kdist")) + F.lit(LOF_EPS))).alias("_lrd")))
    lrd_o = lrd.select(F.col(group).alias("_g2"), F.col(key).alias("_o2"), F.col("_lrd").alias("_lrd_o"))
    ratios = (pairs.join(lrd, [group, key])
              .join(lrd_o, (F.col(group) == F.col("_g2")) & (F.col("_o") == F.col("_o2"))))
    return ratios.groupBy(group, key).agg(F.avg(F.col("_lrd_o") / F.col("_lrd")).alias("lof_score"))


def lof_flags(df: DataFrame, cols: Sequence[str], group: str = "snapshot_time", key: str = "symbol",
              contamination: float = 0.03, flag: str = "is_lof_anomaly", keep_score: bool = False,
              accuracy: int | None = None, k_max: int = 20, min_rows: int = 10, block_rows: int = 1024,
              sort_col: str | None = None) -> DataFrame:
    q = 1.0 - contamination
    src = materialize(df.select(group, key, *cols))
    lof = _lof(src, list(cols), group, key, k_max, min_rows, block_rows, sort_col)
    if lof is None:
        out = df.withColumns({"lof_score": F.lit(None).cast("double"), flag: F.lit(False)})
        return out if keep_score else out.drop("lof_score")
    lof = materialize(lof)
    # the quantile counts rows, the score stands once a key
    scored = src.select(group, key).join(lof, [group, key])
    if accuracy is None:
        thr = grouped_quantiles(scored, group, {"lof_score": [q]}).withColumnRenamed("_q_lof_score_0", "_thr")
    else:
        thr = scored.groupBy(group).agg(F.percentile_approx("lof_score", F.lit(q), accuracy).alias("_thr"))
    flagged = lof.join(thr, group).select(group, key, "lof_score", (F.col("lof_score") > F.col("_thr")).alias(flag))
    out = df.join(flagged, [group, key], "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out if keep_score else out.drop("lof_score")
