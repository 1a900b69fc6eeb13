"""Feature set: calendar fields, per-entity returns and rolling statistics,
cross-sectional market structure (M1 = I1-I4 → E1-E14 → F1-F5).

Per-entity features are row-based frames (the reference counts rows, not
time), computed on chunked entity histories (``series.with_entity_windows``)
so one long history never sits in one task. Cross-sectional features are
grouped aggregates per snapshot joined back, plus a range-partitioned rank.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import pct_change, safe_div
from tidemark.operators.series import (DEFAULT_CHUNK_ROWS, group_rank, materialize, sized_join,
                                       stage, with_entity_windows)
from tidemark.operators.stats import grouped_quantiles

# Rolling windows (rows), lag lengths at 30-minute cadence,
# EMA span, momentum weights.
ROLLING_WINDOWS = (3, 6, 12, 24)
HOURLY_LAG, DAILY_LAG, WEEKLY_LAG = 2, 48, 336
EMA_SPAN = 12
EMA_TERMS = 256  # (1 - 2/13)^256 ≈ 3e-19: the truncated recursion equals the full one in doubles
MOMENTUM_WEIGHTS = (0.4, 0.6)
FEATURE_LOOKBACK = max(WEEKLY_LAG, EMA_TERMS - 1, 24 + HOURLY_LAG)


# --------------------------------------------------------------------------- I1-I4
def add_timestamp_features(df: DataFrame, ts_col: str = "snapshot_time") -> DataFrame:
    """hour, day, ISO week, month, quarter, year, weekday name, weekend
    (Mon=0 numbering: 5, 6), business hour (9 <= hour <= 17)."""
    ts = F.col(ts_col)
    return df.withColumns({
        "hour": F.hour(ts), "day": F.dayofmonth(ts), "week": F.weekofyear(ts),
        "month": F.month(ts), "quarter": F.quarter(ts), "year": F.year(ts),
        "weekday": F.date_format(ts, "EEEE"),
        "is_weekend": F.weekday(ts).isin(5, 6),
        "is_business_hour": F.hour(ts).between(9, 17),
    })


# --------------------------------------------------------------------------- E1-E14
def ema_expr(c: str, w: Window, span: int = EMA_SPAN, terms: int = EMA_TERMS) -> Column:
    """EMA with adjust=False, y0 = x0, y = (1-a) y_prev + a x, a = 2/(span+1),
    folded over the last ``terms`` rows (JVM-side, bounded memory)."""
    alpha = 2.0 / (span + 1.0)
    keep = 1.0 - alpha
    arr = F.collect_list(F.col(c)).over(w.rowsBetween(-(terms - 1), 0))
    return F.aggregate(F.slice(arr, 2, terms), arr[0],
                       lambda acc, x: acc * F.lit(keep) + x * F.lit(alpha))


def rolling_medians(c: Column, w: Window, windows: Sequence[int]) -> Column:
    """An array of the medians of the last 3, 6, ... (``windows``) values, interpolated as
    ``percentile`` does: each row's longest frame is collected once and a batch of rows is
    sorted together (a ``percentile`` a frame fills a table of counts for every row)."""
    longest = max(windows)

    @F.arrow_udf("array<double>")
    def medians(last: pa.Array) -> pa.Array:
        size = last.value_lengths().to_numpy()
        flat = last.flatten()       # one struct a value, so missing values keep their place
        if pa.types.is_struct(flat.type):
            flat = flat.field(0)
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + longest - size[row]
        x, known = np.full((len(size), longest), np.nan), np.zeros((len(size), longest), bool)
        x[row, at], known[row, at] = flat.to_numpy(zero_copy_only=False).astype(float), flat.is_valid().to_numpy(zero_copy_only=False)
        out, null, each = np.empty((len(size), len(windows))), np.empty((len(size), len(windows)), bool), np.arange(len(size))
        for i, n in enumerate(windows):
            ranked, m = np.sort(x[:, longest - n:], axis=1), known[:, longest - n:].sum(axis=1)
            a, z = ranked[each, np.maximum(m - 1, 0) // 2], ranked[each, np.minimum(m // 2, n - 1)]
            with np.errstate(invalid="ignore"):
                out[:, i], null[:, i] = np.where(a == z, a, 0.5 * a + 0.5 * z), m == 0
        return pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * len(windows), pa.int32()), pa.array(out.ravel(), mask=null.ravel()))
    return medians(F.collect_list(F.struct(c.cast("double").alias("v"))).over(w.rowsBetween(-(longest - 1), 0)))


def _return_columns(frame: DataFrame, w: Window, price: str, time: str,
                    windows: Sequence[int]) -> DataFrame:
    p = F.col(price)
    lag1 = F.lag(p, 1).over(w)
    lag2 = F.lag(p, 2).over(w)
    out = frame.withColumns({
        "hourly_return": pct_change(p, F.lag(p, HOURLY_LAG).over(w)),
        "daily_return": pct_change(p, F.lag(p, DAILY_LAG).over(w)),
        "weekly_return": pct_change(p, F.lag(p, WEEKLY_LAG).over(w)),
    })
    if windows:
        out = out.withColumn("_medians", rolling_medians(p, w, windows))
    cols = {}
    for n in windows:
        fr = w.rowsBetween(-(n - 1), 0)
        cols[f"rolling_mean_{n}"] = F.avg(p).over(fr)
        cols[f"rolling_median_{n}"] = F.col("_medians")[list(windows).index(n)]
        cols[f"rolling_std_{n}"] = F.stddev_samp(p).over(fr)
    cols["moving_average_12"] = F.avg(p).over(w.rowsBetween(-11, 0))
    cols["ema_12"] = ema_expr(price, w)
    cols["price_momentum"] = p - lag1
    cols["price_acceleration"] = (p - lag1) - (lag1 - lag2)
    dt = (F.unix_micros(F.col(time).cast("timestamp")) -
          F.unix_micros(F.lag(F.col(time), 1).over(w).cast("timestamp"))) / F.lit(1e6)
    cols["price_change_velocity"] = safe_div(p - lag1, F.nullif(dt, F.lit(0.0)))
    if "volume_24h" in frame.columns:
        cols["volume_growth"] = pct_change("volume_24h", F.lag("volume_24h", 1).over(w))
    if "market_cap" in frame.columns:
        cols["market_cap_growth"] = pct_change("market_cap", F.lag("market_cap", 1).over(w))
    out = out.withColumns(cols).drop("_medians")
    hr = F.col("hourly_return")
    w24 = w.rowsBetween(-23, 0)
    daily = F.col("daily_return")
    out = out.withColumns({
        "volatility": F.stddev_samp(hr).over(w.rowsBetween(-11, 0)),
        "rolling_volatility_24": F.stddev_samp(hr).over(w24),
        "sharpe_ratio_simplified": F.when(F.count(hr).over(w24) >= 2,
                                          safe_div(F.avg(hr).over(w24), F.stddev_samp(hr).over(w24))),
        "momentum_score": F.coalesce(hr, F.lit(0.0)) * F.lit(MOMENTUM_WEIGHTS[0])
        + F.coalesce(daily, F.lit(0.0)) * F.lit(MOMENTUM_WEIGHTS[1]),
    })
    return out


def add_return_features(df: DataFrame, entity: str = "symbol", time: str = "snapshot_time",
                        price: str = "price", windows: Sequence[int] = ROLLING_WINDOWS,
                        chunk_rows: int = DEFAULT_CHUNK_ROWS, bucket: str = "day") -> DataFrame:
    """E1-E14 per entity in time order (one shuffle by (entity, chunk), one sort)."""
    return with_entity_windows(df, lambda fr, w: _return_columns(fr, w, price, time, windows),
                               entity, time, chunk_rows=chunk_rows, lookback=FEATURE_LOOKBACK,
                               bucket=bucket)


# --------------------------------------------------------------------------- F1-F5
def snapshot_aggregates(df: DataFrame, time: str = "snapshot_time", entity: str = "symbol",
                        benchmark: str = "BTC", metric: str = "percent_change_24h",
                        accuracy: int | None = None) -> DataFrame:
    """One row per snapshot: totals, the benchmark's metric (if present) and
    the metric's median — partial aggregates, so a hot snapshot is combined
    map-side."""
    aggs = [F.sum("market_cap").alias("_tot_cap"), F.sum("volume_24h").alias("_tot_vol")]
    if metric not in df.columns:
        return df.groupBy(time).agg(*aggs)
    aggs += [F.max(F.when(F.col(entity) == benchmark, F.col(metric))).alias("_bench_val"),
             F.max(F.col(entity) == benchmark).alias("_has_bench")]
    if accuracy is not None:
        aggs.append(F.percentile_approx(metric, F.lit(0.5), accuracy).alias("_median"))
        return df.groupBy(time).agg(*aggs)
    med = grouped_quantiles(df, time, {metric: [0.5]}).withColumnRenamed(f"_q_{metric}_0", "_median")
    return df.groupBy(time).agg(*aggs).join(med, time, "left")


def add_market_structure(df: DataFrame, time: str = "snapshot_time", entity: str = "symbol",
                         benchmark: str = "BTC", metric: str = "percent_change_24h",
                         accuracy: int | None = None, rank_partitions: int | None = None) -> DataFrame:
    """market_dominance (= market_cap_share), volume_share, volume/cap ratio,
    price_rank (descending, ties share the lowest rank), relative strength vs
    the benchmark or, where the benchmark is absent, vs the snapshot median."""
    aggs = materialize(snapshot_aggregates(df, time, entity, benchmark, metric, accuracy))
    out = sized_join(df, aggs, time, "left")
    dom = safe_div("market_cap", "_tot_cap")
    cols = {"market_dominance": dom, "market_cap_share": dom,
            "volume_share": safe_div("volume_24h", "_tot_vol"),
            "volume_to_marketcap_ratio": safe_div("volume_24h", "market_cap")}
    if metric in df.columns:
        bench = F.when(F.col("_has_bench"), F.col("_bench_val")).otherwise(F.col("_median"))
        cols["relative_strength_vs_btc"] = F.col(metric) - bench
    out = out.withColumns(cols).drop("_tot_cap", "_tot_vol", "_bench_val", "_has_bench", "_median")
    out = group_rank(out, time, "price", descending=True, name="price_rank", partitions=rank_partitions)
    return out.withColumn("price_rank", F.col("price_rank").cast("double"))


def build_feature_set(clean: DataFrame, entity: str = "symbol", time: str = "snapshot_time",
                      chunk_rows: int = DEFAULT_CHUNK_ROWS, accuracy: int | None = None,
                      checkpoint: bool = True) -> DataFrame:
    """M1: calendar → per-entity returns/rolling → cross-section (41 columns).

    Two stage boundaries: after the entity-keyed windows (the cross-section's
    snapshot aggregates and rank read them twice) and at the end."""
    df = add_timestamp_features(clean, time)
    df = stage(add_return_features(df, entity, time, chunk_rows=chunk_rows), checkpoint)
    return stage(add_market_structure(df, time, entity, accuracy=accuracy), checkpoint)


# --------------------------------------------------------------------------- E17
def rolling_correlation(df: DataFrame, symbol_a: str = "BTC", symbol_b: str = "ETH", window: int = 24,
                        value: str = "hourly_return", entity: str = "symbol",
                        time: str = "snapshot_time") -> DataFrame:
    """Correlation of two entities' ``value`` over the last ``window`` times,
    requiring ``window`` complete pairs. Times where every entity's value is
    NULL are not rows (pivot semantics); duplicates are averaged. Empty when
    either entity is missing.

    The per-time table has one row per snapshot; its rolling frame runs on
    the chunked machinery with one constant key, so it stays parallel."""
    v = F.col(value)
    per_time = (df.groupBy(time)
                .agg(F.avg(F.when(F.col(entity) == symbol_a, v)).alias("_a"),
                     F.avg(F.when(F.col(entity) == symbol_b, v)).alias("_b"),
                     F.count(v).alias("_nv"),
                     F.max(F.col(entity) == symbol_a).alias("_ha"),
                     F.max(F.col(entity) == symbol_b).alias("_hb"))
                .filter(F.col("_nv") > 0))
    present = per_time.agg(F.max("_ha").alias("a"), F.max("_hb").alias("b"))
    per_time = per_time.filter(present.select("a").scalar() & present.select("b").scalar())
    per_time = per_time.withColumn("_one", F.lit(1))

    def build(frame, w):
        fr = w.rowsBetween(-(window - 1), 0)
        both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
        n_pairs = F.count(F.when(both, F.lit(1))).over(fr)
        return frame.withColumn("rolling_corr", F.when(n_pairs >= window, F.corr("_a", "_b").over(fr)))
    out = with_entity_windows(per_time, build, "_one", time, lookback=window - 1)
    return out.select(time, "rolling_corr")
