"""Per-series diagnostics and forecasts for every entity in one job.

The reference fits one series at a time. Here every statistic that a fit
needs is a sum over rows — cross-products of lagged values, residual sums —
so it is a grouped partial aggregate (one row per entity reaches the
shuffle, whatever the entity's length). Only the final small solves (a few
dozen numbers per entity) run in pandas, via ``applyInPandas`` on the
aggregated rows. Row positions and lags come from the chunked entity windows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import materialize, ordinal, sized_join, with_entity_windows

# Backtest split, horizon, lags, decomposition period.
TRAIN_FRACTION = 0.8
STEPS_AHEAD = 12
ACF_LAGS = 40
PERIOD = 48
FLOAT_EPS = 2.220446049250313e-16


def indexed(df: DataFrame, entity: str = "symbol", time: str = "snapshot_time", value: str = "price",
            lookback: int = 0, lookahead: int = 0, extra=None) -> DataFrame:
    """``(entity, time, y, t, n)``: non-null values, position ``t`` from 0 and
    the series length ``n``; ``extra(frame, window)`` may add window columns."""
    src = df.filter(F.col(value).isNotNull()).select(entity, time, F.col(value).cast("double").alias("y"))

    def build(fr, w):
        fr = fr.withColumn("t", ordinal(entity, time)).withColumn("n", F.col("_total"))
        return extra(fr, w) if extra else fr
    return with_entity_windows(src, build, entity, time, lookback=lookback, lookahead=lookahead)


# --------------------------------------------------------------------------- L1, L2
def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ("symbol",)) -> DataFrame:
    """rmse, mae, mape (|y| floored at machine epsilon), r2 (NULL for one
    point; 1 or 0 when y is constant, by whether the fit is exact) (L2)."""
    err = F.col(y) - F.col(yhat)
    agg = df.groupBy(*by).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        F.avg(F.abs(err) / F.greatest(F.abs(F.col(y)), F.lit(FLOAT_EPS))).alias("mape"),
        F.sum(err * err).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"), F.count(y).alias("_n"))
    r2 = (F.when(F.col("_n") <= 1, F.lit(None))
          .when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, 1.0).otherwise(0.0))
          .otherwise(1 - F.col("_sse") / F.col("_sst")))
    return agg.select(*by, "rmse", "mae", "mape", r2.cast("double").alias("r2"))


def forecast_linear(df: DataFrame, steps: int = STEPS_AHEAD, entity: str = "symbol",
                    time: str = "snapshot_time", value: str = "price") -> tuple[DataFrame, DataFrame]:
    """Linear trend on the position 0..n-1 (L1): fit on the first
    int(0.8 n) points, score the rest, refit on all, forecast ``steps``.
    Returns (forecast ``(symbol, step, yhat)``, metrics). Fits are
    ``regr_slope``/``regr_intercept`` grouped aggregates."""
    s = indexed(df, entity, time, value).withColumn("split", F.floor(F.col("n") * TRAIN_FRACTION))
    s = materialize(s)
    train = s.filter(F.col("t") < F.col("split")).groupBy(entity).agg(
        F.regr_slope("y", "t").alias("b"), F.regr_intercept("y", "t").alias("a"))
    test = s.filter(F.col("t") >= F.col("split")).join(train, entity)
    test = test.withColumn("yhat", F.col("a") + F.col("b") * F.col("t"))
    metrics = regression_metrics(test, by=(entity,)).withColumn("model", F.lit("LinearRegression"))
    full = s.groupBy(entity).agg(F.regr_slope("y", "t").alias("b"), F.regr_intercept("y", "t").alias("a"),
                                 F.max("n").alias("n"))
    fc = full.select(entity, "a", "b", "n", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
    fc = fc.select(entity, F.lit("LinearRegression").alias("model"), "step",
                   (F.col("a") + F.col("b") * (F.col("n") + F.col("step"))).alias("yhat"))
    return fc, metrics


# --------------------------------------------------------------------------- L3, L4
def _lag_products(df: DataFrame, nlags: int, entity: str, time: str, value: str) -> DataFrame:
    """Per entity: n and S_k = sum_t d_t d_{t-k} for k = 0..nlags, d = y - mean."""
    means = df.filter(F.col(value).isNotNull()).groupBy(entity).agg(F.avg(value).alias("_mu"))
    src = sized_join(df.filter(F.col(value).isNotNull()), materialize(means), entity)
    src = src.withColumn(value, F.col(value) - F.col("_mu")).drop("_mu")

    def extra(fr, w):
        return fr.withColumns({f"_p{k}": F.col("y") * F.lag("y", k).over(w) for k in range(nlags + 1)})
    s = indexed(src, entity, time, value, lookback=nlags, extra=extra)
    return s.groupBy(entity).agg(F.max("n").alias("n"), *[F.sum(f"_p{k}").alias(f"s{k}") for k in range(nlags + 1)])


def acf(df: DataFrame, nlags: int = ACF_LAGS, entity: str = "symbol", time: str = "snapshot_time",
        value: str = "price") -> DataFrame:
    """Autocorrelation at lags 0..nlags (L3), biased (sums over n), mean of
    the whole series: ``(symbol, lag, acf)``."""
    sums = _lag_products(df, nlags, entity, time, value)
    arr = F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"s{k}"), F.col("s0")).alias("acf"))
                    for k in range(nlags + 1)])
    return sums.select(entity, F.inline(arr))


def _durbin_levinson(r: np.ndarray, nlags: int) -> np.ndarray:
    """PACF from autocorrelations r[0..nlags] (r[0] = 1)."""
    out = np.full(nlags + 1, np.nan)
    out[0] = 1.0
    phi = np.zeros(nlags + 1)
    v = 1.0
    for k in range(1, nlags + 1):
        if v <= 0:
            break
        a = (r[k] - np.dot(phi[1:k], r[k - 1:0:-1])) / v
        new = phi.copy()
        new[k] = a
        new[1:k] = phi[1:k] - a * phi[k - 1:0:-1]
        phi = new
        v *= (1 - a * a)
        out[k] = a
    return out


def pacf(df: DataFrame, nlags: int = ACF_LAGS, entity: str = "symbol", time: str = "snapshot_time",
         value: str = "price") -> DataFrame:
    """Partial autocorrelation at lags 0..nlags by Yule-Walker with the
    adjusted autocovariance (S_k / (n - k)) (L4). The sums are Spark
    aggregates; the recursion runs per entity on its 41 numbers."""
    sums = materialize(_lag_products(df, nlags, entity, time, value))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        n = int(row["n"])
        k = min(nlags, max(n // 2 - 1, 0))
        ac = np.array([row[f"s{i}"] / (n - i) if n - i > 0 and row[f"s{i}"] is not None else np.nan
                       for i in range(nlags + 1)], dtype=float)
        r = ac / ac[0] if ac[0] else ac
        vals = _durbin_levinson(r, k) if k > 0 else np.array([1.0])
        return pd.DataFrame({entity: row[entity], "lag": np.arange(len(vals), dtype=np.int32), "pacf": vals})
    return sums.groupBy(entity).applyInPandas(solve, f"{entity} string, lag int, pacf double")


# --------------------------------------------------------------------------- L5
def decompose(df: DataFrame, period: int = PERIOD, entity: str = "symbol", time: str = "snapshot_time",
              value: str = "price") -> DataFrame:
    """Additive classical decomposition (L5): centred 2 x period moving-average
    trend, ends extrapolated by least-squares lines through the first and
    last ``period`` trend values, seasonal = phase means of the detrended
    series centred to sum 0, residual = rest. Entities with fewer than
    2 x period values are left out (the reference returns nothing for them)."""
    half = period // 2
    if period % 2:
        raise ValueError("only even periods (the reference uses 48)")

    def extra(fr, w):
        inner = F.sum("y").over(w.rowsBetween(-(half - 1), half - 1))
        edges = F.lag("y", half).over(w) + F.lead("y", half).over(w)
        return fr.withColumn("_ma", (inner + F.lit(0.5) * edges) / F.lit(float(period)))
    s = indexed(df, entity, time, value, lookback=half, lookahead=half, extra=extra)
    s = materialize(s.filter(F.col("n") >= 2 * period))
    front = (s.filter((F.col("t") >= half) & (F.col("t") < half + period))
             .groupBy(entity).agg(F.regr_slope("_ma", "t").alias("_fb"), F.regr_intercept("_ma", "t").alias("_fa")))
    back = (s.filter((F.col("t") <= F.col("n") - 1 - half) & (F.col("t") > F.col("n") - 1 - half - period))
            .groupBy(entity).agg(F.regr_slope("_ma", "t").alias("_bb"), F.regr_intercept("_ma", "t").alias("_ba")))
    s = s.join(front, entity).join(back, entity)
    trend = (F.when(F.col("t") < half, F.col("_fa") + F.col("_fb") * F.col("t"))
             .when(F.col("t") > F.col("n") - 1 - half, F.col("_ba") + F.col("_bb") * F.col("t"))
             .otherwise(F.col("_ma")))
    s = s.withColumn("trend", trend).withColumn("_phase", F.pmod(F.col("t"), F.lit(period)))
    phases = s.groupBy(entity, "_phase").agg(F.avg(F.col("y") - F.col("trend")).alias("_pa"))
    # one row per (entity, phase): at most ``period`` rows per window partition
    phases = phases.withColumn("seasonal", F.col("_pa") - F.avg("_pa").over(Window.partitionBy(entity)))
    out = s.join(phases.select(entity, "_phase", "seasonal"), [entity, "_phase"])
    return out.select(entity, time, F.col("y").alias(value), "trend", "seasonal",
                      (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"))


# --------------------------------------------------------------------------- C8
def stitch_tail_and_forecast(df: DataFrame, forecast: DataFrame, n_tail: int = 50, entity: str = "symbol",
                             value: str = "price") -> DataFrame:
    """The chart's side-by-side frame (C8): last ``n_tail`` values and the
    forecast, both renumbered from 0, joined full-outer on position (so they
    overlap, as in the reference), per entity."""
    from tidemark.operators.reports import tail_n
    tail = tail_n(df, n_tail, entity, value=value).select(entity, "pos", F.col(value).alias("tail_value"))
    fc = forecast.select(entity, F.col("step").cast("long").alias("pos"), F.col("yhat").alias("forecast"))
    return tail.join(fc, [entity, "pos"], "full_outer")


def append_forecast(df: DataFrame, forecast: DataFrame, n_tail: int = 50, entity: str = "symbol",
                    value: str = "price") -> DataFrame:
    """C8, the continuous form: the last ``n_tail`` values at positions
    0..m-1 followed by the forecast at m, m+1, ... (a union with a step
    offset), with ``kind`` telling the two apart."""
    from tidemark.operators.reports import tail_n
    tail = tail_n(df, n_tail, entity, value=value)
    width = tail.groupBy(entity).agg(F.count(F.lit(1)).alias("_m"))
    hist = tail.select(entity, "pos", F.col(value).alias("value"), F.lit("history").alias("kind"))
    fc = (forecast.join(width, entity)
          .select(entity, (F.col("_m") + F.col("step")).cast("long").alias("pos"), F.col("yhat").alias("value"),
                  F.lit("forecast").alias("kind")))
    return hist.unionByName(fc)
