"""Unit-root test and model forecasts per entity (L6-L9), as least squares on
Spark aggregates.

Every model here is a sequence of linear least-squares fits. A fit needs only
XᵀX, Xᵀy, yᵀy and n, which are sums over rows: one grouped partial aggregate
per fit, whatever the series length. The tiny solves (a few dozen numbers per
entity) run in ``applyInPandas`` on those aggregate rows; residuals and
forecasts go back through joins and windows. Results approximate the
reference's exact maximum-likelihood libraries (they are least-squares
estimates: Hannan-Rissanen for ARMA terms), and are labelled so.

  L6 ``adf_test``: augmented Dickey-Fuller with a constant, lag by AIC over
     0..maxlag on a common sample, MacKinnon (1994) p-value.
  L7 ``forecast_arima``: ARIMA(p,1,q) by Hannan-Rissanen, 95 % intervals from
     psi-weights; 80/20 backtest metrics.
  L8 ``forecast_sarima``: (1,1,1)(1,1,1,s) the same way, the seasonal
     polynomials multiplied out (lags 1, s, s+1), no stationarity enforcement.
  L9 ``forecast_trend_seasonal``: re-aimed optional trend+seasonality model:
     linear trend plus daily and weekly Fourier terms, residual-std bands.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import materialize, ordinal, sized_join, with_entity_windows
from tidemark.operators.timeseries import regression_metrics

# MacKinnon (1994) response-surface coefficients for the ADF
# p-value, constant-only regression, one variable (max, min, star statistic,
# small-p and large-p polynomial coefficients in increasing powers).
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALL_P = [2.1659, 1.4412, 0.038269]
ADF_LARGE_P = [1.7339, 0.93202, -0.12745, -0.010368]
Z95 = 1.959963984540054
MAX_LONG_AR = 40


def _norm_cdf(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def mackinnon_p(tau: float) -> float:
    if tau is None or math.isnan(tau):
        return float("nan")
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    coef = ADF_SMALL_P if tau <= ADF_TAU_STAR else ADF_LARGE_P
    return _norm_cdf(sum(c * tau ** i for i, c in enumerate(coef)))


# --------------------------------------------------------------------------- least squares
def cross_products(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per group: n, yᵀy, Xᵀy and the upper triangle of XᵀX (rows with any
    NULL are left out). One partial aggregate."""
    ok = F.col(y).isNotNull()
    for x in xs:
        ok = ok & F.col(x).isNotNull()
    d = df.filter(ok)
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(F.col(y) * F.col(y)).alias("_yy")]
    aggs += [F.sum(F.col(x) * F.col(y)).alias(f"_xy{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(F.col(a) * F.col(b)).alias(f"_xx{i}_{j}") for i, a in enumerate(xs)
             for j, b in enumerate(xs) if j >= i]
    return d.groupBy(*by).agg(*aggs)


def unpack(row, k: int):
    xtx = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            v = row[f"_xx{i}_{j}"]
            xtx[i, j] = xtx[j, i] = 0.0 if v is None or pd.isna(v) else v
    xty = np.array([0.0 if pd.isna(row[f"_xy{i}"]) else row[f"_xy{i}"] for i in range(k)])
    return xtx, xty, float(row["_yy"]), int(row["_n"])


def solve(xtx, xty, yy, n, idx):
    """OLS on the columns ``idx``: (beta, ssr, (XᵀX)⁻¹)."""
    a = xtx[np.ix_(idx, idx)]
    b = xty[idx]
    inv = np.linalg.pinv(a)
    beta = inv @ b
    ssr = max(yy - 2 * beta @ b + beta @ a @ beta, 0.0)
    return beta, ssr, inv


def _series(df, entity, time, value, lags: int, extra=None, lookahead: int = 0):
    src = df.filter(F.col(value).isNotNull()).select(entity, time, F.col(value).cast("double").alias("y"))

    def build(fr, w):
        fr = fr.withColumn("t", ordinal(entity, time)).withColumn("n", F.col("_total"))
        return extra(fr, w) if extra else fr
    return with_entity_windows(src, build, entity, time, lookback=lags, lookahead=lookahead)


# --------------------------------------------------------------------------- L6
def adf_test(df: DataFrame, entity: str = "symbol", time: str = "snapshot_time", value: str = "price",
             max_lag_cap: int | None = None) -> DataFrame:
    """``(symbol, adf_statistic, p_value, used_lag, nobs, is_stationary)``."""
    spark = df.sparkSession
    n_max = df.filter(F.col(value).isNotNull()).groupBy(entity).count().agg(F.max("count")).head()[0] or 0
    big = int(math.ceil(12.0 * (n_max / 100.0) ** 0.25)) if n_max else 0
    if max_lag_cap is not None:
        big = min(big, max_lag_cap)
    big = max(big, 0)

    def extra(fr, w):
        dy = F.col("y") - F.lag("y", 1).over(w)
        fr = fr.withColumn("dy", dy).withColumn("ylag", F.lag("y", 1).over(w))
        return fr.withColumns({f"dl{i}": F.lag("dy", i).over(w) for i in range(1, big + 1)})
    s = materialize(_series(df, entity, time, value, big + 1, extra))
    s = s.withColumn("maxlag", F.least(F.ceil(F.lit(12.0) * F.pow(F.col("n") / 100.0, 0.25)),
                                       F.floor(F.col("n") / 2) - 2, F.lit(big)).cast("int"))
    xs = ["one", "ylag"] + [f"dl{i}" for i in range(1, big + 1)]
    s = s.withColumn("one", F.lit(1.0))
    # pass 1: the common sample t >= maxlag + 1, all candidate regressors (unused lags zeroed)
    s1 = s.filter(F.col("t") >= F.col("maxlag") + 1).withColumns(
        {f"dl{i}": F.when(F.lit(i) <= F.col("maxlag"), F.col(f"dl{i}")).otherwise(0.0) for i in range(1, big + 1)})
    cp1 = cross_products(s1, "dy", xs, [entity, "maxlag"])

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        xtx, xty, yy, n = unpack(row, len(xs))
        best = None
        for lag in range(0, int(row["maxlag"]) + 1):
            idx = list(range(2 + lag))
            _, ssr, _ = solve(xtx, xty, yy, n, idx)
            llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n if ssr > 0 else 1e-300) + 1)
            aic = -2 * llf + 2 * len(idx)
            if best is None or aic < best[0]:
                best = (aic, lag)
        return pd.DataFrame({entity: [row[entity]], "used_lag": [best[1] if best else 0]})
    lags = cp1.groupBy(entity).applyInPandas(pick, f"{entity} string, used_lag int")
    # pass 2: the final regression on its own (longer) sample
    s2 = sized_join(s, materialize(lags), entity).filter(F.col("t") >= F.col("used_lag") + 1).withColumns(
        {f"dl{i}": F.when(F.lit(i) <= F.col("used_lag"), F.col(f"dl{i}")).otherwise(0.0) for i in range(1, big + 1)})
    cp2 = cross_products(s2, "dy", xs, [entity, "used_lag"])

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        xtx, xty, yy, n = unpack(row, len(xs))
        idx = list(range(2 + int(row["used_lag"])))
        beta, ssr, inv = solve(xtx, xty, yy, n, idx)
        dof = max(n - len(idx), 1)
        se = math.sqrt(max(ssr / dof * inv[1, 1], 0.0))
        tau = beta[1] / se if se > 0 else float("nan")
        p = mackinnon_p(tau)
        return pd.DataFrame({entity: [row[entity]], "adf_statistic": [tau], "p_value": [p],
                             "used_lag": [int(row["used_lag"])], "nobs": [n], "is_stationary": [bool(p < 0.05)]})
    return cp2.groupBy(entity).applyInPandas(
        final, f"{entity} string, adf_statistic double, p_value double, used_lag int, nobs long, is_stationary boolean")


# --------------------------------------------------------------------------- L7, L8
def _psi(phi: dict, theta: dict, h: int) -> np.ndarray:
    """psi-weights of (1 - sum phi_i B^i) x = (1 + sum theta_j B^j) e."""
    psi = np.zeros(h)
    psi[0] = 1.0
    for k in range(1, h):
        v = theta.get(k, 0.0)
        for i, a in phi.items():
            if k - i >= 0:
                v += a * psi[k - i]
        psi[k] = v
    return psi


def _diff_poly(d: int, D: int, s: int) -> dict:
    """(1 - B)^d (1 - B^s)^D as {lag: coefficient} (coefficient of B^0 is 1)."""
    poly = {0: 1.0}
    for _ in range(d):
        poly = _mul(poly, {0: 1.0, 1: -1.0})
    for _ in range(D):
        poly = _mul(poly, {0: 1.0, s: -1.0})
    return poly


def _mul(a: dict, b: dict) -> dict:
    out: dict = {}
    for i, x in a.items():
        for j, y in b.items():
            out[i + j] = out.get(i + j, 0.0) + x * y
    return out


def _hr_fit(df: DataFrame, entity, time, value, ar_lags, ma_lags, d, D, s, steps, order, long_ar, name):
    """Hannan-Rissanen on the differenced series w, then forecasts of y.

    Every series is fitted with its own orders: ``order(m)`` is the first-stage AR
    order for m differenced rows (``long_ar`` at most), and lags above a third of m are left
    out of either stage; unused lags are zero columns. ``steps`` is a number or a table
    (entity, _h). A series without enough rows to difference and fit gives one row
    with status ``too_short`` and no step."""
    diff = _diff_poly(d, D, s)
    span = max(diff)
    m = F.greatest(F.col("n") - span, F.lit(0))
    most = F.floor(m / 3)

    def used(lag: int, limit, v):
        return F.when(F.lit(lag) <= limit, v).otherwise(F.lit(0.0))
    look = span + long_ar + max(list(ar_lags) + list(ma_lags) + [0]) + 1

    def extra(fr, w):
        wexpr = None
        for lag, c in diff.items():
            term = (F.col("y") if lag == 0 else F.lag("y", lag).over(w)) * F.lit(c)
            wexpr = term if wexpr is None else wexpr + term
        fr = fr.withColumn("w", wexpr)
        first = F.least(order(m), most, F.lit(long_ar))
        return fr.withColumns({f"wl{i}": used(i, first, F.lag("w", i).over(w)) for i in range(1, long_ar + 1)})
    s1 = materialize(_series(df, entity, time, value, look, extra))
    xs1 = [f"wl{i}" for i in range(1, long_ar + 1)]
    cp1 = cross_products(s1, "w", xs1, [entity])

    def ar_coefs(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        xtx, xty, yy, n = unpack(row, len(xs1))
        beta, _, _ = solve(xtx, xty, yy, n, list(range(len(xs1))))
        return pd.DataFrame({entity: [row[entity]], **{f"a{i + 1}": [beta[i]] for i in range(len(xs1))}})
    a_schema = f"{entity} string, " + ", ".join(f"a{i} double" for i in range(1, long_ar + 1))
    coefs = materialize(cp1.groupBy(entity).applyInPandas(ar_coefs, a_schema))
    s2 = sized_join(s1, coefs, entity)
    resid = F.col("w")
    for i in range(1, long_ar + 1):
        resid = resid - F.col(f"a{i}") * F.col(f"wl{i}")
    s2 = s2.withColumn("e", resid).drop(*[f"a{i}" for i in range(1, long_ar + 1)])

    def extra2(fr, w):
        fr = fr.withColumns({f"wp{i}": used(i, most, F.lag("w", i).over(w)) for i in ar_lags})
        return fr.withColumns({f"ep{j}": used(j, most, F.lag("e", j).over(w)) for j in ma_lags})
    from tidemark.operators.series import with_entity_windows as _w
    s3 = materialize(_w(s2.select(entity, time, "y", "t", "n", "w", "e"), extra2, entity, time,
                        lookback=max(list(ar_lags) + list(ma_lags) + [1])))
    xs2 = [f"wp{i}" for i in ar_lags] + [f"ep{j}" for j in ma_lags]
    cp2 = cross_products(s3, "w", xs2, [entity])
    tail_len = span + max(list(ar_lags) + list(ma_lags) + [1])
    tail = s3.filter(F.col("t") >= F.col("n") - tail_len).select(entity, "t", "y", "w", "e")
    tails = tail.groupBy(entity).agg(F.sort_array(F.collect_list(F.struct("t", "y", "w", "e"))).alias("_tail"))
    fit_in = cp2.join(tails, entity)
    fit_in = fit_in.withColumn("_h", F.lit(steps)) if isinstance(steps, int) else fit_in.join(steps, entity)

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        steps = int(row["_h"])
        xtx, xty, yy, n = unpack(row, len(xs2))
        beta, ssr, _ = solve(xtx, xty, yy, n, list(range(len(xs2))))
        sigma2 = ssr / max(n, 1)
        phi = {lag: beta[i] for i, lag in enumerate(ar_lags)}
        theta = {lag: beta[len(ar_lags) + j] for j, lag in enumerate(ma_lags)}
        tl = row["_tail"]
        ys = [r["y"] for r in tl]
        ws = [r["w"] for r in tl]
        es = [0.0 if r["e"] is None or pd.isna(r["e"]) else r["e"] for r in tl]
        yh = list(ys)
        wh = [0.0 if v is None or pd.isna(v) else v for v in ws]
        eh = list(es)
        out_y = []
        for _ in range(steps):
            wn = sum(a * wh[-i] for i, a in phi.items() if i <= len(wh)) + \
                sum(b * eh[-j] for j, b in theta.items() if j <= len(eh))
            # invert the differencing: y_t = w_t - sum_{lag>0} c_lag y_{t-lag}
            yn = wn - sum(c * yh[-lag] for lag, c in diff.items() if lag > 0)
            wh.append(wn)
            eh.append(0.0)
            yh.append(yn)
            out_y.append(yn)
        full_phi = _mul({0: 1.0, **{i: -a for i, a in phi.items()}}, diff)
        psi = _psi({i: -c for i, c in full_phi.items() if i > 0}, theta, steps)
        var = sigma2 * np.cumsum(psi ** 2)
        half = Z95 * np.sqrt(var)
        return pd.DataFrame({entity: row[entity], "model": name, "step": np.arange(steps, dtype=np.int32),
                             "yhat": out_y, "lower": np.array(out_y) - half, "upper": np.array(out_y) + half, "status": "ok"})
    schema = f"{entity} string, model string, step int, yhat double, lower double, upper double, status string"
    done = fit_in.groupBy(entity).applyInPandas(forecast, schema)
    short = (df.select(F.col(entity).cast("string").alias(entity)).filter(F.col(entity).isNotNull()).distinct()
             .join(fit_in.select(entity), entity, "left_anti"))
    none = F.lit(None).cast("double")
    return done.unionByName(short.select(entity, F.lit(name).alias("model"), F.lit(None).cast("int").alias("step"), none.alias("yhat"),
                                         none.alias("lower"), none.alias("upper"), F.lit("too_short").alias("status")))


def _backtest(df, entity, time, value, fitter, train_fraction: float = 0.8):
    """Fit on the first 80 % of each series, forecast the rest, score it."""
    src = df.filter(F.col(value).isNotNull())
    idx = _series(src, entity, time, value, 0).select(entity, time, "t", "n", F.col("y").alias(value))
    idx = materialize(idx)
    train = idx.filter(F.col("t") < F.floor(F.col("n") * train_fraction))
    test = idx.filter(F.col("t") >= F.floor(F.col("n") * train_fraction))
    horizon = test.groupBy(entity).agg(F.count(F.lit(1)).alias("_h"), F.min("t").alias("_t0"))
    if horizon.isEmpty():
        return None
    fc = fitter(train.select(entity, time, value), horizon.select(entity, "_h"))
    scored = (test.join(horizon, entity).withColumn("step", (F.col("t") - F.col("_t0")).cast("int"))
              .join(fc.select(entity, "step", "yhat"), [entity, "step"]))
    return regression_metrics(scored.withColumnRenamed(value, "y"), by=(entity,))


def forecast_arima(df: DataFrame, order=(2, 1, 2), steps: int = 12, entity: str = "symbol",
                   time: str = "snapshot_time", value: str = "price", backtest: bool = True, max_long_ar: int = MAX_LONG_AR):
    """(forecast with 95 % interval, backtest metrics or None). The first-stage AR order
    follows each symbol's own length, up to the model parameter ``max_long_ar``."""
    p, d, q = order
    low = max(2 * max(p, q), 1)

    def first(m):
        """ln(m)^2, at most a quarter of the rows, at least twice the model's orders."""
        return F.greatest(F.least(F.floor(F.pow(F.log(F.greatest(m, F.lit(2))), 2)), F.floor(m / 4)), F.lit(low))

    def fit(frame, h):
        return _hr_fit(frame, entity, time, value, list(range(1, p + 1)), list(range(1, q + 1)), d, 0, 1, h,
                       first, max(max_long_ar, low), "ARIMA")
    fc = fit(df, steps)
    metrics = _backtest(df, entity, time, value, fit) if backtest else None
    return fc, (metrics.withColumn("model", F.lit("ARIMA")) if metrics is not None else None)


def forecast_sarima(df: DataFrame, order=(1, 1, 1), seasonal_order=(1, 1, 1, 48), steps: int = 12,
                    entity: str = "symbol", time: str = "snapshot_time", value: str = "price",
                    backtest: bool = True):
    """Seasonal ARIMA; AR/MA lags 1, s, s+1 estimated freely (no
    stationarity or invertibility constraint, as in the reference)."""
    p, d, q = order
    P, D, Q, s = seasonal_order
    ar = sorted({i for i in range(1, p + 1)} | {s * k for k in range(1, P + 1)} |
                {s * k + i for k in range(1, P + 1) for i in range(1, p + 1)})
    ma = sorted({j for j in range(1, q + 1)} | {s * k for k in range(1, Q + 1)} |
                {s * k + j for k in range(1, Q + 1) for j in range(1, q + 1)})
    long_ar = max(ar + ma) + 2

    def fit(frame, h):
        return _hr_fit(frame, entity, time, value, ar, ma, d, D, s, h, lambda m: F.lit(long_ar), long_ar, "SARIMA")
    fc = fit(df, steps)
    metrics = _backtest(df, entity, time, value, fit) if backtest else None
    return fc, (metrics.withColumn("model", F.lit("SARIMA")) if metrics is not None else None)


# --------------------------------------------------------------------------- L9
def forecast_trend_seasonal(df: DataFrame, steps: int = 12, freq_minutes: int = 30, daily_terms: int = 4,
                            weekly_terms: int = 3, interval: float = 0.8, entity: str = "symbol",
                            time: str = "snapshot_time", value: str = "price") -> DataFrame:
    """L9 (re-aimed): linear trend + daily and weekly Fourier terms by least
    squares per entity; forecasts every ``freq_minutes`` after the last
    time, with a normal band of the residual std (80 % by default)."""
    day = 86400.0
    src = df.filter(F.col(value).isNotNull()).select(entity, F.col(time).cast("timestamp").alias("_ts"),
                                                     F.col(value).cast("double").alias("y"))
    t0 = src.groupBy(entity).agg(F.min("_ts").alias("_t0"), F.max("_ts").alias("_t1"))
    src = sized_join(src, materialize(t0), entity)
    tt = (F.unix_micros("_ts") - F.unix_micros("_t0")) / F.lit(1e6 * day)

    def design(t):
        cols = {"one": F.lit(1.0), "tt": t}
        for k in range(1, daily_terms + 1):
            cols[f"ds{k}"] = F.sin(F.lit(2 * math.pi * k) * t)
            cols[f"dc{k}"] = F.cos(F.lit(2 * math.pi * k) * t)
        for k in range(1, weekly_terms + 1):
            cols[f"ws{k}"] = F.sin(F.lit(2 * math.pi * k / 7.0) * t)
            cols[f"wc{k}"] = F.cos(F.lit(2 * math.pi * k / 7.0) * t)
        return cols
    d = src.withColumns(design(tt))
    xs = list(design(F.lit(0.0)))
    cp = cross_products(d, "y", xs, [entity]).join(t0, entity)
    zq = {0.8: 1.2815515655446004, 0.95: Z95}.get(interval, 1.2815515655446004)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        xtx, xty, yy, n = unpack(row, len(xs))
        beta, ssr, _ = solve(xtx, xty, yy, n, list(range(len(xs))))
        sd = math.sqrt(ssr / max(n - len(xs), 1))
        last = pd.Timestamp(row["_t1"])
        first = pd.Timestamp(row["_t0"])
        times = [last + pd.Timedelta(minutes=freq_minutes * (i + 1)) for i in range(steps)]
        out = []
        for ts in times:
            t = (ts - first).total_seconds() / day
            x = [1.0, t] + [f(2 * math.pi * k * t) for k in range(1, daily_terms + 1) for f in (math.sin, math.cos)]
            x += [f(2 * math.pi * k * t / 7.0) for k in range(1, weekly_terms + 1) for f in (math.sin, math.cos)]
            out.append(float(np.dot(beta, np.array(x))))
        out = np.array(out)
        return pd.DataFrame({entity: row[entity], "model": "TrendSeasonal", "step": np.arange(steps, dtype=np.int32),
                             "ds": times, "yhat": out, "yhat_lower": out - zq * sd, "yhat_upper": out + zq * sd})
    return cp.groupBy(entity).applyInPandas(
        fit, f"{entity} string, model string, step int, ds timestamp, yhat double, yhat_lower double, "
             "yhat_upper double")
