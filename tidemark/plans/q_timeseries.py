"""Tier 4/6: forecasts, metrics, ACF/PACF, decomposition, model forecasts."""

from __future__ import annotations

from tidemark.fixtures import bars, oracle_cte
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.operators import timeseries as TS
from tidemark.plans.registry import query

B = oracle_cte("bars")
W = "(PARTITION BY symbol ORDER BY snapshot_time)"
SERIES = f""", s AS (SELECT symbol, snapshot_time, price AS y, row_number() OVER {W} - 1 AS t,
            count(*) OVER (PARTITION BY symbol) AS n FROM bars WHERE price IS NOT NULL)
"""
FIT = """, f AS (SELECT symbol, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, max(n) AS n FROM s GROUP BY symbol),
fc AS (SELECT symbol, 'LinearRegression' AS model, CAST(unnest(range(12)) AS INTEGER) AS step, a, b, n FROM f),
fc2 AS (SELECT symbol, model, step, a + b * (n + step) AS yhat FROM fc)
"""


def _linear(spark, sf):
    return TS.forecast_linear(bars(spark, sf))


@query("forecast_linear", B + SERIES + FIT + f"SELECT symbol, model, step, {fix6_sql('yhat')} AS yhat FROM fc2")
def q_forecast_linear(spark, sf):
    """L1: linear trend forecast, 12 steps ahead, every symbol in one job."""
    fc, _ = _linear(spark, sf)
    return fc.withColumn("yhat", fix6("yhat"))


@query("regression_metrics", B + SERIES + f"""
, tr AS (SELECT symbol, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM s WHERE t < floor(n * 0.8) GROUP BY symbol),
te AS (SELECT s.symbol, y, a + b * t AS yhat FROM s JOIN tr USING (symbol) WHERE t >= floor(n * 0.8)),
m AS (SELECT symbol, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
             avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)) AS mape,
             sum((y - yhat) * (y - yhat)) AS sse, var_pop(y) * count(y) AS sst, count(y) AS cnt FROM te GROUP BY symbol)
SELECT symbol, {fix6_sql('rmse')} AS rmse, {fix6_sql('mae')} AS mae, {fix6_sql('mape')} AS mape,
  {fix6_sql("CASE WHEN cnt <= 1 THEN NULL WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sse / sst END")} AS r2,
  'LinearRegression' AS model FROM m""")
def q_metrics(spark, sf):
    """L2: rmse, mae, mape, r2 of the 80/20 backtest."""
    _, m = _linear(spark, sf)
    return m.select("symbol", *[fix6(c).alias(c) for c in ("rmse", "mae", "mape", "r2")], "model")


def _acf_sql(nlags: int = TS.ACF_LAGS) -> str:
    prods = ", ".join(["d * d AS p0"] + [f"d * lag(d, {k}) OVER {W} AS p{k}" for k in range(1, nlags + 1)])
    sums = ", ".join(f"sum(p{k}) AS s{k}" for k in range(nlags + 1))
    sel = " UNION ALL ".join(f"SELECT symbol, {k} AS lag, {fix6_sql(f's{k} / s0')} AS acf FROM sums"
                             for k in range(nlags + 1))
    return (f", dm AS (SELECT symbol, snapshot_time, price - avg(price) OVER (PARTITION BY symbol) AS d "
            f"FROM bars WHERE price IS NOT NULL),\n pr AS (SELECT symbol, {prods} FROM dm),\n"
            f" sums AS (SELECT symbol, {sums} FROM pr GROUP BY symbol)\n{sel}")


@query("acf", B + _acf_sql())
def q_acf(spark, sf):
    """L3: autocorrelation at lags 0..40 for every symbol."""
    return TS.acf(bars(spark, sf)).withColumn("acf", fix6("acf"))


def _pacf_sql(nlags: int = TS.ACF_LAGS) -> str:
    """Durbin-Levinson: each step's coefficient and the new list of coefficients from the last."""
    lags = ", ".join(f"sum(p{k}) AS s{k}" for k in range(nlags + 1))
    prods = ", ".join(["d * d AS p0"] + [f"d * lag(d, {k}) OVER {W} AS p{k}" for k in range(1, nlags + 1)])
    r = ", ".join(f"(s{k} / (n - {k})) / (s0 / n)" for k in range(nlags + 1))
    return (B.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, dm AS (SELECT symbol, snapshot_time, price - avg(price) OVER (PARTITION BY symbol) AS d FROM bars WHERE price IS NOT NULL),
pr AS (SELECT symbol, {prods} FROM dm),
sums AS (SELECT symbol, count(*) AS n, {lags} FROM pr GROUP BY symbol),
start AS (SELECT symbol, least({nlags}, greatest(n // 2 - 1, 0)) AS last, [{r}] AS r FROM sums),
dl(symbol, k, last, r, phi, v, a) AS (
  SELECT symbol, 0, last, r, CAST([] AS DOUBLE[]), 1.0::DOUBLE, 1.0::DOUBLE FROM start
  UNION ALL
  SELECT symbol, k + 1, last, r, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - b * phi[k + 1 - i]), b), v * (1 - b * b), b
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[k + 2 - i])), 0)) / v AS b
        FROM dl WHERE k < last AND v > 0))
SELECT symbol, CAST(k AS INTEGER) AS lag, {fix6_sql('a')} AS pacf FROM dl""")


@query("pacf", _pacf_sql())
def q_pacf(spark, sf):
    """L4: partial autocorrelation (Yule-Walker, adjusted), lags 0..40."""
    return TS.pacf(bars(spark, sf)).withColumn("pacf", fix6("pacf"))


DECOMP_SQL = SERIES + f"""
, ma AS (SELECT *, (sum(y) OVER (PARTITION BY symbol ORDER BY snapshot_time ROWS BETWEEN 23 PRECEDING AND 23 FOLLOWING)
          + 0.5 * (lag(y, 24) OVER {W} + lead(y, 24) OVER {W})) / 48.0 AS mav FROM s),
ok AS (SELECT * FROM ma WHERE n >= 96),
fr AS (SELECT symbol, regr_slope(mav, t) AS fb, regr_intercept(mav, t) AS fa FROM ok WHERE t >= 24 AND t < 72 GROUP BY symbol),
bk AS (SELECT symbol, regr_slope(mav, t) AS bb, regr_intercept(mav, t) AS ba FROM ok
       WHERE t <= n - 25 AND t > n - 25 - 48 GROUP BY symbol),
tr AS (SELECT ok.*, CASE WHEN t < 24 THEN fa + fb * t WHEN t > n - 25 THEN ba + bb * t ELSE mav END AS trend,
              t % 48 AS ph FROM ok JOIN fr USING (symbol) JOIN bk USING (symbol)),
pa AS (SELECT symbol, ph, avg(y - trend) AS pav FROM tr GROUP BY symbol, ph),
se AS (SELECT symbol, ph, pav - avg(pav) OVER (PARTITION BY symbol) AS seasonal FROM pa)
"""


@query("decompose_series", B + DECOMP_SQL + f"""
SELECT symbol, snapshot_time, y AS price, {fix6_sql('trend')} AS trend, {fix6_sql('seasonal')} AS seasonal,
       {fix6_sql('y - trend - seasonal')} AS resid FROM tr JOIN se USING (symbol, ph)""")
def q_decompose(spark, sf):
    """Additive decomposition with period 48, trend ends extrapolated."""
    out = TS.decompose(bars(spark, sf))
    return out.select("symbol", "snapshot_time", "price", *[fix6(c).alias(c) for c in ("trend", "seasonal", "resid")])


@query("stitch_tail_forecast", B + SERIES + FIT + f"""
, tl AS (SELECT symbol, CAST(least(50, n) - rd AS BIGINT) AS pos, price AS tail_value FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY snapshot_time DESC) AS rd,
         count(*) OVER (PARTITION BY symbol) AS n FROM bars WHERE price IS NOT NULL) WHERE rd <= 50)
SELECT coalesce(tl.symbol, fc2.symbol) AS symbol, coalesce(tl.pos, CAST(fc2.step AS BIGINT)) AS pos, tail_value,
       {fix6_sql('yhat')} AS forecast
FROM tl FULL OUTER JOIN fc2 ON tl.symbol = fc2.symbol AND tl.pos = fc2.step""")
def q_stitch(spark, sf):
    """Last 50 values and the forecast side by side, both numbered from 0."""
    fc, _ = _linear(spark, sf)
    out = TS.stitch_tail_and_forecast(bars(spark, sf), fc)
    return out.withColumn("forecast", fix6("forecast"))


@query("adf_test")
def q_adf(spark, sf):
    """Augmented Dickey-Fuller per symbol (AIC lag choice, MacKinnon p-value)."""
    from tidemark.operators.models import adf_test
    return adf_test(bars(spark, sf))


@query("forecast_arima")
def q_arima(spark, sf):
    """ARIMA(2,1,2) by Hannan-Rissanen, 12 steps with 95 % bands."""
    from tidemark.operators.models import forecast_arima
    fc, _ = forecast_arima(bars(spark, sf), backtest=False)
    return fc


@query("arima_backtest_metrics")
def q_arima_metrics(spark, sf):
    """80/20 backtest of ARIMA(2,1,2)."""
    from tidemark.operators.models import forecast_arima
    _, m = forecast_arima(bars(spark, sf), steps=1)
    return m


@query("forecast_sarima")
def q_sarima(spark, sf):
    """SARIMA(1,1,1)(1,1,1,48), 12 steps with 95 % bands."""
    from tidemark.operators.models import forecast_sarima
    fc, _ = forecast_sarima(bars(spark, sf), backtest=False)
    return fc


@query("forecast_trend_seasonal")
def q_trend_seasonal(spark, sf):
    """Trend + daily/weekly seasonality forecast every 30 minutes, 80 % band."""
    from tidemark.operators.models import forecast_trend_seasonal
    return forecast_trend_seasonal(bars(spark, sf))


@query("append_forecast", B + SERIES + FIT + f"""
, tl AS (SELECT symbol, CAST(least(50, n) - rd AS BIGINT) AS pos, price AS value, 'history' AS kind FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY snapshot_time DESC) AS rd,
         count(*) OVER (PARTITION BY symbol) AS n FROM bars WHERE price IS NOT NULL) WHERE rd <= 50),
m AS (SELECT symbol, count(*) AS m FROM tl GROUP BY symbol)
SELECT symbol, pos, {fix6_sql('value')} AS value, kind FROM tl
UNION ALL SELECT fc2.symbol, CAST(m.m + fc2.step AS BIGINT), {fix6_sql('yhat')}, 'forecast' FROM fc2 JOIN m USING (symbol)""")
def q_append_forecast(spark, sf):
    """C8 (continuous form): last 50 values then the 12 forecasts at the following positions."""
    fc, _ = _linear(spark, sf)
    out = TS.append_forecast(bars(spark, sf), fc)
    return out.withColumn("value", fix6("value"))
