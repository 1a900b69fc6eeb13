"""Tier 3: calendar, per-entity returns/rolling, cross-section, the feature set."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.fixtures import bars, oracle_cte, panel
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.operators import features as FE
from tidemark.plans.registry import query

B = oracle_cte("bars")
P = oracle_cte("panel")
W = "(PARTITION BY symbol ORDER BY snapshot_time)"
ALPHA = 2.0 / (FE.EMA_SPAN + 1.0)


def _frame(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY snapshot_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _pct(cur: str, lag: int, c: str = "price") -> str:
    return f"{cur} / nullif(LAG({c}, {lag}) OVER {W}, 0) - 1"


CAL_SQL = {
    "hour": "CAST(hour(snapshot_time) AS INTEGER)", "day": "CAST(day(snapshot_time) AS INTEGER)",
    "week": "CAST(week(snapshot_time) AS INTEGER)", "month": "CAST(month(snapshot_time) AS INTEGER)",
    "quarter": "CAST(quarter(snapshot_time) AS INTEGER)", "year": "CAST(year(snapshot_time) AS INTEGER)",
    "weekday": "dayname(snapshot_time)", "is_weekend": "isodow(snapshot_time) IN (6, 7)",
    "is_business_hour": "hour(snapshot_time) BETWEEN 9 AND 17",
}


def returns_sql(src: str) -> str:
    """Stage 1 (lags, rolling) and stage 2 (frames over hourly_return) as CTEs r1, r2."""
    cols = [f"{_pct('price', 2)} AS hourly_return", f"{_pct('price', 48)} AS daily_return",
            f"{_pct('price', 336)} AS weekly_return"]
    for n in FE.ROLLING_WINDOWS:
        cols += [f"AVG(price) OVER {_frame(n)} AS rolling_mean_{n}",
                 f"quantile_cont(price, 0.5) OVER {_frame(n)} AS rolling_median_{n}",
                 f"stddev_samp(price) OVER {_frame(n)} AS rolling_std_{n}"]
    cols += [f"AVG(price) OVER {_frame(12)} AS moving_average_12",
             f"list_reduce(list(price) OVER {_frame(FE.EMA_TERMS)}, "
             f"lambda acc, x: acc * {1.0 - ALPHA!r} + x * {ALPHA!r}) AS ema_12",
             f"price - LAG(price, 1) OVER {W} AS price_momentum",
             f"(price - LAG(price, 1) OVER {W}) - (LAG(price, 1) OVER {W} - LAG(price, 2) OVER {W}) AS price_acceleration",
             f"(price - LAG(price, 1) OVER {W}) / nullif((epoch_us(snapshot_time) - epoch_us(LAG(snapshot_time, 1) OVER {W})) / 1e6, 0) AS price_change_velocity",
             f"{_pct('volume_24h', 1, 'volume_24h')} AS volume_growth",
             f"{_pct('market_cap', 1, 'market_cap')} AS market_cap_growth"]
    r2 = [f"stddev_samp(hourly_return) OVER {_frame(12)} AS volatility",
          f"stddev_samp(hourly_return) OVER {_frame(24)} AS rolling_volatility_24",
          f"CASE WHEN count(hourly_return) OVER {_frame(24)} >= 2 THEN AVG(hourly_return) OVER {_frame(24)} "
          f"/ nullif(stddev_samp(hourly_return) OVER {_frame(24)}, 0) END AS sharpe_ratio_simplified",
          "coalesce(hourly_return, 0.0) * 0.4 + coalesce(daily_return, 0.0) * 0.6 AS momentum_score"]
    return (f", r1 AS (SELECT *, {', '.join(cols)} FROM {src}),\n"
            f"r2 AS (SELECT *, {', '.join(r2)} FROM r1)\n")


FIXED = {"hourly_return", "daily_return", "weekly_return", "price_momentum", "price_acceleration",
         "price_change_velocity", "volume_growth", "market_cap_growth", "momentum_score"}
ROLLING = [f"{k}_{n}" for n in FE.ROLLING_WINDOWS for k in ("rolling_mean", "rolling_median", "rolling_std")]
ALL_RETURN = ["hourly_return", "daily_return", "weekly_return", *ROLLING, "moving_average_12", "ema_12",
              "price_momentum", "price_acceleration", "price_change_velocity", "volatility",
              "rolling_volatility_24", "volume_growth", "market_cap_growth", "sharpe_ratio_simplified",
              "momentum_score"]


def _sel_sql(cols):
    return ", ".join(c if c in FIXED else f"{fix6_sql(c)} AS {c}" for c in cols)


def _sel(df, cols, keys=("symbol", "snapshot_time")):
    return df.select(*keys, *[F.col(c) if c in FIXED else fix6(c).alias(c) for c in cols])


def _returns(spark, sf):
    return FE.add_return_features(bars(spark, sf))


def _rq(name, cols, doc):
    @query(name, B + returns_sql("bars") + f"SELECT symbol, snapshot_time, {_sel_sql(cols)} FROM r2")
    def q(spark, sf):
        return _sel(_returns(spark, sf), cols)
    q.__doc__ = doc
    return q


_rq("returns", ["hourly_return", "daily_return", "weekly_return"], "E1: 2-, 48-, 336-row returns on hourly bars.")
_rq("rolling_stats", ROLLING + ["moving_average_12"], "E2-E5: rolling mean/median/std over 3, 6, 12, 24 rows.")
_rq("ema_12", ["ema_12"], "E6: exponential moving average, span 12, adjust=False.")
_rq("momentum", ["price_momentum", "price_acceleration", "price_change_velocity"], "E7-E9: first, second difference and per-second velocity.")
_rq("volatility", ["volatility", "rolling_volatility_24", "sharpe_ratio_simplified"], "E10, E11, E13: std of hourly returns over 12/24 rows and the simplified Sharpe ratio.")
_rq("growth", ["volume_growth", "market_cap_growth"], "E12: one-step volume and cap growth.")
_rq("momentum_score", ["momentum_score"], "E14: 0.4 hourly + 0.6 daily return, missing as 0.")


@query("timestamp_features", B + "SELECT symbol, snapshot_time, " +
       ", ".join(f"{v} AS {k}" for k, v in CAL_SQL.items()) + " FROM bars")
def q_timestamp(spark, sf):
    """Calendar fields, weekend and business-hour flags."""
    return FE.add_timestamp_features(bars(spark, sf)).select("symbol", "snapshot_time", *CAL_SQL)


@query("seconds_between_rows", B + f"""
SELECT symbol, snapshot_time, (epoch_us(snapshot_time) - epoch_us(LAG(snapshot_time) OVER {W})) / 1e6 AS seconds_since_prev
FROM bars""")
def q_seconds(spark, sf):
    """Seconds between consecutive rows of an entity (sub-second kept)."""
    from tidemark.operators.series import with_entity_windows

    def build(fr, w):
        prev = F.lag("snapshot_time", 1).over(w)
        return fr.withColumn("seconds_since_prev",
                             (F.unix_micros("snapshot_time") - F.unix_micros(prev)) / F.lit(1e6))
    return with_entity_windows(bars(spark, sf).select("symbol", "snapshot_time"), build, lookback=1)


MS_SQL = """
, agg AS (SELECT snapshot_time, sum(market_cap) AS tc, sum(volume_24h) AS tv,
            max(CASE WHEN symbol = 'BTC' THEN {m} END) AS bv, bool_or(symbol = 'BTC') AS hb,
            quantile_cont({m}, 0.5) AS med FROM {src} GROUP BY snapshot_time),
ms AS (SELECT s.*, s.market_cap / nullif(tc, 0) AS market_dominance, s.market_cap / nullif(tc, 0) AS market_cap_share,
          s.volume_24h / nullif(tv, 0) AS volume_share, s.volume_24h / nullif(s.market_cap, 0) AS volume_to_marketcap_ratio,
          CAST(RANK() OVER (PARTITION BY s.snapshot_time ORDER BY s.price DESC) AS DOUBLE) AS price_rank,
          s.{m} - CASE WHEN hb THEN bv ELSE med END AS relative_strength_vs_btc
       FROM {src} s JOIN agg USING (snapshot_time))
"""
MS_COLS = ["market_dominance", "market_cap_share", "volume_share", "volume_to_marketcap_ratio",
           "price_rank", "relative_strength_vs_btc"]
MS_FIXED = {"volume_to_marketcap_ratio", "price_rank", "relative_strength_vs_btc"}


def _ms_sel_sql():
    return ", ".join(c if c in MS_FIXED else f"{fix6_sql(c)} AS {c}" for c in MS_COLS)


def _ms_sel(df):
    return df.select("symbol", "snapshot_time",
                     *[F.col(c) if c in MS_FIXED else fix6(c).alias(c) for c in MS_COLS])


@query("market_structure", P + MS_SQL.format(m="percent_change_24h", src="panel") +
       f"SELECT symbol, snapshot_time, {_ms_sel_sql()} FROM ms")
def q_market_structure(spark, sf):
    """F1-F5 on the nation panel: dominance, shares, ratio, price rank, strength vs BTC."""
    return _ms_sel(FE.add_market_structure(panel(spark, sf)))


@query("relative_strength_vs_btc", B + MS_SQL.format(m="price", src="bars") +
       f"SELECT symbol, snapshot_time, {_ms_sel_sql()} FROM ms")
def q_relative_strength(spark, sf):
    """F5/C9 on hourly bars, where BTC is missing from some hours (median fallback)."""
    return _ms_sel(FE.add_market_structure(bars(spark, sf), metric="price"))


@query("rolling_correlation", B + f"""
, hr AS (SELECT symbol, snapshot_time, {_pct('price', 2)} AS hourly_return FROM bars),
pt AS (SELECT snapshot_time, avg(CASE WHEN symbol = 'BTC' THEN hourly_return END) AS a,
              avg(CASE WHEN symbol = 'ETH' THEN hourly_return END) AS b FROM hr
       GROUP BY snapshot_time HAVING count(hourly_return) > 0)
SELECT snapshot_time, CASE WHEN count(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 END) OVER f >= 24
       THEN {fix6_sql('corr(a, b) OVER f')} END AS rolling_corr
FROM pt WINDOW f AS (ORDER BY snapshot_time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def q_rolling_corr(spark, sf):
    """24-row rolling correlation of BTC and ETH hourly returns."""
    out = FE.rolling_correlation(FE.add_return_features(bars(spark, sf)))
    return out.withColumn("rolling_corr", fix6("rolling_corr"))


def feature_set_sql(src: str, fixture_cte: str) -> str:
    cal = ", ".join(f"{v} AS {k}" for k, v in CAL_SQL.items())
    return (fixture_cte + f", cal AS (SELECT *, {cal} FROM {src})\n" + returns_sql("cal")
            + MS_SQL.format(m="percent_change_24h", src="r2"))


FEATURE_COLS = list(CAL_SQL) + ALL_RETURN + MS_COLS


def feature_select_sql():
    fixed = FIXED | MS_FIXED | set(CAL_SQL)
    return ", ".join(c if c in fixed else f"{fix6_sql(c)} AS {c}" for c in FEATURE_COLS)


def feature_select(df):
    fixed = FIXED | MS_FIXED | set(CAL_SQL)
    return df.select("symbol", "snapshot_time", "price",
                     *[F.col(c) if c in fixed else fix6(c).alias(c) for c in FEATURE_COLS])


@query("build_feature_set", feature_set_sql("panel", P) + f"SELECT symbol, snapshot_time, price, {feature_select_sql()} FROM ms")
def q_feature_set(spark, sf):
    """M1: calendar → per-entity returns/rolling → cross-section, all 41 added columns."""
    return feature_select(FE.build_feature_set(panel(spark, sf)))


# One query per inventory line of the per-entity and cross-section features.
_rq("rolling_mean", [f"rolling_mean_{n}" for n in FE.ROLLING_WINDOWS], "E2: rolling mean over 3, 6, 12, 24 rows.")
_rq("rolling_median", [f"rolling_median_{n}" for n in FE.ROLLING_WINDOWS], "E3: rolling interpolated median.")
_rq("rolling_std", [f"rolling_std_{n}" for n in FE.ROLLING_WINDOWS], "E4: rolling sample std (NULL on one row).")
_rq("moving_average_12", ["moving_average_12"], "E5: 12-row moving average.")
_rq("price_momentum", ["price_momentum"], "E7: first difference of price.")
_rq("price_acceleration", ["price_acceleration"], "E8: second difference of price.")
_rq("price_change_velocity", ["price_change_velocity"], "E9: price change per second.")
_rq("rolling_volatility_24", ["rolling_volatility_24"], "E11: std of hourly returns over 24 rows.")
_rq("sharpe_ratio_simplified", ["sharpe_ratio_simplified"], "E13: mean/std of hourly returns over 24 rows.")
_rq("volume_growth", ["volume_growth", "market_cap_growth"], "E12: one-step volume and cap growth.")


def _msq(name, cols, doc):
    sel = ", ".join(c if c in MS_FIXED else f"{fix6_sql(c)} AS {c}" for c in cols)

    @query(name, P + MS_SQL.format(m="percent_change_24h", src="panel") + f"SELECT symbol, snapshot_time, {sel} FROM ms")
    def q(spark, sf):
        out = FE.add_market_structure(panel(spark, sf))
        return out.select("symbol", "snapshot_time", *[F.col(c) if c in MS_FIXED else fix6(c).alias(c) for c in cols])
    q.__doc__ = doc
    return q


_msq("market_dominance", ["market_dominance", "market_cap_share"], "F1: cap share of the snapshot total.")
_msq("volume_share", ["volume_share"], "F2: volume share of the snapshot total.")
_msq("volume_to_marketcap_ratio", ["volume_to_marketcap_ratio"], "F3: volume / cap.")
_msq("price_rank", ["price_rank"], "F4: descending price rank in the snapshot, ties share the lowest.")


@query("rounding_functions", P + """
SELECT snapshot_time, CAST(sum(CAST(percent_change_24h > 0 AS INTEGER)) AS BIGINT) AS n_up,
       round_even(avg(volume_24h) / 7.0, 2) AS volume_round2 FROM panel GROUP BY snapshot_time""")
def q_rounding(spark, sf):
    """Half-even rounding to 2 decimals and boolean sums."""
    p = panel(spark, sf)
    return p.groupBy("snapshot_time").agg(
        F.sum((F.col("percent_change_24h") > 0).cast("int")).cast("bigint").alias("n_up"),
        F.bround(F.avg("volume_24h") / 7.0, 2).alias("volume_round2"))
