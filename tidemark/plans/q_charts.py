"""Tier 5: chart data frames."""

from __future__ import annotations

from tidemark.fixtures import bars, dirty_tape, oracle_cte, panel, tape
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.operators import charts as CH
from tidemark.operators import features as FE
from tidemark.operators import snapshots as S
from tidemark.plans.q_features import returns_sql
from tidemark.plans.registry import query

P = oracle_cte("panel")
B = oracle_cte("bars")
LATEST = "(SELECT max(snapshot_time) FROM panel)"


@query("weekday_hour_matrix", B + f"""
SELECT dayname(snapshot_time) AS weekday, CAST(isodow(snapshot_time) - 1 AS INTEGER) AS weekday_ord,
       CAST(hour(snapshot_time) AS INTEGER) AS hour, {fix6_sql('avg(price)')} AS avg_value
FROM bars WHERE symbol = 'BTC' GROUP BY 1, 2, 3""")
def q_weekday_hour(spark, sf):
    """Mean value by weekday x hour for one symbol (long form; the operator also pivots)."""
    out = CH.weekday_hour_matrix(bars(spark, sf), "BTC", value="price", long=True)
    return out.withColumn("avg_value", fix6("avg_value"))


@query("ohlc_bars", oracle_cte("tape") + """
, b AS (SELECT symbol, date_trunc('hour', snapshot_time) AS h, arg_min(price, snapshot_time) AS open,
               max(price) AS high, min(price) AS low, arg_max(price, snapshot_time) AS close
        FROM tape WHERE price IS NOT NULL GROUP BY 1, 2),
sp AS (SELECT symbol, min(h) AS lo, max(h) AS hi FROM b GROUP BY 1),
g AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM sp)
SELECT g.symbol, g.h AS snapshot_time, open, high, low, close FROM g LEFT JOIN b USING (symbol, h)""")
def q_ohlc(spark, sf):
    """Hourly OHLC per user on the raw tape, empty hours kept with NULLs."""
    return CH.ohlc_bars(tape(spark, sf), "1 hour")


@query("distribution_histogram", P + """
, st AS (SELECT count(price) AS n, min(price) AS lo, max(price) AS hi,
                quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM panel),
k AS (SELECT *, CAST(ceil((hi - lo) / CASE WHEN 2.0 * (q3 - q1) * pow(n, -1.0 / 3.0) > 0
        THEN least(2.0 * (q3 - q1) * pow(n, -1.0 / 3.0), (hi - lo) / (log2(n) + 1.0))
        ELSE (hi - lo) / (log2(n) + 1.0) END) AS INTEGER) AS nb FROM st),
w AS (SELECT *, (hi - lo) / nb AS width FROM k),
c AS (SELECT CAST(least(floor((price - (SELECT lo FROM w)) / (SELECT width FROM w)), (SELECT nb FROM w) - 1)
             AS INTEGER) AS bin, count(*) AS cnt FROM panel WHERE price IS NOT NULL GROUP BY 1),
g AS (SELECT unnest(range(nb)) AS bin, lo, width FROM w)
SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * width AS "left", lo + (g.bin + 1) * width AS "right",
       CAST(coalesce(cnt, 0) AS BIGINT) AS count
FROM g LEFT JOIN c ON g.bin = c.bin""")
def q_histogram(spark, sf):
    """Equal-width histogram of price, bin count by numpy's 'auto' rule."""
    return CH.histogram(panel(spark, sf), "price")


@query("distribution_kde", P + f"""
, st AS (SELECT count(price) AS n, min(price) AS lo, max(price) AS hi, stddev_samp(price) AS sd FROM panel),
w AS (SELECT *, sd * pow(n, -0.2::DOUBLE) AS h, (hi - lo) / 4096 AS width FROM st),
fine AS (SELECT lo + (b + 0.5::DOUBLE) * width AS centre, c FROM (SELECT least(floor((price - w.lo) / w.width), 4095) AS b, count(*) AS c
         FROM panel, w WHERE price IS NOT NULL GROUP BY 1), w),
grid AS (SELECT lo + g * ((hi - lo) / 199) AS x, h, n FROM w, (SELECT unnest(range(200)) AS g))
SELECT {fix6_sql('x')} AS x, {fix6_sql("sum(c * exp(-0.5::DOUBLE * ((x - centre) / h) * ((x - centre) / h))) / (any_value(n) * any_value(h) * 2.5066282746310002) * 1e9")} AS density_e9
FROM grid, fine GROUP BY x""")
def q_kde(spark, sf):
    """Gaussian KDE (Scott bandwidth) of price on a 200-point grid; densities times 10^9."""
    out = CH.kde_curve(panel(spark, sf), "price")
    return out.select(fix6("x").alias("x"), fix6(out.density * 1e9).alias("density_e9"))


@query("missing_matrix", oracle_cte("dirty_tape") + """
SELECT ingest_ord, symbol IS NULL AS symbol_missing, price IS NULL AS price_missing,
       market_cap IS NULL AS market_cap_missing, volume_24h IS NULL AS volume_24h_missing,
       percent_change_24h IS NULL AS percent_change_24h_missing FROM dirty_tape""")
def q_missing_matrix(spark, sf):
    """Null indicator per cell."""
    return CH.missing_matrix(dirty_tape(spark, sf), "ingest_ord",
                             ["symbol", "price", "market_cap", "volume_24h", "percent_change_24h"])


@query("missing_rate_by_bucket", oracle_cte("dirty_tape") + """
SELECT date_trunc('day', snapshot_time) AS bucket, avg(CASE WHEN price IS NULL THEN 1.0 ELSE 0.0 END) AS price_missing_rate,
       avg(CASE WHEN market_cap IS NULL THEN 1.0 ELSE 0.0 END) AS market_cap_missing_rate FROM dirty_tape GROUP BY 1""")
def q_missing_rate(spark, sf):
    """D18 at scale: null rate per day and column."""
    return CH.missing_rate_by_bucket(dirty_tape(spark, sf), cols=["price", "market_cap"])


@query("dominance_hierarchy", P + f"""
, top AS (SELECT 'Market' AS grp, symbol, market_cap FROM panel WHERE snapshot_time = {LATEST}
          ORDER BY market_cap DESC NULLS LAST, symbol LIMIT 20)
SELECT grp AS "group", symbol, {fix6_sql('sum(market_cap)')} AS market_cap FROM top
GROUP BY ROLLUP (grp, symbol) HAVING GROUPING(grp, symbol) < 3""")
def q_dominance(spark, sf):
    """Top-20 caps under a root level (ROLLUP)."""
    out = CH.dominance_hierarchy(S.latest_snapshot(panel(spark, sf)))
    return out.withColumn("market_cap", fix6("market_cap"))


@query("chart_price_line", P + "SELECT snapshot_time, price FROM panel WHERE symbol = 'BTC' ORDER BY snapshot_time")
def q_chart_line(spark, sf):
    """M6: line/area chart data for one symbol."""
    return CH.price_series(panel(spark, sf), "BTC")


@query("chart_compare", P + "SELECT snapshot_time, symbol, price FROM panel WHERE symbol IN ('BTC', 'ETH')")
def q_chart_compare(spark, sf):
    """M6: two symbols on one chart (comparison mode)."""
    return CH.compare_series(panel(spark, sf), ["BTC", "ETH"])


@query("chart_bubble", P + f"""
SELECT symbol, name, volume_24h, {fix6_sql('log10(volume_24h)')} AS log_volume, percent_change_24h, market_cap
FROM panel WHERE snapshot_time = {LATEST}""")
def q_chart_bubble(spark, sf):
    """M6: bubble chart (log volume, change, cap)."""
    out = CH.bubble_frame(S.latest_snapshot(panel(spark, sf)))
    return out.withColumn("log_volume", fix6("log_volume"))


@query("chart_treemap", P + f"""
SELECT symbol, market_cap, percent_change_24h FROM panel WHERE snapshot_time = {LATEST}
ORDER BY market_cap DESC NULLS LAST, symbol LIMIT 30""")
def q_chart_treemap(spark, sf):
    """M6/H3: treemap of the top 30 caps."""
    return CH.treemap_frame(S.latest_snapshot(panel(spark, sf)))


@query("chart_movers_bar", P + f"""
SELECT * FROM (SELECT symbol, percent_change_24h FROM panel WHERE snapshot_time = {LATEST}
  ORDER BY percent_change_24h DESC NULLS LAST, symbol LIMIT 10)
UNION ALL SELECT * FROM (SELECT symbol, percent_change_24h FROM panel WHERE snapshot_time = {LATEST}
  ORDER BY percent_change_24h ASC NULLS LAST, symbol LIMIT 10)""")
def q_chart_movers(spark, sf):
    """M6/H2: gainers and losers bar data."""
    g, l = CH.movers_bar_frames(S.latest_snapshot(panel(spark, sf)))
    return g.unionByName(l)


@query("chart_rolling_volatility", B + returns_sql("bars") + f"""
SELECT snapshot_time, {fix6_sql('rolling_volatility_24')} AS rolling_volatility_24 FROM r2 WHERE symbol = 'BTC'""")
def q_chart_vol(spark, sf):
    """One symbol's 24-row rolling volatility."""
    out = CH.price_series(FE.add_return_features(bars(spark, sf)), "BTC", value="rolling_volatility_24")
    return out.withColumn("rolling_volatility_24", fix6("rolling_volatility_24"))


@query("chart_correlation_latest", P + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN NOT isnan(corr({a}, {b})) THEN {fix6_sql(f'corr({a}, {b})')} END AS corr "
    f"FROM panel WHERE snapshot_time = {LATEST}"
    for a in ["price", "market_cap", "volume_24h", "percent_change_24h", "circulating_supply"]
    for b in ["price", "market_cap", "volume_24h", "percent_change_24h", "circulating_supply"]))
def q_chart_corr(spark, sf):
    """Correlation heatmap of the latest snapshot."""
    from tidemark.operators.stats import correlation_matrix
    return correlation_matrix(S.latest_snapshot(panel(spark, sf))).withColumn("corr", fix6("corr"))


from tidemark.plans.registry import alias  # noqa: E402

# Inventory names for checks registered under other names above or elsewhere.
alias("chart_frames", "chart_bubble")
alias("stitch_tail_and_forecast", "stitch_tail_forecast")
alias("benchmark_broadcast", "relative_strength_vs_btc")
alias("distinct_aggregate", "distinct_times")
alias("dedup_keep_last", "dedup_keep_last_id")
alias("top_n_report", "top_n_gainers_20")
alias("outlier_isolation_forest", "isolation_forest_outliers")
alias("decompose", "decompose_series")
alias("group_zscore_volume", "volume_spike")
alias("group_zscore_cap", "market_cap_anomaly")
alias("market_cap_share", "market_dominance")
alias("is_any_anomaly", "anomaly_score")
alias("add_timestamp_features", "timestamp_features")
alias("json_decode", "decode_nested_quotes")
