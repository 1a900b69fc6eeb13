"""Tier 4: KPIs, insights, top-n tables, summaries, pipeline compositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.fixtures import bars, dirty_tape, oracle_cte, panel, tape
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.operators import anomaly as A
from tidemark.operators import features as FE
from tidemark.operators import reports as R
from tidemark.operators import snapshots as S
from tidemark.plans.q_anomaly import _pipeline_sql, lof_sql
from tidemark.plans.q_cleaning import NOW, STAGES
from tidemark.plans.q_features import feature_set_sql
from tidemark.plans.registry import query

P = oracle_cte("panel")
FLAGS = ", ".join(f"ap4.{c}" for c in ["is_flash_crash", "is_price_spike", "is_volume_spike", "is_market_cap_anomaly",
                                        "is_isolation_forest_anomaly", "is_lof_anomaly", "anomaly_score",
                                        "is_any_anomaly"])


def final_sql(src: str = "panel", prefix: str = P) -> str:
    """CTEs up to ``fin`` (features + anomalies) and ``lt`` (its latest snapshot)."""
    return (feature_set_sql(src, prefix) + lof_sql("ms") + _pipeline_sql("ms")
            + f", fin AS (SELECT ms.*, {FLAGS} FROM ms JOIN ap4 USING (symbol, snapshot_time)),\n"
            "lt AS (SELECT * FROM fin WHERE snapshot_time = (SELECT max(snapshot_time) FROM fin))\n")


def final_panel(spark, sf):
    return A.run_anomaly_pipeline(FE.build_feature_set(panel(spark, sf)))


def latest_final(spark, sf):
    return S.latest_snapshot(final_panel(spark, sf))


KPI_SQL = """
SELECT 0 AS ord, 'BTC Price' AS label, CASE WHEN bool_or(symbol = 'BTC')
  THEN '$' || format('{:,.2f}', max(CASE WHEN symbol = 'BTC' THEN price END)) ELSE 'N/A' END AS value FROM lt
UNION ALL SELECT 1, 'Total Market Cap', '$' || format('{:,.0f}', sum(market_cap)) FROM lt
UNION ALL SELECT 2, '24H Volume', '$' || format('{:,.0f}', sum(volume_24h)) FROM lt
UNION ALL SELECT 3, 'Number of Coins', CAST(count(*) AS VARCHAR) FROM lt
UNION ALL SELECT 4, 'Top Gainer', first(symbol ORDER BY percent_change_24h DESC NULLS LAST, symbol)
  || ' (' || format('{:.2f}', max(percent_change_24h)) || '%)' FROM lt
UNION ALL SELECT 5, 'Top Loser', first(symbol ORDER BY percent_change_24h ASC NULLS LAST, symbol)
  || ' (' || format('{:.2f}', min(percent_change_24h)) || '%)' FROM lt
UNION ALL SELECT 6, 'Largest Market Cap', first(symbol ORDER BY market_cap DESC NULLS LAST, symbol) FROM lt
UNION ALL SELECT 7, 'Most Volatile', first(symbol ORDER BY volatility DESC NULLS LAST, symbol) FROM lt
  HAVING count(volatility) > 0
"""

INSIGHT_SQL = """
SELECT 0 AS ord, 'market_direction' AS label, 'The market is broadly ' ||
  CASE WHEN avg(percent_change_24h) > 0 THEN 'up' ELSE 'down' END || ' on average (' ||
  format('{:.2f}', avg(percent_change_24h)) || '% over 24h across tracked coins).' AS value FROM lt
UNION ALL SELECT 1, 'top3_dominance', 'The top 3 coins by market cap (' || names || ') control '
  || format('{:.1f}', comb * 100.0) || '% of total tracked market cap.'
  FROM (SELECT string_agg(symbol, ', ' ORDER BY market_dominance DESC NULLS LAST, symbol) AS names,
               list_reduce(list(market_dominance ORDER BY market_dominance DESC NULLS LAST, symbol),
                           lambda a, x: a + x) AS comb
        FROM (SELECT * FROM lt ORDER BY market_dominance DESC NULLS LAST, symbol LIMIT 3))
  WHERE comb IS NOT NULL AND comb * 100.0 <> 0
UNION ALL SELECT 2, 'anomalies', CAST(n AS VARCHAR) || ' coin(s) triggered anomaly flags in the latest snapshot '
  || '(flash crash, spike, or statistical outlier).'
  FROM (SELECT sum(CAST(is_any_anomaly AS INTEGER)) AS n FROM lt) WHERE coalesce(n, 0) <> 0
UNION ALL SELECT 3, 'liquidity', 'Average volume/market-cap ratio is ' || format('{:.2f}', r)
  || ', indicating overall market liquidity.'
  FROM (SELECT avg(volume_to_marketcap_ratio) AS r FROM lt) WHERE r IS NOT NULL AND r <> 0
"""


@query("kpis", final_sql() + KPI_SQL)
def q_kpis(spark, sf):
    """KPI cards on the latest snapshot of the processed panel."""
    return R.compute_kpis(latest_final(spark, sf))


@query("insights", final_sql() + INSIGHT_SQL)
def q_insights(spark, sf):
    """Narrative lines on the latest snapshot of the processed panel."""
    return R.generate_insights(latest_final(spark, sf))


@query("number_formats", P + f"""
SELECT symbol, '$' || format('{{:,.0f}}', market_cap) AS cap_text, format('{{:,.2f}}', price) AS price_text,
       format('{{:.2f}}', percent_change_24h) AS change_text, format('{{:.1f}}', volume_24h / 7.0) AS ratio_text
FROM panel WHERE snapshot_time = (SELECT max(snapshot_time) FROM panel)""")
def q_formats(spark, sf):
    """I8: ',.0f', ',.2f', '.2f', '.1f' number formats."""
    lt = S.latest_snapshot(panel(spark, sf))
    return lt.select("symbol", F.concat(F.lit("$"), R.fmt_grouped("market_cap", 0)).alias("cap_text"),
                     R.fmt_grouped("price", 2).alias("price_text"),
                     R.fmt_fixed("percent_change_24h", 2).alias("change_text"),
                     R.fmt_fixed(F.col("volume_24h") / 7.0, 1).alias("ratio_text"))


def _top_sql(metric, asc, n, cols="symbol, name, price, percent_change_24h, market_cap"):
    order = "ASC" if asc else "DESC"
    return P + f"""SELECT {cols} FROM panel WHERE snapshot_time = (SELECT max(snapshot_time) FROM panel)
ORDER BY {metric} {order} NULLS LAST, symbol LIMIT {n}"""


TOP_COLS = ["symbol", "name", "price", "percent_change_24h", "market_cap"]


@query("top_n_gainers_20", _top_sql("percent_change_24h", False, 20))
def q_top20_gain(spark, sf):
    """Workbook sheet, 20 best 24h changes."""
    return R.top_n_tables(S.latest_snapshot(panel(spark, sf)))["top_gainers"].select(*TOP_COLS)


@query("top_n_losers_20", _top_sql("percent_change_24h", True, 20))
def q_top20_lose(spark, sf):
    """Workbook sheet, 20 worst 24h changes."""
    return R.top_n_tables(S.latest_snapshot(panel(spark, sf)))["top_losers"].select(*TOP_COLS)


@query("top_n_market_cap", _top_sql("market_cap", False, 20))
def q_top20_cap(spark, sf):
    """20 largest market caps."""
    return R.top_n_tables(S.latest_snapshot(panel(spark, sf)))["top_market_cap"].select(*TOP_COLS)


@query("top3_market_cap", _top_sql("market_cap", False, 3, "symbol, market_cap"))
def q_top3_cap(spark, sf):
    """H3: the three largest caps (insight sentence)."""
    return S.top_movers(S.latest_snapshot(panel(spark, sf)), "market_cap", 3, cols=["symbol", "market_cap"])


@query("rank_by_metric", P + """
SELECT symbol, name, price, volume_24h FROM panel WHERE snapshot_time = (SELECT max(snapshot_time) FROM panel)
ORDER BY volume_24h DESC NULLS LAST, symbol""")
def q_rank_by_metric(spark, sf):
    """H4: latest snapshot ranked by a chosen (validated) metric."""
    return S.rank_by_metric(S.latest_snapshot(panel(spark, sf)), "volume_24h")


@query("tail_n", oracle_cte("bars") + """
SELECT symbol, snapshot_time, price, CAST(least(50, n) - rd AS BIGINT) AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY snapshot_time DESC) AS rd,
         count(*) OVER (PARTITION BY symbol) AS n FROM bars WHERE price IS NOT NULL) WHERE rd <= 50""")
def q_tail(spark, sf):
    """H6: last 50 prices per symbol, renumbered from 0."""
    return R.tail_n(bars(spark, sf))


@query("arg_extreme", P + """
SELECT snapshot_time, first(symbol ORDER BY percent_change_24h DESC NULLS LAST, symbol) AS top_symbol,
       max(percent_change_24h) AS top_change,
       first(symbol ORDER BY percent_change_24h ASC NULLS LAST, symbol) AS bottom_symbol,
       min(percent_change_24h) AS bottom_change FROM panel GROUP BY snapshot_time""")
def q_arg_extreme(spark, sf):
    """H7: the row at the max and at the min of a column, per snapshot."""
    p = panel(spark, sf)
    out = p.groupBy("snapshot_time").agg(R.arg_max_row("percent_change_24h", ["symbol", "percent_change_24h"]).alias("t"),
                                         R.arg_min_row("percent_change_24h", ["symbol", "percent_change_24h"]).alias("b"))
    return out.select("snapshot_time", F.col("t.symbol").alias("top_symbol"),
                      F.col("t.percent_change_24h").alias("top_change"),
                      F.col("b.symbol").alias("bottom_symbol"), F.col("b.percent_change_24h").alias("bottom_change"))


@query("min_history_gate", oracle_cte("tape") + """
SELECT symbol, snapshot_time FROM tape WHERE symbol IN (
  SELECT symbol FROM tape GROUP BY symbol HAVING count(price) >= 70)""")
def q_min_history(spark, sf):
    """Only entities with enough non-null history (70 here; 20 in the dashboard) go on."""
    return R.min_history_gate(tape(spark, sf), 70).select("symbol", "snapshot_time")


@query("run_summary", final_sql() + """
SELECT 'success' AS status, (SELECT count(*) FROM (SELECT DISTINCT coin_id, snapshot_time FROM panel)) AS rows_inserted,
  (SELECT count(*) FROM panel) AS total_rows_in_db, count(*) AS coins_in_latest_snapshot,
  CAST(coalesce(sum(CAST(is_any_anomaly AS INTEGER)), 0) AS BIGINT) AS anomalies_flagged FROM lt""")
def q_run_summary(spark, sf):
    """Inserted / stored / latest / flagged counts after a cycle."""
    p = panel(spark, sf)
    inserted = p.select("coin_id", "snapshot_time").distinct().select(F.count(F.lit(1))).scalar()
    return R.run_summary(p, final_panel(spark, sf), inserted)


@query("report_bundle", final_sql() + """
SELECT 'period' AS section, 0 AS ord, 'Period' AS label, 'Daily' AS value
UNION ALL SELECT 'kpi', ord, label, value FROM (""" + KPI_SQL + """)
UNION ALL SELECT 'insight', ord, label, value FROM (""" + INSIGHT_SQL + """)
UNION ALL SELECT 'gainers', CAST(row_number() OVER (ORDER BY percent_change_24h DESC NULLS LAST, symbol) - 1 AS INTEGER),
  symbol, name || ' | ' || format('{:,.2f}', price) || ' | ' || format('{:,.2f}', percent_change_24h)
  FROM (SELECT * FROM lt ORDER BY percent_change_24h DESC NULLS LAST, symbol LIMIT 10)
UNION ALL SELECT 'losers', CAST(row_number() OVER (ORDER BY percent_change_24h ASC NULLS LAST, symbol) - 1 AS INTEGER),
  symbol, name || ' | ' || format('{:,.2f}', price) || ' | ' || format('{:,.2f}', percent_change_24h)
  FROM (SELECT * FROM lt ORDER BY percent_change_24h ASC NULLS LAST, symbol LIMIT 10)""")
def q_bundle(spark, sf):
    """M5: period, KPIs, insights, 10 gainers, 10 losers as one table."""
    return R.report_bundle(latest_final(spark, sf))


DASH_COLS = ["hourly_return", "volatility", "market_dominance", "relative_strength_vs_btc"]


def _dash_spark(spark, sf):
    from tidemark.operators.cleaning import clean_pipeline
    clean = clean_pipeline(dirty_tape(spark, sf), now=NOW)
    return A.run_anomaly_pipeline(FE.build_feature_set(clean))


@query("dashboard_load", final_sql("checked", STAGES) + """
SELECT symbol, snapshot_time, price, hourly_return, """ + fix6_sql("volatility") + " AS volatility, "
       + fix6_sql("market_dominance") + """ AS market_dominance, relative_strength_vs_btc, anomaly_score, is_any_anomaly
FROM fin""")
def q_dashboard_load(spark, sf):
    """M4: scan → clean → features → anomalies, the dashboard's data (dirty tape)."""
    out = _dash_spark(spark, sf)
    return out.select("symbol", "snapshot_time", "price", "hourly_return", fix6("volatility").alias("volatility"),
                      fix6("market_dominance").alias("market_dominance"), "relative_strength_vs_btc",
                      "anomaly_score", "is_any_anomaly")


@query("run_pipeline", final_sql("checked", STAGES) + """
SELECT 'success' AS status, (SELECT count(*) FROM (SELECT DISTINCT coin_id, snapshot_time FROM dirty_tape)) AS rows_inserted,
  (SELECT count(*) FROM dirty_tape) AS total_rows_in_db, count(*) AS coins_in_latest_snapshot,
  CAST(coalesce(sum(CAST(is_any_anomaly AS INTEGER)), 0) AS BIGINT) AS anomalies_flagged FROM lt""")
def q_run_pipeline(spark, sf):
    """M3: one cycle — store, clean, features, anomalies — and its summary row."""
    raw = dirty_tape(spark, sf)
    inserted = raw.select("coin_id", "snapshot_time").distinct().select(F.count(F.lit(1))).scalar()
    return R.run_summary(raw, _dash_spark(spark, sf), inserted)


@query("run_pipeline_latest", final_sql() + """
SELECT symbol, snapshot_time, price, percent_change_24h, """ + fix6_sql("market_dominance") + """ AS market_dominance,
       anomaly_score, is_any_anomaly FROM lt""")
def q_pipeline_latest(spark, sf):
    """Flagship: features + anomalies over the panel, latest snapshot."""
    lt = latest_final(spark, sf)
    return lt.select("symbol", "snapshot_time", "price", "percent_change_24h",
                     fix6("market_dominance").alias("market_dominance"), "anomaly_score", "is_any_anomaly")
