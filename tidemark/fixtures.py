"""Adapters from the driver's tables to snapshot panels.

Each adapter is one SELECT that both Spark SQL and DuckDB accept. Spark binds
the table placeholders to DataFrames read from ``sf_dir`` (no global views, so
several scale factors can live in one session); the oracle inlines the same
text as a CTE over DuckDB's pre-registered views. Money is summed as
DECIMAL(12,2) so sums do not depend on row order in either engine.

Fixtures:
  panel       nations x months (cross-sections, latest, ranks, the SQL library)
  wide_panel  60 parts x 20 days, every snapshot full (top-n limits, ties, models, KPIs)
  bars        event types x hours (long lags, rolling, EMA, OHLC, forecasts)
  tape        users x raw event time (irregular spacing, z-scores, streams)
  dirty_tape  tape with planted defects (every cleaning operator)
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

PANEL_SQL = """
WITH base AS (
  SELECT CASE n_nationkey WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' ELSE n_name END AS symbol,
         n_name AS name, CAST(n_nationkey AS VARCHAR(64)) AS coin_id,
         CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS snapshot_time,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) AS price,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS market_cap,
         CAST(COUNT(*) AS DOUBLE) AS volume_24h,
         CAST(COUNT(DISTINCT o_custkey) AS DOUBLE) AS circulating_supply
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4)
SELECT symbol, snapshot_time, coin_id, name, price, market_cap, volume_24h, circulating_supply,
  CAST(ROW_NUMBER() OVER (PARTITION BY snapshot_time ORDER BY market_cap DESC, symbol) AS INT) AS cmc_rank,
  100.0E0 * (price / LAG(price, 1) OVER (PARTITION BY symbol ORDER BY snapshot_time) - 1) AS percent_change_1h,
  100.0E0 * (price / LAG(price, 2) OVER (PARTITION BY symbol ORDER BY snapshot_time) - 1) AS percent_change_24h,
  100.0E0 * (price / LAG(price, 7) OVER (PARTITION BY symbol ORDER BY snapshot_time) - 1) AS percent_change_7d,
  snapshot_time AS last_updated
FROM base
"""

WIDE_PANEL_SQL = """
WITH base AS (
  SELECT CASE l_partkey % 60 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' ELSE concat('P', CAST(l_partkey % 60 AS VARCHAR(64))) END AS symbol,
         concat('Part ', CAST(l_partkey % 60 AS VARCHAR(64))) AS name, CAST(l_partkey % 60 AS VARCHAR(64)) AS coin_id,
         CAST(DATE '2024-01-01' + CAST(l_orderkey % 20 AS INT) AS TIMESTAMP) AS snapshot_time,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) AS price,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS market_cap,
         CAST(COUNT(*) AS DOUBLE) AS volume_24h,
         CAST(COUNT(DISTINCT l_orderkey) AS DOUBLE) AS circulating_supply
  FROM {lineitem} GROUP BY 1, 2, 3, 4)
SELECT symbol, snapshot_time, coin_id, name, price, market_cap, volume_24h, circulating_supply,
  CAST(ROW_NUMBER() OVER (PARTITION BY snapshot_time ORDER BY market_cap DESC, symbol) AS INT) AS cmc_rank,
  100.0E0 * (price / LAG(price, 1) OVER (PARTITION BY symbol ORDER BY snapshot_time) - 1) AS percent_change_1h,
  100.0E0 * (price / LAG(price, 2) OVER (PARTITION BY symbol ORDER BY snapshot_time) - 1) AS percent_change_24h,
  100.0E0 * (price / LAG(price, 7) OVER (PARTITION BY symbol ORDER BY snapshot_time) - 1) AS percent_change_7d,
  snapshot_time AS last_updated
FROM base
"""

BARS_SQL = """
SELECT CASE event_type WHEN 'purchase' THEN 'BTC' WHEN 'click' THEN 'ETH' ELSE upper(event_type) END AS symbol,
  CAST(date_trunc('hour', ts) AS TIMESTAMP) AS snapshot_time,
  max_by(value, ts) AS price,
  CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS volume_24h,
  CAST(COUNT(*) AS DOUBLE) * 1000 AS market_cap
FROM {events} GROUP BY 1, 2
"""

TAPE_SQL = """
SELECT event_id AS ingest_ord, CAST(user_id AS VARCHAR(64)) AS coin_id,
  concat('U', CAST(user_id AS VARCHAR(64))) AS symbol, ts AS snapshot_time, value AS price,
  CAST({json_get}(props, '$.k') AS DOUBLE) AS volume_24h, event_type
FROM {events}
"""

DIRTY_TAPE_SQL = """
SELECT event_id AS ingest_ord, CAST(user_id AS VARCHAR(64)) AS coin_id,
  CASE WHEN event_id % 41 = 0 THEN 'none' WHEN event_id % 43 = 0 THEN CAST(NULL AS VARCHAR(64))
       ELSE concat(' u', CAST(user_id AS VARCHAR(64)), ' ') END AS symbol,
  concat(event_type, '  ') AS name,
  CASE WHEN event_id % 17 = 0 THEN CAST(NULL AS VARCHAR(64)) WHEN event_id % 19 = 0 THEN 'n/a'
       WHEN event_id % 23 = 0 THEN '-1.5' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR(64)) END AS price,
  CASE WHEN event_id % 29 = 0 THEN -1.0E0 WHEN event_id % 31 = 0 THEN CAST(NULL AS DOUBLE) ELSE value * 100 END AS market_cap,
  CASE WHEN event_id % 37 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END AS volume_24h,
  CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE value - 50 END AS percent_change_24h,
  CASE WHEN event_id % 47 = 0 THEN 0 ELSE CAST(event_id % 100 + 1 AS INT) END AS cmc_rank,
  CASE WHEN event_id % 53 = 0 THEN TIMESTAMP '2200-01-01 00:00:00' ELSE CAST(ts AS TIMESTAMP) END AS snapshot_time
FROM {events}
UNION ALL
SELECT event_id + 10000000, CAST(user_id AS VARCHAR(64)), concat('U', CAST(user_id AS VARCHAR(64))), event_type,
  CAST(CAST(value AS DECIMAL(12,2)) + 1 AS VARCHAR(64)), value * 100, value, value - 50,
  CAST(event_id % 100 + 1 AS INT), CAST(ts AS TIMESTAMP)
FROM {events} WHERE event_id % 59 = 0
"""

FIXTURE_SQL = {"panel": PANEL_SQL, "wide_panel": WIDE_PANEL_SQL, "bars": BARS_SQL, "tape": TAPE_SQL, "dirty_tape": DIRTY_TAPE_SQL}
_NEEDS = {"panel": ("orders", "customer", "nation"), "wide_panel": ("lineitem",), "bars": ("events",),
          "tape": ("events",), "dirty_tape": ("events",)}


_stands_for: dict[str, str] = {}


@contextmanager
def standing_for(name: str, other: str):
    """Inside the block the adapter ``name`` reads ``other``."""
    _stands_for[name] = other
    try:
        yield
    finally:
        del _stands_for[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named adapter as a Spark DataFrame over the parquet tables in ``sf_dir``."""
    name = _stands_for.get(name, name)
    dfs = {t: table(spark, sf_dir, t) for t in _NEEDS[name]}
    return spark.sql(FIXTURE_SQL[name].format(json_get="get_json_object", **{t: "{" + t + "}" for t in dfs}), **dfs)


def panel(spark, sf_dir):
    return fixture(spark, sf_dir, "panel")


def bars(spark, sf_dir):
    return fixture(spark, sf_dir, "bars")


def tape(spark, sf_dir):
    return fixture(spark, sf_dir, "tape")


def dirty_tape(spark, sf_dir):
    return fixture(spark, sf_dir, "dirty_tape")


def oracle_text(name: str) -> str:
    return FIXTURE_SQL[name].format(json_get="json_extract_string", **{t: t for t in _NEEDS[name]}).strip()


def oracle_cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` over DuckDB's registered views."""
    parts = [f"{n} AS ({oracle_text(n)})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
