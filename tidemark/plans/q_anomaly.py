"""Tier 4: anomaly flags, z-scores, LOF, the anomaly pipeline."""

from __future__ import annotations

from tidemark.fixtures import oracle_cte, panel, tape
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.operators import anomaly as A
from tidemark.operators.lof import lof_flags
from tidemark.plans.forest_sql import forest_sql
from tidemark.plans.registry import query

T = oracle_cte("tape")
P = oracle_cte("panel")
W = "(PARTITION BY symbol ORDER BY snapshot_time)"


PREV = f"LAG(price, 1) OVER {W}"
CRASH_SQL = f"coalesce(price / nullif({PREV}, 0) - 1 < -0.08 OR ({PREV} = 0 AND price < 0), false) AS is_flash_crash"
SPIKE_SQL = f"coalesce(price / nullif({PREV}, 0) - 1 > 0.1 OR ({PREV} = 0 AND price > 0), false) AS is_price_spike"


def _step_sql(src: str) -> str:
    return f"{CRASH_SQL}, {SPIKE_SQL}"


@query("flash_crash", T + f"SELECT symbol, snapshot_time, {CRASH_SQL} FROM tape")
def q_flash_crash(spark, sf):
    """One-step return below -8 % per user on the raw tape."""
    return A.flash_crash(tape(spark, sf)).select("symbol", "snapshot_time", "is_flash_crash")


@query("price_spike", T + f"SELECT symbol, snapshot_time, {SPIKE_SQL} FROM tape")
def q_price_spike(spark, sf):
    """One-step return above +10 % per user."""
    return A.price_spike(tape(spark, sf)).select("symbol", "snapshot_time", "is_price_spike")


def _z_sql(src: str, c: str, name: str) -> str:
    return (f", st AS (SELECT symbol, avg({c}) AS mu, stddev_samp({c}) AS sd FROM {src} GROUP BY symbol)\n"
            f"SELECT s.symbol, s.snapshot_time, "
            f"{fix6_sql(f'CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE ({c} - mu) / sd END')} AS {name}, "
            f"coalesce(abs(CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE ({c} - mu) / sd END) > 3.0, false) AS flag "
            f"FROM {src} s JOIN st USING (symbol)")


@query("volume_spike", T + _z_sql("tape", "volume_24h", "volume_zscore").replace("AS flag", "AS is_volume_spike"))
def q_volume_spike(spark, sf):
    """Per-user volume z-score (sample std) and |z| > 3."""
    out = A.volume_spike(tape(spark, sf))
    return out.select("symbol", "snapshot_time", fix6("volume_zscore").alias("volume_zscore"), "is_volume_spike")


@query("market_cap_anomaly", P + _z_sql("panel", "market_cap", "market_cap_zscore")
       .replace("AS flag", "AS is_market_cap_anomaly"))
def q_cap_anomaly(spark, sf):
    """Per-symbol market-cap z-score and |z| > 3."""
    out = A.market_cap_anomaly(panel(spark, sf))
    return out.select("symbol", "snapshot_time", fix6("market_cap_zscore").alias("market_cap_zscore"),
                      "is_market_cap_anomaly")


LOF_COLS = A.ML_COLUMNS


def lof_sql(src: str) -> str:
    """Brute-force LOF (all pairs within a snapshot) — the oracle only."""
    fill = ", ".join(f"coalesce({c}, quantile_cont({c}, 0.5) OVER (PARTITION BY snapshot_time)) AS x{i}"
                     for i, c in enumerate(LOF_COLS))
    dist = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(len(LOF_COLS)))
    return f"""
, lb0 AS (SELECT symbol, snapshot_time, {fill} FROM {src}),
lb AS (SELECT *, count(*) OVER (PARTITION BY snapshot_time) AS n FROM lb0
       WHERE {" AND ".join(f"x{i} IS NOT NULL" for i in range(len(LOF_COLS)))}),
pairs AS (SELECT a.snapshot_time, a.symbol AS q, b.symbol AS o, sqrt({dist}) AS d, a.n
          FROM lb a JOIN lb b ON a.snapshot_time = b.snapshot_time AND a.symbol <> b.symbol WHERE a.n >= 10),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_time, q ORDER BY d, o) AS r FROM pairs)
       WHERE r <= least(20, n - 1)),
kd AS (SELECT snapshot_time, q, max(d) AS kdist FROM nb GROUP BY 1, 2),
lrd AS (SELECT nb.snapshot_time, nb.q, 1.0 / (avg(greatest(nb.d, kd.kdist)) + 1e-10) AS lrd
        FROM nb JOIN kd ON nb.snapshot_time = kd.snapshot_time AND nb.o = kd.q GROUP BY 1, 2),
lof AS (SELECT nb.snapshot_time, nb.q AS symbol, avg(l2.lrd / l1.lrd) AS lof_score FROM nb
        JOIN lrd l1 ON nb.snapshot_time = l1.snapshot_time AND nb.q = l1.q
        JOIN lrd l2 ON nb.snapshot_time = l2.snapshot_time AND nb.o = l2.q GROUP BY 1, 2),
thr AS (SELECT snapshot_time, quantile_cont(lof_score, 0.97) AS t FROM lof GROUP BY 1),
lofs AS (SELECT s.symbol, s.snapshot_time, lof.lof_score, coalesce(lof.lof_score > thr.t, false) AS is_lof_anomaly
         FROM {src} s LEFT JOIN lof USING (snapshot_time, symbol) LEFT JOIN thr USING (snapshot_time))
"""


@query("lof_anomaly", P + lof_sql("panel") +
       f"SELECT symbol, snapshot_time, {fix6_sql('lof_score')} AS lof_score, is_lof_anomaly FROM lofs")
def q_lof(spark, sf):
    """Exact LOF per snapshot (k = min(20, n-1), 3 % contamination, >= 10 rows)."""
    out = lof_flags(panel(spark, sf), LOF_COLS, keep_score=True)
    return out.select("symbol", "snapshot_time", fix6("lof_score").alias("lof_score"), "is_lof_anomaly")


def _pipeline_sql(src: str) -> str:
    return forest_sql(src, A.ML_COLUMNS, "symbol", "snapshot_time", A.ML_MIN_ROWS, A.CONTAMINATION, p="fs") + f"""
, st AS (SELECT symbol, avg(volume_24h) AS mv, stddev_samp(volume_24h) AS sv,
                avg(market_cap) AS mc, stddev_samp(market_cap) AS sc FROM {src} GROUP BY symbol),
ap AS (SELECT s.symbol, s.snapshot_time, s.price, s.percent_change_24h, {_step_sql(src)},
         CASE WHEN sv IS NULL OR sv = 0 THEN 0.0 ELSE (volume_24h - mv) / sv END AS volume_zscore,
         CASE WHEN sc IS NULL OR sc = 0 THEN 0.0 ELSE (market_cap - mc) / sc END AS market_cap_zscore
       FROM {src} s JOIN st USING (symbol)),
ap2 AS (SELECT ap.*, coalesce(abs(volume_zscore) > 3.0, false) AS is_volume_spike,
          coalesce(abs(market_cap_zscore) > 3.0, false) AS is_market_cap_anomaly, coalesce(fs.flagged, false) AS is_isolation_forest_anomaly,
          lofs.is_lof_anomaly FROM ap JOIN lofs USING (symbol, snapshot_time)
          LEFT JOIN fs ON fs.k = ap.symbol AND fs.g = ap.snapshot_time),
ap3 AS (SELECT *, CAST(CAST(is_flash_crash AS INTEGER) + CAST(is_price_spike AS INTEGER) + CAST(is_volume_spike AS INTEGER)
          + CAST(is_market_cap_anomaly AS INTEGER) + CAST(is_isolation_forest_anomaly AS INTEGER)
          + CAST(is_lof_anomaly AS INTEGER) AS BIGINT) AS anomaly_score FROM ap2),
ap4 AS (SELECT *, anomaly_score > 0 AS is_any_anomaly FROM ap3)
"""


PIPE_COLS = ["is_flash_crash", "is_price_spike", "is_volume_spike", "is_market_cap_anomaly",
             "is_isolation_forest_anomaly", "is_lof_anomaly", "anomaly_score", "is_any_anomaly"]


def _pipeline(spark, sf):
    return A.run_anomaly_pipeline(panel(spark, sf))


@query("run_anomaly_pipeline", P + lof_sql("panel") + _pipeline_sql("panel") +
       f"SELECT symbol, snapshot_time, {fix6_sql('volume_zscore')} AS volume_zscore, "
       f"{fix6_sql('market_cap_zscore')} AS market_cap_zscore, {', '.join(PIPE_COLS)} FROM ap4")
def q_pipeline(spark, sf):
    """Six flags and the score."""
    out = _pipeline(spark, sf)
    return out.select("symbol", "snapshot_time", fix6("volume_zscore").alias("volume_zscore"),
                      fix6("market_cap_zscore").alias("market_cap_zscore"), *PIPE_COLS)


@query("anomaly_score", P + lof_sql("panel") + _pipeline_sql("panel") +
       "SELECT symbol, snapshot_time, anomaly_score, is_any_anomaly FROM ap4")
def q_score(spark, sf):
    """Number of raised flags and the any-flag."""
    return _pipeline(spark, sf).select("symbol", "snapshot_time", "anomaly_score", "is_any_anomaly")


@query("filter_flagged", P + lof_sql("panel") + _pipeline_sql("panel") +
       "SELECT snapshot_time, symbol, price, percent_change_24h, anomaly_score FROM ap4 WHERE is_any_anomaly "
       "ORDER BY snapshot_time DESC, symbol")
def q_flagged(spark, sf):
    """Flagged rows, newest first, five columns."""
    return A.filter_flagged(_pipeline(spark, sf))


@query("iforest_anomaly_by_snapshot", P + forest_sql("panel", A.ML_COLUMNS, "symbol", "snapshot_time", A.ML_MIN_ROWS, A.CONTAMINATION, p="fs")
       + "SELECT symbol, snapshot_time, coalesce(flagged, false) AS is_isolation_forest_anomaly FROM panel "
         "LEFT JOIN fs ON fs.k = symbol AND fs.g = snapshot_time")
def q_iforest_snapshot(spark, sf):
    """Isolation forest per snapshot with >= 10 rows."""
    from tidemark.operators.forest import isolation_forest_flags
    out = isolation_forest_flags(panel(spark, sf), A.ML_COLUMNS, group="snapshot_time", key=["symbol"],
                                 contamination=A.CONTAMINATION, min_rows=A.ML_MIN_ROWS)
    return out.select("symbol", "snapshot_time", "is_isolation_forest_anomaly")
