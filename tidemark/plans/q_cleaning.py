"""Tier 2: typing, missing values, duplicates, business rules, outliers, audit
(on ``dirty_tape``, whose defects are planted so every rule fires)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.fixtures import dirty_tape, oracle_cte, panel
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.operators import cleaning as C
from tidemark.operators import stats as ST
from tidemark.plans.forest_sql import forest_sql
from tidemark.plans.registry import query

NOW = "2030-01-01 00:00:00"
COLS = ["price", "market_cap", "volume_24h", "percent_change_24h"]

STAGES = oracle_cte("dirty_tape") + f"""
, typed AS (
  SELECT ingest_ord, coin_id, trim(upper(coalesce(symbol, 'None'))) AS symbol,
         trim(coalesce(name, 'None')) AS name, TRY_CAST(price AS DOUBLE) AS price,
         market_cap, volume_24h, percent_change_24h, cmc_rank, snapshot_time FROM dirty_tape),
nn AS (SELECT * FROM typed WHERE price IS NOT NULL AND coin_id IS NOT NULL),
missing AS (
  SELECT * REPLACE (coalesce(percent_change_24h, 0.0) AS percent_change_24h,
    coalesce(market_cap, (SELECT quantile_cont(market_cap, 0.5) FROM nn)) AS market_cap,
    coalesce(volume_24h, (SELECT quantile_cont(volume_24h, 0.5) FROM nn)) AS volume_24h) FROM nn),
dedup1 AS (SELECT * FROM missing
  QUALIFY row_number() OVER (PARTITION BY coin_id, snapshot_time ORDER BY ingest_ord DESC) = 1),
dedup2 AS (SELECT * FROM dedup1
  QUALIFY row_number() OVER (PARTITION BY symbol, snapshot_time ORDER BY ingest_ord DESC) = 1),
dedup3 AS (SELECT DISTINCT * FROM dedup2),
c1 AS (SELECT * FROM dedup3 WHERE price >= 0),
c2 AS (SELECT * REPLACE (CASE WHEN market_cap < 0 THEN NULL ELSE market_cap END AS market_cap) FROM c1),
c3 AS (SELECT * FROM c2 WHERE symbol IS NOT NULL AND symbol NOT IN ('', 'NAN', 'NONE')),
c4 AS (SELECT * REPLACE (CASE WHEN cmc_rank <= 0 THEN NULL ELSE cmc_rank END AS cmc_rank) FROM c3),
checked AS (SELECT * FROM c4 WHERE snapshot_time <= TIMESTAMP '{NOW}'),
zs AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in COLS)},
              {", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in COLS)}
       FROM checked),
filled AS (SELECT checked.*, {", ".join(f"coalesce({c}, m_{c}) AS f_{c}" for c in COLS)} FROM checked, zs),
mom AS (SELECT {", ".join(f"avg(f_{c}) AS mu_{c}, stddev_pop(f_{c}) AS sd_{c}" for c in COLS)} FROM filled),
flags AS (
  SELECT filled.* EXCLUDE ({", ".join(f"f_{c}" for c in COLS)}),
  {", ".join(f"coalesce(abs((f_{c} - mu_{c}) / sd_{c}) > 3.0, false) AS {c}_zscore_outlier" for c in COLS)},
  {", ".join(f"coalesce({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}), false) AS {c}_iqr_outlier" for c in COLS)}
  FROM filled, mom, zs),
report_stats AS (SELECT *, ({" OR ".join(f"{c}_zscore_outlier OR {c}_iqr_outlier" for c in COLS)}) AS any_stat FROM flags)
""" + forest_sql("checked", COLS, "CAST(ingest_ord AS VARCHAR)") + """,
report AS (SELECT r.* EXCLUDE (any_stat), fo.flagged AS isolation_forest_outlier, any_stat OR fo.flagged AS any_outlier_flag
           FROM report_stats r JOIN fo ON fo.k = CAST(r.ingest_ord AS VARCHAR))
"""


def _stages(spark, sf):
    """Up to the rules; the outlier flags are not asked for."""
    return C.clean_stages(dirty_tape(spark, sf), now=NOW, isolation_forest=False)


def _flagged(spark, sf):
    return C.clean_stages(dirty_tape(spark, sf), now=NOW)


@query("coerce_numeric", oracle_cte("dirty_tape") + """
SELECT ingest_ord, TRY_CAST(price AS DOUBLE) AS price FROM dirty_tape""")
def q_coerce_numeric(spark, sf):
    """Price text → double, unparseable → NULL."""
    return C.coerce_numeric(dirty_tape(spark, sf), ["price"]).select("ingest_ord", "price")


@query("coerce_timestamp", oracle_cte("dirty_tape") + """
SELECT ingest_ord, TRY_CAST(CASE WHEN ingest_ord % 7 = 0 THEN 'not a time'
       ELSE CAST(snapshot_time AS VARCHAR) END AS TIMESTAMP) AS snapshot_time FROM dirty_tape""")
def q_coerce_timestamp(spark, sf):
    """Time text → timestamp, unparseable → NULL (a bad text planted on every 7th row)."""
    d = dirty_tape(spark, sf)
    d = d.select("ingest_ord", F.when(F.col("ingest_ord") % 7 == 0, F.lit("not a time"))
                 .otherwise(F.col("snapshot_time").cast("string")).alias("snapshot_time"))
    return C.coerce_timestamp(d, ["snapshot_time"])


@query("normalize_strings", oracle_cte("dirty_tape") + """
SELECT ingest_ord, trim(upper(coalesce(symbol, 'None'))) AS symbol, trim(coalesce(name, 'None')) AS name
FROM dirty_tape""")
def q_normalize_strings(spark, sf):
    """Symbol upper + strip, name strip, missing → 'None' text."""
    return C.normalize_strings(dirty_tape(spark, sf)).select("ingest_ord", "symbol", "name")


@query("drop_null_keys", STAGES + "SELECT ingest_ord, price FROM nn")
def q_drop_null_keys(spark, sf):
    """Rows with a price and an id."""
    return C.drop_null_keys(_stages(spark, sf).typed).select("ingest_ord", "price")


@query("impute_zero", STAGES + """
SELECT ingest_ord, coalesce(percent_change_24h, 0.0) AS percent_change_24h FROM nn""")
def q_impute_zero(spark, sf):
    """Percent changes → 0 when missing."""
    return C.impute_zero(C.drop_null_keys(_stages(spark, sf).typed)).select("ingest_ord", "percent_change_24h")


@query("impute_median", STAGES + "SELECT ingest_ord, market_cap, volume_24h FROM missing")
def q_impute_median(spark, sf):
    """Cap and volume → global median when missing."""
    return _stages(spark, sf).missing.select("ingest_ord", "market_cap", "volume_24h")


@query("dedup_keep_last_id", STAGES + "SELECT * FROM dedup1")
def q_dedup_id(spark, sf):
    """G1: last row per (coin_id, snapshot_time)."""
    return _stages(spark, sf).dedup_id


@query("dedup_keep_last_symbol", STAGES + "SELECT * FROM dedup2")
def q_dedup_symbol(spark, sf):
    """Last row per (symbol, snapshot_time), on the G1 survivors."""
    return _stages(spark, sf).dedup_symbol


@query("dedup_exact", STAGES + "SELECT * FROM dedup3")
def q_dedup_exact(spark, sf):
    """Whole-row duplicates removed."""
    return _stages(spark, sf).dedup_exact


@query("drop_negative_price", STAGES + "SELECT ingest_ord, price FROM c1")
def q_neg_price(spark, sf):
    """Keep price >= 0."""
    return C.drop_negative_price(_stages(spark, sf).dedup_exact).select("ingest_ord", "price")


@query("null_negative_cap", STAGES + "SELECT ingest_ord, market_cap FROM c2")
def q_neg_cap(spark, sf):
    """Negative market cap → NULL."""
    s = _stages(spark, sf)
    return C.null_negative_cap(C.drop_negative_price(s.dedup_exact)).select("ingest_ord", "market_cap")


@query("drop_null_symbol", STAGES + "SELECT ingest_ord, symbol FROM c3")
def q_null_symbol(spark, sf):
    """Drop '', 'NAN', 'NONE' symbols."""
    s = _stages(spark, sf)
    return C.drop_null_symbol(C.null_negative_cap(C.drop_negative_price(s.dedup_exact))).select("ingest_ord", "symbol")


@query("null_invalid_rank", STAGES + "SELECT ingest_ord, cmc_rank FROM c4")
def q_invalid_rank(spark, sf):
    """Rank <= 0 → NULL."""
    s = _stages(spark, sf)
    c3 = C.drop_null_symbol(C.null_negative_cap(C.drop_negative_price(s.dedup_exact)))
    return C.null_invalid_rank(c3).select("ingest_ord", "cmc_rank")


@query("drop_future_rows", STAGES + "SELECT * FROM checked")
def q_future(spark, sf):
    """Keep rows at or before 'now' (a fixed parameter)."""
    return _stages(spark, sf).checked


@query("outlier_zscore", STAGES + "SELECT ingest_ord, " + ", ".join(f"{c}_zscore_outlier" for c in COLS) + " FROM report")
def q_zscore(spark, sf):
    """|z| > 3 with population std after median fill, four columns."""
    chk = _stages(spark, sf).checked
    return chk.select("ingest_ord", *[C.zscore_flag(chk, c).alias(f"{c}_zscore_outlier") for c in COLS])


@query("outlier_iqr", STAGES + "SELECT ingest_ord, " + ", ".join(f"{c}_iqr_outlier" for c in COLS) + " FROM report")
def q_iqr(spark, sf):
    """Outside the 1.5 IQR fences, four columns."""
    chk = _stages(spark, sf).checked
    return chk.select("ingest_ord", *[C.iqr_flag(chk, c).alias(f"{c}_iqr_outlier") for c in COLS])


@query("outlier_report", STAGES + "SELECT * FROM report")
def q_outlier_report(spark, sf):
    """All flags and their OR."""
    return _flagged(spark, sf).flagged


@query("clean_pipeline", STAGES + "SELECT checked.*, any_outlier_flag AS is_outlier FROM checked JOIN report USING (ingest_ord)")
def q_clean_pipeline(spark, sf):
    """G9 + C7: the whole cleaning sequence, the flag attached as is_outlier."""
    return _flagged(spark, sf).clean


@query("attach_flags", STAGES + "SELECT ingest_ord, any_outlier_flag AS is_outlier FROM report")
def q_attach_flags(spark, sf):
    """The outlier flag as a column on its own row (no join)."""
    return _flagged(spark, sf).clean.select("ingest_ord", "is_outlier")


_AUDIT = [
    ("rows_dropped_no_price", "(SELECT count(*) FROM typed) - (SELECT count(*) FROM nn)"),
    ("percent_change_24h_imputed_with_zero", "(SELECT count(*) FROM nn WHERE percent_change_24h IS NULL)"),
    ("market_cap_imputed_with_median", "(SELECT count(*) FROM nn WHERE market_cap IS NULL)"),
    ("volume_24h_imputed_with_median", "(SELECT count(*) FROM nn WHERE volume_24h IS NULL)"),
    ("duplicate_coin_snapshot_rows_removed", "(SELECT count(*) FROM missing) - (SELECT count(*) FROM dedup1)"),
    ("duplicate_symbol_timestamp_rows_removed", "(SELECT count(*) FROM dedup1) - (SELECT count(*) FROM dedup2)"),
    ("exact_duplicate_rows_removed", "(SELECT count(*) FROM dedup2) - (SELECT count(*) FROM dedup3)"),
    ("negative_price_rows_removed", "(SELECT count(*) FROM dedup3 WHERE price < 0)"),
    ("negative_market_cap_flagged", "(SELECT count(*) FROM c1 WHERE market_cap < 0)"),
    ("null_symbol_rows_removed", "(SELECT count(*) FROM c2 WHERE symbol IN ('', 'NAN', 'NONE'))"),
    ("invalid_rank_flagged", "(SELECT count(*) FROM c3 WHERE cmc_rank <= 0)"),
    ("future_timestamp_rows_removed", f"(SELECT count(*) FROM c4 WHERE snapshot_time > TIMESTAMP '{NOW}')"),
    ("outliers_detected", "(SELECT count(*) FROM report WHERE any_outlier_flag)"),
]


@query("cleaning_audit", STAGES + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS ord, '{n}' AS metric, CAST({e} AS BIGINT) AS value" for i, (n, e) in enumerate(_AUDIT))
    + ") WHERE NOT (metric LIKE '%_imputed_with_median' AND value = 0)")
def q_audit(spark, sf):
    """Every stage's counts in one table."""
    return C.cleaning_audit(dirty_tape(spark, sf), now=NOW)


@query("missing_report", oracle_cte("dirty_tape") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
    f"round_even((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct FROM dirty_tape"
    for c in ["ingest_ord", "coin_id", "symbol", "name", "price", "market_cap", "volume_24h",
              "percent_change_24h", "cmc_rank", "snapshot_time"]))
def q_missing_report(spark, sf):
    """Null count and percent per column of the raw table."""
    return ST.missing_report(dirty_tape(spark, sf))


@query("median_and_quantiles", oracle_cte("panel") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {fix6_sql(f'quantile_cont({c}, 0.25)')} AS q1, "
    f"{fix6_sql(f'quantile_cont({c}, 0.5)')} AS median, {fix6_sql(f'quantile_cont({c}, 0.75)')} AS q3 FROM panel"
    for c in ["price", "market_cap", "volume_24h"]))
def q_quantiles(spark, sf):
    """Column median and linear quartiles."""
    out = ST.median_and_quartiles(panel(spark, sf), ["price", "market_cap", "volume_24h"])
    return out.select("column_name", *[fix6(c).alias(c) for c in ("q1", "median", "q3")])


@query("isolation_forest_outliers", STAGES + "SELECT ingest_ord, symbol, isolation_forest_outlier FROM report")
def q_iforest(spark, sf):
    """Global isolation forest on the four outlier columns."""
    from tidemark.operators.forest import isolation_forest_flags
    chk = _stages(spark, sf).checked
    return isolation_forest_flags(chk, COLS, flag="isolation_forest_outlier").select(
        "ingest_ord", "symbol", "isolation_forest_outlier")
