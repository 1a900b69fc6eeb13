"""Report tables: KPIs, narrative insights, top-n lists, run summary, the
report bundle (D7, D8, D20, H2-H4, H6, H7, I8, M5), as DataFrames.

Each KPI/insight is one aggregate over the latest snapshot (one pass, partial
aggregation), laid out as ``(ord, label, value)`` rows; conditional rows are
filtered out exactly where the reference leaves them out. Numbers are
formatted with ``format_number`` (round-half-even on the binary value, as
Python's ``format``); ``format_string`` rounds half-up on decimal text and
would differ on values such as 2.675.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.snapshots import latest_snapshot, top_movers

# KPI labels and insight sentence templates.
KPI_LABELS = ["BTC Price", "Total Market Cap", "24H Volume", "Number of Coins", "Top Gainer",
              "Top Loser", "Largest Market Cap", "Most Volatile"]
REPORT_COLUMNS = ["symbol", "name", "price", "percent_change_24h"]


def fmt_grouped(x, decimals: int) -> Column:
    """Python ``f'{x:,.{d}f}'``."""
    return F.format_number(x, decimals)


def fmt_fixed(x, decimals: int) -> Column:
    """Python ``f'{x:.{d}f}'``."""
    return F.regexp_replace(F.format_number(x, decimals), ",", "")


def arg_max(value: str, metric: str, tie: str = "symbol") -> Column:
    """``value`` at the row with the largest ``metric``, ties to the smallest
    ``tie`` (H7). NULL metrics never win."""
    return F.min_by(F.col(value), F.struct(F.col(metric).isNull(), -F.col(metric), F.col(tie)))


def arg_min(value: str, metric: str, tie: str = "symbol") -> Column:
    return F.min_by(F.col(value), F.struct(F.col(metric).isNull(), F.col(metric), F.col(tie)))


def arg_max_row(metric: str, cols: Sequence[str], tie: str = "symbol") -> Column:
    return F.min_by(F.struct(*cols), F.struct(F.col(metric).isNull(), -F.col(metric), F.col(tie)))


def arg_min_row(metric: str, cols: Sequence[str], tie: str = "symbol") -> Column:
    return F.min_by(F.struct(*cols), F.struct(F.col(metric).isNull(), F.col(metric), F.col(tie)))


def _rows(df: DataFrame, rows: list[tuple[str, Column, Column | None]]) -> DataFrame:
    """One aggregate row → ``(ord, label, value)`` rows, keeping those whose
    condition holds."""
    structs = [F.struct(F.lit(i).alias("ord"), F.lit(lbl).alias("label"), val.alias("value"),
                        (cond if cond is not None else F.lit(True)).alias("_keep"))
               for i, (lbl, val, cond) in enumerate(rows)]
    return df.agg(F.array(*structs).alias("_r")).select(F.inline("_r")).filter("_keep").drop("_keep")


def compute_kpis(latest: DataFrame, benchmark: str = "BTC") -> DataFrame:
    """KPI cards (D7): benchmark price, total cap, total volume, coin count,
    top gainer/loser with their change, largest cap, most volatile (only when
    a volatility column with data exists)."""
    pct = "percent_change_24h"
    has_bench = F.max(F.col("symbol") == benchmark)
    bench_price = F.max(F.when(F.col("symbol") == benchmark, F.col("price")))
    price, cap, volume, coins, gainer, loser, largest, volatile = KPI_LABELS
    rows = [
        (price, F.when(has_bench, F.concat(F.lit("$"), fmt_grouped(bench_price, 2))).otherwise("N/A"), None),
        (cap, F.concat(F.lit("$"), fmt_grouped(F.sum("market_cap"), 0)), None),
        (volume, F.concat(F.lit("$"), fmt_grouped(F.sum("volume_24h"), 0)), None),
        (coins, F.count(F.lit(1)).cast("string"), None),
        (gainer, F.concat(arg_max("symbol", pct), F.lit(" ("), fmt_fixed(arg_max(pct, pct), 2), F.lit("%)")), None),
        (loser, F.concat(arg_min("symbol", pct), F.lit(" ("), fmt_fixed(arg_min(pct, pct), 2), F.lit("%)")), None),
        (largest, arg_max("symbol", "market_cap"), None),
    ]
    if "volatility" in latest.columns:
        rows.append((volatile, arg_max("symbol", "volatility"), F.count("volatility") > 0))
    return _rows(latest, rows)


def generate_insights(latest: DataFrame) -> DataFrame:
    """Narrative lines (D8) as ``(ord, label, value)`` with the sentence in ``value``."""
    pct = F.avg("percent_change_24h")
    rows = [("market_direction",
             F.format_string("The market is broadly %s on average (%s%% over 24h across tracked coins).",
                             F.when(pct > 0, "up").otherwise("down"), fmt_fixed(pct, 2)), None)]
    cols = latest.columns
    rank_col = "market_dominance" if "market_dominance" in cols else "market_cap"
    ranked = latest.select(F.struct(
        F.col(rank_col).isNull().alias("n"), (-F.col(rank_col)).alias("k"), F.col("symbol").alias("s"),
        (F.col("market_dominance") if "market_dominance" in cols else F.lit(None).cast("double")).alias("d")).alias("t"))
    # three rows by a distributed top-k, not an array of the whole snapshot
    top3 = ranked.orderBy("t").limit(3).agg(F.array_sort(F.collect_list("t")).alias("a"))
    if "market_dominance" in cols:
        combined = top3.select(F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x["d"]) * 100.0).scalar()
        names = top3.select(F.array_join(F.transform("a", lambda x: x["s"]), ", ")).scalar()
        rows.append(("top3_dominance",
                     F.format_string("The top 3 coins by market cap (%s) control %s%% of total tracked market cap.",
                                     names, fmt_fixed(combined, 1)),
                     combined.isNotNull() & (combined != 0)))
    if "is_any_anomaly" in cols:
        n = F.sum(F.col("is_any_anomaly").cast("int"))
        rows.append(("anomalies",
                     F.format_string("%d coin(s) triggered anomaly flags in the latest snapshot "
                                     "(flash crash, spike, or statistical outlier).", n),
                     F.coalesce(n, F.lit(0)) != 0))
    if "volume_to_marketcap_ratio" in cols:
        r = F.avg("volume_to_marketcap_ratio")
        rows.append(("liquidity",
                     F.format_string("Average volume/market-cap ratio is %s, indicating overall market liquidity.",
                                     fmt_fixed(r, 2)),
                     r.isNotNull() & (r != 0)))
    return _rows(latest, rows)


def top_n_tables(latest: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """The workbook's sheets as DataFrames."""
    return {"latest_snapshot": latest,
            "top_gainers": top_movers(latest, "percent_change_24h", n, False),
            "top_losers": top_movers(latest, "percent_change_24h", n, True),
            "top_market_cap": top_movers(latest, "market_cap", n, False)}


def tail_n(df: DataFrame, n: int = 50, entity: str = "symbol", time: str = "snapshot_time",
           value: str = "price") -> DataFrame:
    """Last ``n`` non-null values per entity, renumbered from 0 (H6)."""
    from tidemark.operators.series import ordinal, with_entity_windows
    src = df.filter(F.col(value).isNotNull()).select(entity, time, value)

    def build(fr, w):
        return fr.withColumn("_rd", F.col("_total") - ordinal(entity, time)).withColumn(
            "pos", F.least(F.lit(n), F.col("_total")) - F.col("_rd"))
    out = with_entity_windows(src, build, entity, time, lookback=0)
    return out.filter(F.col("_rd") <= n).drop("_rd")


def min_history_gate(df: DataFrame, min_rows: int = 20, entity: str = "symbol",
                     value: str = "price") -> DataFrame:
    """Rows of entities with at least ``min_rows`` non-null values."""
    ok = df.groupBy(entity).agg(F.count(value).alias("_c")).filter(F.col("_c") >= min_rows).select(entity)
    return df.join(ok, entity, "left_semi")


def run_summary(history: DataFrame, final: DataFrame, inserted, time: str = "snapshot_time") -> DataFrame:
    """One row (D20): rows inserted, rows in the store, rows in the latest
    snapshot, anomalies flagged in it."""
    latest = latest_snapshot(final, time)
    ins = inserted if isinstance(inserted, Column) else F.lit(int(inserted))
    anomalies = (F.coalesce(F.sum(F.col("is_any_anomaly").cast("int")), F.lit(0))
                 if "is_any_anomaly" in final.columns else F.lit(0))
    summary = latest.agg(F.count(F.lit(1)).alias("coins_in_latest_snapshot"),
                         anomalies.cast("bigint").alias("anomalies_flagged"))
    total = history.select(F.count(F.lit(1))).scalar()
    return summary.select(F.lit("success").alias("status"), ins.cast("bigint").alias("rows_inserted"),
                          total.alias("total_rows_in_db"), "coins_in_latest_snapshot", "anomalies_flagged")


def report_bundle(latest: DataFrame, period: str = "Daily", n: int = 10) -> DataFrame:
    """M5: the report's content as one long table ``(section, ord, label, value)``:
    period, KPIs, insights, 10 gainers and 10 losers. The generation time is a
    rendering detail left to the caller."""
    kp = compute_kpis(latest).select(F.lit("kpi").alias("section"), "ord", "label", "value")
    ins = generate_insights(latest).select(F.lit("insight").alias("section"), "ord", "label", "value")

    def movers(asc: bool, section: str) -> DataFrame:
        t = top_movers(latest, "percent_change_24h", n, asc)
        order = F.asc_nulls_last("percent_change_24h") if asc else F.desc_nulls_last("percent_change_24h")
        from pyspark.sql import Window
        return t.select(F.lit(section).alias("section"),
                        (F.row_number().over(Window.orderBy(order, "symbol")) - 1).alias("ord"),
                        F.col("symbol").alias("label"),
                        F.concat_ws(" | ", "name", fmt_grouped("price", 2), fmt_grouped("percent_change_24h", 2))
                        .alias("value"))
    head = latest.sparkSession.range(1).select(F.lit("period").alias("section"), F.lit(0).alias("ord"),
                                               F.lit("Period").alias("label"), F.lit(period).alias("value"))
    return head.unionByName(kp).unionByName(ins).unionByName(movers(False, "gainers")).unionByName(
        movers(True, "losers"))
