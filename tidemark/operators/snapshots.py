"""Snapshot-table operators: the analytical SQL library and the history reads.

Global "latest" and "last two" selections are scalar subqueries or top-k
(TakeOrderedAndProject), never a window without a partition key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import materialize, ordinal, sized_join, with_entity_windows


# --------------------------------------------------------------------------- reads
def scan_history(df: DataFrame) -> DataFrame:
    """Whole history (A7): the table itself; column pruning is left to Catalyst."""
    return df


def latest_snapshot(df: DataFrame, time: str = "snapshot_time") -> DataFrame:
    """Rows at the newest time (A8/C5): ``time = (SELECT max(time))``."""
    newest = df.select(F.max(time)).scalar()
    return df.filter(F.col(time) == newest)


def coin_history(df: DataFrame, symbol: str, entity: str = "symbol",
                 time: str = "snapshot_time") -> DataFrame:
    """One entity's history, input upper-cased, ordered by time."""
    return df.filter(F.col(entity) == F.lit(symbol.upper())).orderBy(time)


def filter_symbols(df: DataFrame, symbols: str | Sequence[str], entity: str = "symbol") -> DataFrame:
    """Equality or IN-list filter on the entity."""
    if isinstance(symbols, str):
        return df.filter(F.col(entity) == symbols)
    return df.filter(F.col(entity).isin(list(symbols)))


def search_assets(df: DataFrame, term: str, cols: Sequence[str] = ("symbol", "name")) -> DataFrame:
    """Case-insensitive regex contains on any of ``cols``."""
    pattern = "(?i)" + term
    cond = None
    for c in cols:
        hit = F.coalesce(F.col(c).rlike(pattern), F.lit(False))
        cond = hit if cond is None else (cond | hit)
    return df.filter(cond)


def filter_date_range(df: DataFrame, start, end, time: str = "snapshot_time") -> DataFrame:
    """Inclusive date range on the time column (B12); prunes date partitions."""
    d = F.to_date(F.col(time))
    return df.filter((d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date")))


def distinct_symbols(df: DataFrame, entity: str = "symbol", exclude: str | None = None) -> DataFrame:
    """Sorted distinct entities, optionally all but one."""
    out = df.select(entity).distinct()
    if exclude is not None:
        out = out.filter(F.col(entity) != exclude)
    return out.orderBy(entity)


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fixed column list (B2); unknown names fail at plan time."""
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``id -> coin_id``, ``any_outlier_flag -> is_outlier`` (B1)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def guard_empty(df: DataFrame) -> bool:
    """True when there is nothing to process (B15); operators themselves
    return empty frames with the full schema, so callers only need this to
    stop a cycle early."""
    return df.isEmpty()


def distinct_times(df: DataFrame, time: str = "snapshot_time") -> DataFrame:
    """DISTINCT snapshot times."""
    return df.select(time).distinct()


# --------------------------------------------------------------------------- movers
def top_movers(df: DataFrame, metric: str = "percent_change_24h", n: int = 10,
               ascending: bool = False, cols: Sequence[str] | None = None,
               tie: Sequence[str] = ("symbol",)) -> DataFrame:
    """Top-n by ``metric`` (H1/H2/H3): a TakeOrderedAndProject, NULLs last,
    ties broken by ``tie`` so the result is deterministic."""
    order = [F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric)]
    order += [F.asc_nulls_last(c) for c in tie]
    out = df.orderBy(*order).limit(n)
    return out.select(*cols) if cols else out


def top_gainers(df: DataFrame, n: int = 10, time: str = "snapshot_time") -> DataFrame:
    return top_movers(latest_snapshot(df, time), "percent_change_24h", n, False,
                      ["symbol", "name", "price", "percent_change_24h"])


def top_losers(df: DataFrame, n: int = 10, time: str = "snapshot_time") -> DataFrame:
    return top_movers(latest_snapshot(df, time), "percent_change_24h", n, True,
                      ["symbol", "name", "price", "percent_change_24h"])


def rank_by_metric(latest: DataFrame, metric: str,
                   allowed: Sequence[str] = ("percent_change_24h", "volume_24h", "market_cap",
                                             "volatility", "volume_to_marketcap_ratio")) -> DataFrame:
    """Latest snapshot sorted by one validated metric, descending (H4)."""
    if metric not in allowed:
        raise ValueError(f"metric must be one of {list(allowed)}")
    return latest.select("symbol", "name", "price", metric).orderBy(F.desc_nulls_last(metric), "symbol")


# --------------------------------------------------------------------------- aggregates
def avg_volume_per_coin(df: DataFrame, n: int = 20) -> DataFrame:
    """AVG(volume_24h) by (symbol, name), top n."""
    agg = df.groupBy("symbol", "name").agg(F.avg("volume_24h").alias("avg_volume_24h"))
    return top_movers(agg, "avg_volume_24h", n, tie=("symbol", "name"))


def price_volatility_per_coin(df: DataFrame, n: int = 20, min_rows: int = 5) -> DataFrame:
    """Sample std of price per symbol with more than ``min_rows`` rows."""
    agg = (df.groupBy("symbol")
           .agg(F.stddev_samp("price").alias("price_volatility"), F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > min_rows).drop("_n"))
    return top_movers(agg, "price_volatility", n)


def price_volatility_join_back(df: DataFrame, n: int = 20, min_rows: int = 5) -> DataFrame:
    """The same statistic in the join-back form (C1): each row against its symbol's centre.
    Symbols with too few rows go before the join; both sides are keyed by symbol, so the
    join reuses the aggregate's partitioning."""
    centre = (df.groupBy("symbol").agg(F.avg("price").alias("_centre"), F.count(F.lit(1)).alias("_rows"))
              .filter(F.col("_rows") > min_rows))
    gap = F.col("price") - F.col("_centre")
    spread = df.join(centre, "symbol").groupBy("symbol").agg(
        F.sqrt(F.try_divide(F.sum(gap * gap), F.max("_rows") - 1)).alias("price_volatility"))
    return top_movers(spread, "price_volatility", n)


def avg_daily_return(df: DataFrame, n: int = 20) -> DataFrame:
    """AVG(percent_change_24h) by symbol, top n (D3)."""
    agg = df.groupBy("symbol").agg(F.avg("percent_change_24h").alias("avg_daily_return"))
    return top_movers(agg, "avg_daily_return", n)


def monthly_trend(df: DataFrame, time: str = "snapshot_time") -> DataFrame:
    """AVG price and cap by symbol x 'yyyy-MM' (D4)."""
    return (df.groupBy("symbol", F.date_format(time, "yyyy-MM").alias("year_month"))
            .agg(F.avg("price").alias("avg_price"), F.avg("market_cap").alias("avg_market_cap")))


def daily_summary(df: DataFrame, time: str = "snapshot_time") -> DataFrame:
    """The daily view (D5): low/high/avg price, avg volume and cap by symbol x date."""
    return (df.groupBy("symbol", F.to_date(time).alias("trade_date"))
            .agg(F.min("price").alias("low"), F.max("price").alias("high"),
                 F.avg("price").alias("avg_price"), F.avg("volume_24h").alias("avg_volume"),
                 F.avg("market_cap").alias("avg_market_cap")))


def lag_and_row_number(df: DataFrame, entity: str = "symbol", time: str = "snapshot_time",
                       **chunking) -> DataFrame:
    """LAG(price) ascending and ROW_NUMBER() descending per entity.

    The descending row number is ``total - position``, both taken from the
    chunked frame, so a huge entity never sorts in one task."""
    def build(frame, w):
        return frame.select(entity, time, "price",
                            F.lag("price", 1).over(w).alias("prev_price"),
                            (F.col("_total") - ordinal(entity, time)).alias("rn"),
                            "_home", "_chunk", "_bkt", "_before", "_total")
    return with_entity_windows(df, build, entity, time, lookback=1, **chunking)


def consistent_growers(df: DataFrame, last_n: int = 20, entity: str = "symbol",
                       time: str = "snapshot_time", **chunking) -> DataFrame:
    """Entities whose every one of the last ``last_n`` moves was up.

    As in the SQL it mirrors, the lag is taken over the full history before the
    cut, so ``last_n`` rows give ``last_n`` deltas."""
    ranked = lag_and_row_number(df, entity, time, **chunking)
    recent = ranked.filter((F.col("rn") <= last_n) & F.col("prev_price").isNotNull())
    return (recent.groupBy(entity)
            .agg(F.count(F.lit(1)).alias("snapshots_checked"),
                 F.sum(F.when(F.col("price") - F.col("prev_price") > 0, 1).otherwise(0)).cast("bigint")
                 .alias("positive_moves"))
            .filter(F.col("positive_moves") == F.col("snapshots_checked")))


def rolling_avg_market_cap(df: DataFrame, rows: int = 5, entity: str = "symbol",
                           time: str = "snapshot_time", **chunking) -> DataFrame:
    """AVG(market_cap) over the last ``rows`` rows per entity."""
    def build(frame, w):
        return frame.withColumn(f"rolling_avg_market_cap_{rows}",
                                F.avg("market_cap").over(w.rowsBetween(-(rows - 1), 0)))
    out = with_entity_windows(df.select(entity, time, "market_cap"), build, entity, time,
                              lookback=rows - 1, **chunking)
    return out


def last_two_times(df: DataFrame, time: str = "snapshot_time") -> DataFrame:
    """The two newest distinct times with their dense rank (C2/F6): a top-2
    over the distinct times, so at most two rows reach the join."""
    times = df.select(time).distinct().orderBy(F.desc(time)).limit(2)
    return times.withColumn("snap_rank", F.dense_rank().over(Window.orderBy(F.desc(time))))


def time_rank(df: DataFrame, time: str = "snapshot_time", descending: bool = True,
              name: str = "snap_rank") -> DataFrame:
    """Dense rank of the distinct times (1 = newest when ``descending``).

    The distinct times are numbered with the chunked ordinal machinery under
    one constant key, so even a very long list of snapshots is ranked in
    parallel chunks rather than by a window without a partition key."""
    times = df.select(time).distinct().withColumn("_one", F.lit(1))

    def build(fr, w):
        pos = ordinal("_one", time) + 1
        return fr.withColumn(name, ((F.col("_total") - pos + 1) if descending else pos).cast("int"))
    return with_entity_windows(times, build, "_one", time, lookback=0).drop("_one")


def snapshot_rank(df: DataFrame, time: str = "snapshot_time") -> DataFrame:
    """Dense rank of snapshots, newest first, for every row (F6): ranked over
    the distinct times, then joined back with a checked-size broadcast."""
    ranked = materialize(time_rank(df, time))
    return sized_join(df, ranked, time)


def rank_change(df: DataFrame, entity: str = "symbol", time: str = "snapshot_time") -> DataFrame:
    """cmc_rank in the previous vs the newest snapshot (C3), newest first by change.

    Built on the dense rank of the two newest times (the reference's RANK over
    all rows would make this empty, see the README)."""
    two = last_two_times(df, time)
    tagged = df.join(F.broadcast(two), time)  # at most two rows: size bound by construction
    curr = tagged.filter(F.col("snap_rank") == 1).select(entity, F.col("cmc_rank").alias("current_rank"))
    prev = tagged.filter(F.col("snap_rank") == 2).select(entity, F.col("cmc_rank").alias("previous_rank"))
    return (curr.join(prev, entity)
            .select(entity, "previous_rank", "current_rank",
                    (F.col("previous_rank") - F.col("current_rank")).alias("rank_change"))
            .orderBy(F.desc("rank_change"), entity))


def outperform_benchmark(df: DataFrame, benchmark: str = "BTC", n: int = 20,
                         entity: str = "symbol", time: str = "snapshot_time",
                         metric: str = "percent_change_24h") -> DataFrame:
    """Per entity: snapshots beating the benchmark and the mean excess over
    those snapshots only (C4). The benchmark has one row per snapshot; it is
    broadcast only when that count is checked."""
    bench = materialize(df.filter(F.col(entity) == benchmark)
                        .select(F.col(time).alias("_bt"), F.col(metric).alias("_bm")))
    others = df.filter(F.col(entity) != benchmark).select(entity, time, metric)
    joined = sized_join(others, bench, F.col(time) == F.col("_bt"))
    beat = joined.filter(F.col(metric) > F.col("_bm"))
    agg = beat.groupBy(entity).agg(F.count(F.lit(1)).alias("snapshots_outperformed"),
                                   F.avg(F.col(metric) - F.col("_bm")).alias("avg_outperformance"))
    return top_movers(agg, "avg_outperformance", n, tie=(entity,))
