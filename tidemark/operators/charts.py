"""The data behind each chart (D15-D19, M6): drawing is left to the caller.

All are aggregates or projections: bars and matrices are grouped aggregates
(partial, map-side), the gap-filled OHLC grid is generated per entity from its
first and last bucket, and the KDE is evaluated from a fine histogram (linear
in rows) rather than from every pair of (row, grid point).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.snapshots import filter_symbols, top_movers

# Weekday order of the calendar heatmap (Monday first).
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_hour_matrix(df: DataFrame, symbol: str | None = None, value: str = "percent_change_1h",
                        time: str = "snapshot_time", long: bool = False) -> DataFrame:
    """Mean ``value`` by weekday x hour (D15), weekdays Monday first; wide by
    default (one column per hour present), long with ``long=True``."""
    src = filter_symbols(df, symbol) if symbol else df
    g = (src.withColumn("weekday", F.date_format(time, "EEEE"))
         .withColumn("weekday_ord", F.weekday(time)).withColumn("hour", F.hour(time)))
    if long:
        return g.groupBy("weekday", "weekday_ord", "hour").agg(F.avg(value).alias("avg_value"))
    return (g.groupBy("weekday_ord", "weekday").pivot("hour", list(range(24))).agg(F.avg(value))
            .orderBy("weekday_ord"))


def ohlc_bars(df: DataFrame, rule: str = "1 hour", entity: str = "symbol", time: str = "snapshot_time",
              price: str = "price", fill_gaps: bool = True) -> DataFrame:
    """Open/high/low/close per entity and time bucket (D16), for all entities
    at once. With ``fill_gaps`` every bucket between an entity's first and
    last appears, empty ones with NULLs (as a resample does)."""
    b = df.filter(F.col(price).isNotNull()).withColumn("_b", F.window(F.col(time), rule).start)
    bars = b.groupBy(entity, "_b").agg(F.min_by(price, time).alias("open"), F.max(price).alias("high"),
                                       F.min(price).alias("low"), F.max_by(price, time).alias("close"))
    if not fill_gaps:
        return bars.withColumnRenamed("_b", time)
    span = bars.groupBy(entity).agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    grid = span.select(entity, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {rule}"))).alias("_b"))
    return grid.join(bars, [entity, "_b"], "left").withColumnRenamed("_b", time)


def auto_bins(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """numpy's 'auto' bin count: the smaller width of Sturges and
    Freedman-Diaconis (Sturges alone when the IQR is 0)."""
    if n == 0 or hi <= lo:
        return 1
    sturges = (hi - lo) / (math.log2(n) + 1.0)
    fd = 2.0 * (q3 - q1) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(math.ceil((hi - lo) / width)))


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """Equal-width histogram of the non-null values (D17): ``(bin, left,
    right, count)``; the last bin is closed on the right. ``bins=None`` uses
    the numpy 'auto' rule from one aggregate pass (count, min, max, quartiles)."""
    v = F.col(column).cast("double")
    src = df.select(v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    st = src.agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
                 F.percentile("_v", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).head()
    n, lo, hi = st["n"], st["lo"], st["hi"]
    if n == 0:
        return src.sparkSession.createDataFrame([], "bin int, left double, right double, count bigint")
    k = bins or auto_bins(n, lo, hi, st["q"][0], st["q"][1])
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / k
    idx = F.least(F.floor((F.col("_v") - F.lit(lo)) / F.lit(width)), F.lit(k - 1)).cast("int")
    counts = src.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = src.sparkSession.range(k).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def kde_curve(df: DataFrame, column: str, points: int = 200, fine_bins: int = 4096) -> DataFrame:
    """Gaussian KDE with Scott's bandwidth (h = std * n^(-1/5)) at ``points``
    grid positions between min and max (D17). The rows are first reduced to a
    ``fine_bins`` histogram (one aggregate), and the density is summed over bin
    centres: linear in rows, error under a bin width."""
    v = F.col(column).cast("double")
    src = df.select(v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    st = src.agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
                 F.stddev_samp("_v").alias("sd")).head()
    n, lo, hi, sd = st["n"], st["lo"], st["hi"], st["sd"]
    if not n or sd is None or sd == 0 or hi <= lo:
        return src.sparkSession.createDataFrame([], "x double, density double")
    h = sd * n ** (-0.2)
    width = (hi - lo) / fine_bins
    fine = src.groupBy(F.least(F.floor((F.col("_v") - lo) / width), F.lit(fine_bins - 1)).alias("b")).agg(
        F.count(F.lit(1)).alias("c"))
    fine = fine.select((F.lit(lo) + (F.col("b") + 0.5) * width).alias("centre"), "c")
    # at most ``fine_bins`` entries: one bounded array, used as a scalar
    # subquery and folded per grid point (no join of grid and bins)
    fine_arr = fine.agg(F.collect_list(F.struct("centre", "c")).alias("a")).select("a").scalar()
    grid = src.sparkSession.range(points).select(
        (F.lit(lo) + F.col("id") * F.lit((hi - lo) / max(points - 1, 1))).alias("x"), fine_arr.alias("_fine"))
    norm = n * h * math.sqrt(2 * math.pi)
    total = F.aggregate("_fine", F.lit(0.0), lambda acc, e: acc + e["c"] * F.exp(
        F.lit(-0.5) * ((F.col("x") - e["centre"]) / h) * ((F.col("x") - e["centre"]) / h)))
    return grid.select("x", (total / F.lit(norm)).alias("density"))


def missing_matrix(df: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Null indicator per cell (D18), keyed rows."""
    cols = [c for c in (cols or df.columns) if c != key]
    return df.select(key, *[F.col(c).isNull().alias(f"{c}_missing") for c in cols])


def missing_rate_by_bucket(df: DataFrame, time: str = "snapshot_time", unit: str = "day",
                           cols: Sequence[str] | None = None) -> DataFrame:
    """The same picture at scale: null rate per time bucket and column."""
    cols = [c for c in (cols or df.columns) if c != time]
    return df.groupBy(F.date_trunc(unit, time).alias("bucket")).agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_missing_rate") for c in cols])


def dominance_hierarchy(latest: DataFrame, top_n: int = 20, root: str = "Market") -> DataFrame:
    """Top-n caps under one root (D19): ``rollup(group, symbol)`` — leaves and
    the root total (the empty grand-total level is dropped)."""
    top = top_movers(latest, "market_cap", top_n).withColumn("group", F.lit(root))
    r = top.rollup("group", "symbol").agg(F.sum("market_cap").alias("market_cap"),
                                          F.grouping_id().alias("_level"))
    return r.filter(F.col("_level") < 3).select("group", "symbol", "market_cap")


# --------------------------------------------------------------------------- M6
def price_series(df: DataFrame, symbol: str, value: str = "price", time: str = "snapshot_time") -> DataFrame:
    """Line/area chart data: one symbol's values in time order."""
    return filter_symbols(df, symbol).select(time, value).orderBy(time)


def compare_series(df: DataFrame, symbols: Sequence[str], time: str = "snapshot_time") -> DataFrame:
    return filter_symbols(df, list(symbols)).select(time, "symbol", "price").orderBy(time, "symbol")


def bubble_frame(latest: DataFrame) -> DataFrame:
    """Bubble chart: volume (log axis), 24h change, cap as size."""
    return latest.select("symbol", "name", "volume_24h", F.log10("volume_24h").alias("log_volume"),
                         "percent_change_24h", "market_cap")


def treemap_frame(latest: DataFrame, top_n: int = 30) -> DataFrame:
    return top_movers(latest, "market_cap", top_n, cols=["symbol", "market_cap", "percent_change_24h"])


def movers_bar_frames(latest: DataFrame, top_n: int = 10) -> tuple[DataFrame, DataFrame]:
    cols = ["symbol", "percent_change_24h"]
    return (top_movers(latest, "percent_change_24h", top_n, False, cols),
            top_movers(latest, "percent_change_24h", top_n, True, cols))
