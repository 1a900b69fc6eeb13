"""Market anomaly flags and the anomaly pipeline.

Physical shape: the symbol-keyed flags (one-step returns, per-symbol
z-scores) need no cross-section, so they run first on the chunked entity
frame; the snapshot-keyed model flags (LOF, isolation forest) run after.
Per-symbol whole-history statistics are grouped aggregates joined back, so a
hot symbol is combined map-side rather than windowed in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ratio_below, ratio_exceeds
from tidemark.operators.series import materialize, sized_join, stage, with_entity_windows

# Default thresholds and model settings.
FLASH_CRASH_DROP = -0.08
PRICE_SPIKE_RISE = 0.10
ZSCORE_THRESHOLD = 3.0
CONTAMINATION = 0.03
ML_MIN_ROWS = 10
ML_COLUMNS = ["price", "market_cap", "volume_24h", "percent_change_24h"]
ANOMALY_FLAGS = ["is_flash_crash", "is_price_spike", "is_volume_spike", "is_market_cap_anomaly",
                 "is_isolation_forest_anomaly", "is_lof_anomaly"]


def step_flags(df: DataFrame, drop_threshold: float = FLASH_CRASH_DROP,
               spike_threshold: float = PRICE_SPIKE_RISE, entity: str = "symbol",
               time: str = "snapshot_time", **chunking) -> DataFrame:
    """``is_flash_crash`` (one-step return < drop) and ``is_price_spike``
    (> rise) per entity (J5, J6). The return is computed once; a zero base
    with a positive price counts as +inf (a spike), as in float division."""
    def build(frame, w):
        prev = F.lag("price", 1).over(w)
        return frame.withColumns({"is_flash_crash": ratio_below("price", prev, drop_threshold),
                                  "is_price_spike": ratio_exceeds("price", prev, spike_threshold)})
    return with_entity_windows(df, build, entity, time, lookback=1, **chunking)


def flash_crash(df: DataFrame, drop_threshold: float = FLASH_CRASH_DROP, **kw) -> DataFrame:
    return step_flags(df, drop_threshold=drop_threshold, **kw).drop("is_price_spike")


def price_spike(df: DataFrame, spike_threshold: float = PRICE_SPIKE_RISE, **kw) -> DataFrame:
    return step_flags(df, spike_threshold=spike_threshold, **kw).drop("is_flash_crash")


def group_zscores(df: DataFrame, cols: dict[str, str], by: str = "symbol") -> DataFrame:
    """``(x - mean) / std`` (sample std) per group for each ``col -> out``;
    0 for the whole group when its std is 0 or undefined (E18)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_samp(c).alias(f"_sd_{c}")]
    stats = materialize(df.groupBy(by).agg(*aggs))
    out = sized_join(df, stats, by, "left")
    new = {}
    for c, name in cols.items():
        sd = F.col(f"_sd_{c}")
        new[name] = F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise((F.col(c) - F.col(f"_mu_{c}")) / sd)
    drop = [f"_{p}_{c}" for c in cols for p in ("mu", "sd")]
    return out.withColumns(new).drop(*drop)


def volume_spike(df: DataFrame, z_threshold: float | None = None, by: str = "symbol") -> DataFrame:
    """``volume_zscore`` and ``is_volume_spike`` = |z| > threshold."""
    z = ZSCORE_THRESHOLD if z_threshold is None else z_threshold
    out = group_zscores(df, {"volume_24h": "volume_zscore"}, by)
    return out.withColumn("is_volume_spike", F.coalesce(F.abs("volume_zscore") > z, F.lit(False)))


def market_cap_anomaly(df: DataFrame, z_threshold: float | None = None, by: str = "symbol") -> DataFrame:
    """``market_cap_zscore`` and ``is_market_cap_anomaly``."""
    z = ZSCORE_THRESHOLD if z_threshold is None else z_threshold
    out = group_zscores(df, {"market_cap": "market_cap_zscore"}, by)
    return out.withColumn("is_market_cap_anomaly", F.coalesce(F.abs("market_cap_zscore") > z, F.lit(False)))


def ml_anomalies(df: DataFrame, columns: Sequence[str] = ML_COLUMNS, group: str = "snapshot_time",
                 key: str = "symbol", isolation_forest: bool = True, lof: bool = True,
                 seed: int = 42, accuracy: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Per snapshot with at least 10 rows: isolation forest (J10) and LOF
    (J9) flags at 3 % contamination; smaller snapshots are never flagged."""
    out = df
    if isolation_forest:
        from tidemark.operators.forest import isolation_forest_flags
        out = isolation_forest_flags(out, list(columns), group=group, contamination=CONTAMINATION,
                                     seed=seed, min_rows=ML_MIN_ROWS, accuracy=accuracy, key=[key],
                                     checkpoint=checkpoint)
    else:
        out = out.withColumn("is_isolation_forest_anomaly", F.lit(False))
    if lof:
        from tidemark.operators.lof import lof_flags
        out = lof_flags(out, list(columns), group, key, contamination=CONTAMINATION,
                        min_rows=ML_MIN_ROWS, accuracy=accuracy)
    else:
        out = out.withColumn("is_lof_anomaly", F.lit(False))
    return out


def anomaly_score(df: DataFrame, flags: Sequence[str] = ANOMALY_FLAGS) -> DataFrame:
    """``anomaly_score`` = number of raised flags, ``is_any_anomaly`` = score > 0."""
    score = None
    for f in flags:
        term = F.col(f).cast("int")
        score = term if score is None else score + term
    return df.withColumn("anomaly_score", score.cast("bigint")).withColumn(
        "is_any_anomaly", F.col("anomaly_score") > 0)


def run_anomaly_pipeline(df: DataFrame, isolation_forest: bool = True, lof: bool = True,
                         seed: int = 42, accuracy: int | None = None, checkpoint: bool = True,
                         **chunking) -> DataFrame:
    """M2: J5-J8 on the entity frame, then J9/J10 per snapshot, then J11.

    Stage boundary before the models: LOF and the forest read their input
    several times (medians, counts, blocks, neighbours)."""
    out = step_flags(df, **chunking)
    out = group_zscores(out, {"volume_24h": "volume_zscore", "market_cap": "market_cap_zscore"})
    out = stage(out.withColumns({
        "is_volume_spike": F.coalesce(F.abs("volume_zscore") > ZSCORE_THRESHOLD, F.lit(False)),
        "is_market_cap_anomaly": F.coalesce(F.abs("market_cap_zscore") > ZSCORE_THRESHOLD, F.lit(False)),
    }), checkpoint)
    out = ml_anomalies(out, isolation_forest=isolation_forest, lof=lof, seed=seed, accuracy=accuracy, checkpoint=not checkpoint)
    return stage(anomaly_score(out), checkpoint)


def filter_flagged(df: DataFrame, time: str = "snapshot_time") -> DataFrame:
    """Rows with any anomaly, newest first, five columns."""
    return (df.filter(F.col("is_any_anomaly"))
            .select(time, "symbol", "price", "percent_change_24h", "anomaly_score")
            .orderBy(F.desc(time), "symbol"))
