"""Structured Streaming versions of ingest, bars, alerts and refresh.

The reference polls every 30 minutes and recomputes all history. Here the
same logic runs as streams over landing folders:

* S1 ``stream_ingest``: contract rows → future-time guard → watermark →
  ``dropDuplicatesWithinWatermark`` on the natural key (first copy wins, as
  insert-ignore) → append to the date-partitioned store.
* S2 ``stream_ohlc``: tumbling event-time windows with a watermark.
* S3/S4 ``stream_step_features``: keyed state of symbols
  (``applyInPandasWithState``): rows are buffered until the watermark passes
  them, then emitted in time order with the one-step return flags and the
  recursive EMA carried from the previous row. Symbols share state keys by hash
  (``STEP_BUCKETS``); a key's state is the pending rows and each symbol's last price and EMA.
* S5 ``stream_future_guard``: drop rows stamped after "now" *before* the
  watermark, so one bad clock cannot make every later row late.
* S6 ``refresh_batch``: ``foreachBatch`` body that stores the micro-batch and
  recomputes features for the touched symbols only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


FLASH_CRASH_DROP = -0.08
PRICE_SPIKE_RISE = 0.10
EMA_ALPHA = 2.0 / 13.0


def stream_future_guard(stream: DataFrame, now=None, time: str = "snapshot_time") -> DataFrame:
    """Keep rows at or before ``now`` (current time if None)."""
    limit = F.current_timestamp() if now is None else F.lit(now).cast(T.TimestampType())
    return stream.filter(F.col(time).cast(T.TimestampType()) <= limit)


def stream_ingest(stream: DataFrame, delay: str = "1 day", now=None, time: str = "snapshot_time",
                  keys=("coin_id", "snapshot_time")) -> DataFrame:
    """Guarded, de-duplicated contract rows ready for an append sink."""
    s = stream.withColumnsRenamed({"id": "coin_id"}) if "id" in stream.columns else stream
    s = stream_future_guard(s, now, time).withColumn(time, F.col(time).cast(T.TimestampType()))
    return (s.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
            .withColumn("capture_date", F.to_date(time)))


def stream_ohlc(stream: DataFrame, rule: str = "1 hour", delay: str = "1 hour", entity: str = "symbol",
                time: str = "snapshot_time", price: str = "price") -> DataFrame:
    """Event-time OHLC bars; in append mode a bar is emitted once the
    watermark passes its end."""
    s = stream.withColumn(time, F.col(time).cast(T.TimestampType())).filter(F.col(price).isNotNull())
    return (s.withWatermark(time, delay)
            .groupBy(entity, F.window(time, rule).alias("_w"))
            .agg(F.min_by(price, time).alias("open"), F.max(price).alias("high"),
                 F.min(price).alias("low"), F.max_by(price, time).alias("close"))
            .select(entity, F.col("_w.start").alias(time), "open", "high", "low", "close"))


STEP_OUT = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("snapshot_time", T.TimestampType()),
    T.StructField("price", T.DoubleType()), T.StructField("prev_price", T.DoubleType()),
    T.StructField("is_flash_crash", T.BooleanType()), T.StructField("is_price_spike", T.BooleanType()),
    T.StructField("ema_12", T.DoubleType()),
])
STEP_STATE = T.StructType([
    T.StructField("pend_s", T.ArrayType(T.StringType())), T.StructField("pend_t", T.ArrayType(T.LongType())),
    T.StructField("pend_p", T.ArrayType(T.DoubleType())), T.StructField("last_s", T.ArrayType(T.StringType())),
    T.StructField("last_p", T.ArrayType(T.DoubleType())), T.StructField("ema", T.ArrayType(T.DoubleType())),
])
STEP_BUCKETS = 4096     # state keys: symbols share one by hash, as a call per key costs more than its rows


def _step_flags(cur: np.ndarray, prev: np.ndarray, drop: float, rise: float) -> tuple[np.ndarray, np.ndarray]:
    """Crash and spike flags; nothing is flagged after a missing price (NaN)."""
    with np.errstate(all="ignore"):
        step = cur / prev - 1
        zero = prev == 0
        return np.where(zero, cur < 0, step < drop), np.where(zero, cur > 0, step > rise)


def _step_state_fn(drop: float, rise: float, alpha: float):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pend_s, pend_t, pend_p, last_s, last_p, last_e = (x or [] for x in state.get) if state.exists else ([],) * 6
        parts = [(np.array(pend_s, object), np.array(pend_t, np.int64), np.array(pend_p, float))]
        parts += [(f["symbol"].to_numpy(object), f["_us"].to_numpy(np.int64), f["price"].to_numpy(float)) for f in pdfs]
        names, times, prices = (np.concatenate(x) for x in zip(*parts))
        codes, symbols = pd.factorize(np.concatenate([np.array(last_s, object), names]), use_na_sentinel=False)
        # each symbol's newest emitted price and EMA; the state's symbols have the first codes
        known = len(last_s)
        prev_p = np.concatenate([np.array(last_p, float), np.full(len(symbols) - known, np.nan)])
        prev_e = list(last_e) + [None] * (len(symbols) - known)
        codes = codes[known:]
        order = np.lexsort((times, codes))
        passed = times[order] <= state.getCurrentWatermarkMs() * 1000
        keep, order = np.sort(order[~passed]), order[passed]
        out = None
        if len(order):
            c, t, p = codes[order], times[order], prices[order]
            first = np.append(True, c[1:] != c[:-1])
            prev = np.where(first, prev_p[c], np.append(np.nan, p[:-1]))
            emas = []
            for new, i, x in zip(first.tolist(), c.tolist(), p.tolist()):
                ema = prev_e[i] if new else ema
                ema = x if ema is None else ema * (1.0 - alpha) + x * alpha
                emas.append(ema)
            last = np.flatnonzero(np.append(first[1:], True))
            prev_p[c[last]] = p[last]
            for i, e in zip(c[last].tolist(), last.tolist()):
                prev_e[i] = emas[e]
            crash, spike = _step_flags(p, prev, drop, rise)
            out = pd.DataFrame({"symbol": symbols[c], "snapshot_time": t.astype("datetime64[us]"), "price": p, "prev_price": prev,
                                "is_flash_crash": crash, "is_price_spike": spike, "ema_12": emas}, copy=False)  # naive UTC (session zone)
        seen = [i for i, e in enumerate(prev_e) if e is not None]
        state.update((names[keep].tolist(), times[keep].tolist(), prices[keep].tolist(), [symbols[i] for i in seen],
                      prev_p[seen].tolist(), [prev_e[i] for i in seen]))
        if len(keep):
            state.setTimeoutTimestamp(max(int(times[keep].min()) // 1000, state.getCurrentWatermarkMs() + 1))
        if out is not None:
            yield out
    return fn


def stream_step_features(stream: DataFrame, delay: str = "1 hour", drop: float = FLASH_CRASH_DROP,
                         rise: float = PRICE_SPIKE_RISE, alpha: float = EMA_ALPHA, entity: str = "symbol",
                         time: str = "snapshot_time", price: str = "price", buckets: int = STEP_BUCKETS) -> DataFrame:
    """Per-symbol one-step flags and EMA, emitted in event-time order
    once the watermark passes each row."""
    s = (stream.select(F.col(entity).alias("symbol"), F.col(time).cast(T.TimestampType()).alias("snapshot_time"),
                       F.col(price).cast("double").alias("price"))
         .filter(F.col("price").isNotNull()).withWatermark("snapshot_time", delay)
         .withColumn("_us", F.unix_micros("snapshot_time")))
    s = s.withColumn("_bucket", F.pmod(F.xxhash64("symbol"), F.lit(buckets)))
    return s.groupBy("_bucket").applyInPandasWithState(
        _step_state_fn(drop, rise, alpha), STEP_OUT, STEP_STATE, "append", GroupStateTimeout.EventTimeTimeout)


FULL_LOOKBACK_ROWS = 336     # the longest look-back of the feature set (weekly return)


def refresh_batch(store_path: str, features_path: str, lookback_rows: int = FULL_LOOKBACK_ROWS,
                  outputs_path: str | None = None, checkpoint: bool = True):
    """A ``foreachBatch`` body: stores the micro-batch (insert-ignore) and rebuilds
    the features that it changes.

    Rebuilt are the touched symbols' rows from their earliest row of the batch on (a late
    row reaches those after it) and, for the cross-section, all rows of the snapshot
    times among them. Entity windows look back ``lookback_rows`` rows per symbol, a
    count that holds at any cadence, so results equal a full rebuild. The rows replace
    what the same ``batch_id`` wrote before, so a redelivered batch changes
    nothing; ``latest_features`` reads the newest version of each row. With
    ``outputs_path`` the newest snapshot of the whole history with its anomaly flags, and a run
    summary over the store, are written there."""
    from tidemark.operators.anomaly import run_anomaly_pipeline
    from tidemark.operators.features import build_feature_set
    from tidemark.operators.reports import run_summary
    from tidemark.operators.series import materialize, ordinal, with_entity_windows
    from tidemark.operators.snapshots import latest_snapshot
    from tidemark.sources.store import upsert_ignore

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        contract = batch.withColumnsRenamed({"coin_id": "id"}) if "coin_id" in batch.columns else batch
        inserted = upsert_ignore(contract.drop("capture_date"), store_path)
        spark = batch.sparkSession
        store = spark.read.parquet(store_path).drop("inserted_at")
        first = batch.groupBy("symbol").agg(F.min("snapshot_time").alias("_from"))
        redo = materialize(store.join(first, "symbol").filter(F.col("snapshot_time") >= F.col("_from"))
                           .select("symbol", "snapshot_time"))
        times = materialize(redo.select("snapshot_time").distinct())
        # whole snapshots, each symbol from its first of them on, and its look-back before that
        whole = materialize(store.join(times, "snapshot_time", "left_semi").groupBy("symbol")
                            .agg(F.min("snapshot_time").alias("_from")))
        hist = store.join(whole, "symbol")

        def rank_back(fr, w):
            return fr.withColumn("_back", F.col("_total") - ordinal("symbol", "snapshot_time"))
        before = with_entity_windows(hist.filter(F.col("snapshot_time") < F.col("_from")), rank_back, lookback=0)
        hist = (before.filter(F.col("_back") <= lookback_rows).drop("_back")
                .unionByName(hist.filter(F.col("snapshot_time") >= F.col("_from")))).drop("_from", "capture_date")
        feats = build_feature_set(hist, checkpoint=checkpoint)
        keys = store.join(times, "snapshot_time", "left_semi").select("symbol", "snapshot_time")
        out = feats.join(keys, ["symbol", "snapshot_time"], "left_semi")
        out.write.mode("overwrite").parquet(f"{features_path.rstrip('/')}/batch_id={batch_id}")
        if outputs_path:
            # the flags' per-symbol statistics and one-step returns are those of the whole history
            history = latest_features(spark.read.parquet(features_path))
            final = run_anomaly_pipeline(history)
            latest_snapshot(final).write.mode("overwrite").parquet(f"{outputs_path}/latest")
            run_summary(store, final, inserted).write.mode("overwrite").parquet(f"{outputs_path}/summary/batch_id={batch_id}")
    return run


def latest_features(features: DataFrame, keys: Sequence[str] = ("symbol", "snapshot_time")) -> DataFrame:
    """The newest version of each row that ``refresh_batch`` wrote."""
    cols = [c for c in features.columns if c != "batch_id"]
    newest = features.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch_id").alias("_r"))
    return newest.select("_r.*").select(*cols)


def stream_payloads(stream: DataFrame, provider: str = "nested", convert: str = "USD",
                    delay: str = "1 day", now=None) -> DataFrame:
    """S1 from raw landing files: one JSON payload per line with its capture
    time, ``{"snapshot_time": ..., "payload": "<provider JSON>"}``, decoded
    into contract rows (a rejected batch yields nothing) and ingested."""
    from tidemark.sources.payloads import decode_flat_quotes, decode_nested_quotes
    s = stream.withColumn("snapshot_time", F.col("snapshot_time").cast(T.TimestampType()))
    rows = (decode_nested_quotes(s, convert=convert) if provider == "nested" else decode_flat_quotes(s))
    return stream_ingest(rows, delay=delay, now=now)
