"""Tier 5: streams run with availableNow over landing folders, results read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.fixtures import dirty_tape, oracle_cte, panel, tape
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.plans.q_cleaning import NOW
from tidemark.plans.q_features import feature_set_sql
from tidemark.plans.registry import query
from tidemark.schema import CONTRACT_COLUMNS
from tidemark.session import checkpoint_dir
from tidemark.streaming import streams as ST

P = oracle_cte("panel")
T = oracle_cte("tape")
W = "(PARTITION BY symbol ORDER BY snapshot_time)"


def _dir(spark, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}/{what}"


FILES = 4       # landing files of a batch, read together by one trigger


def _land(spark, parts) -> tuple[str, object]:
    """Write each frame as FILES landing files; return (folder, schema)."""
    path = _dir(spark, "landing")
    for df in parts:
        df.repartition(FILES).write.mode("append").parquet(path)
    return path, parts[0].schema


def _source(spark, path, schema, files_per_trigger: int = FILES):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _run(stream_df, spark, fmt="parquet", partition=None, mode="append"):
    out, chk = _dir(spark, "out"), _dir(spark, "chk")
    w = stream_df.writeStream.format(fmt).option("checkpointLocation", chk).option("path", out).outputMode(mode)
    if partition:
        w = w.partitionBy(partition)
    w.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def _panel_contract(spark, sf):
    return panel(spark, sf).withColumnRenamed("coin_id", "id").select(*CONTRACT_COLUMNS)


@query("stream_ingest", P + "SELECT coin_id, snapshot_time, symbol, price FROM panel")
def q_stream_ingest(spark, sf):
    """Two overlapping landing files streamed into the store; copies dropped within the watermark."""
    c = _panel_contract(spark, sf)
    t = F.col("snapshot_time")
    path, schema = _land(spark, [c.filter(t < F.lit("2000-01-01").cast("timestamp")),
                                 c.filter(t >= F.lit("1999-10-01").cast("timestamp"))])
    out = _run(ST.stream_ingest(_source(spark, path, schema), delay="1 day", now=NOW), spark,
               partition="capture_date")
    return out.select("coin_id", "snapshot_time", "symbol", "price")


_WM = "(SELECT max(snapshot_time) - INTERVAL 1 HOUR FROM tape)"


@query("stream_ohlc", T + f"""
SELECT symbol, date_trunc('hour', snapshot_time) AS snapshot_time, arg_min(price, snapshot_time) AS open,
       max(price) AS high, min(price) AS low, arg_max(price, snapshot_time) AS close
FROM tape WHERE price IS NOT NULL GROUP BY 1, 2
HAVING date_trunc('hour', snapshot_time) + INTERVAL 1 HOUR <= {_WM}""")
def q_stream_ohlc(spark, sf):
    """Hourly bars from an event-time stream (1 hour watermark); closed bars only."""
    tp = tape(spark, sf).select("symbol", "snapshot_time", "price")
    path, schema = _land(spark, [tp])
    return _run(ST.stream_ohlc(_source(spark, path, schema)), spark)


def _steps(spark, sf):
    tp = tape(spark, sf).select("symbol", "snapshot_time", "price")
    path, schema = _land(spark, [tp])
    return _run(ST.stream_step_features(_source(spark, path, schema)), spark)


@query("stream_flash_crash", T + f"""
SELECT symbol, snapshot_time, price, LAG(price) OVER {W} AS prev_price,
  coalesce(price / nullif(LAG(price) OVER {W}, 0) - 1 < -0.08 OR (LAG(price) OVER {W} = 0 AND price < 0), false) AS is_flash_crash,
  coalesce(price / nullif(LAG(price) OVER {W}, 0) - 1 > 0.1 OR (LAG(price) OVER {W} = 0 AND price > 0), false) AS is_price_spike
FROM tape QUALIFY snapshot_time <= {_WM}""")
def q_stream_flags(spark, sf):
    """S3: per-user one-step crash/spike flags from keyed streaming state, in event-time order."""
    return _steps(spark, sf).select("symbol", "snapshot_time", "price", "prev_price", "is_flash_crash",
                                    "is_price_spike")


@query("stream_ema", T + f"""
SELECT symbol, snapshot_time, {fix6_sql(f"list_reduce(list(price) OVER (PARTITION BY symbol ORDER BY snapshot_time ROWS BETWEEN 255 PRECEDING AND CURRENT ROW), lambda acc, x: acc * {1 - 2 / 13!r} + x * {2 / 13!r})")} AS ema_12
FROM tape QUALIFY snapshot_time <= {_WM}""")
def q_stream_ema(spark, sf):
    """The recursive EMA carried in streaming state."""
    return _steps(spark, sf).select("symbol", "snapshot_time", fix6("ema_12").alias("ema_12"))


@query("stream_future_guard", oracle_cte("dirty_tape") + f"""
SELECT DISTINCT coin_id, snapshot_time FROM dirty_tape WHERE snapshot_time <= TIMESTAMP '{NOW}'""")
def q_stream_guard(spark, sf):
    """Rows stamped after 'now' are dropped before the watermark; keys de-duplicated."""
    d = dirty_tape(spark, sf).select("ingest_ord", "coin_id", "symbol", "price", "snapshot_time")
    path, schema = _land(spark, [d])
    out = _run(ST.stream_ingest(_source(spark, path, schema), delay="1 day", now=NOW), spark)
    return out.select("coin_id", "snapshot_time")


FB_COLS = ["hourly_return", "daily_return", "rolling_mean_3", "market_dominance", "price_rank"]


def _refreshed(spark, sf, how=lambda parts: parts, again=False, **options):
    """The panel in three batches through ``refresh_batch``; the rows it leaves."""
    c = _panel_contract(spark, sf)
    t = F.col("snapshot_time")
    cuts = [F.lit(x).cast("timestamp") for x in ("1997-01-01", "1999-06-01")]
    parts = how([c.filter(t < cuts[0]), c.filter((t >= cuts[0]) & (t < cuts[1])), c.filter(t >= cuts[1])])
    path, schema = _land(spark, parts)
    store, feats = _dir(spark, "store"), _dir(spark, "features")
    body = ST.refresh_batch(store, feats, **options)

    def deliver(batch, batch_id):
        body(batch, batch_id)
        if again:
            body(batch, batch_id)
    q = (_source(spark, path, schema).writeStream.option("checkpointLocation", _dir(spark, "chk"))
         .foreachBatch(deliver).trigger(availableNow=True).start())
    q.awaitTermination()
    out = ST.latest_features(spark.read.parquet(feats))
    return out.select("symbol", "snapshot_time", "price", "hourly_return", "daily_return",
                      fix6("rolling_mean_3").alias("rolling_mean_3"),
                      fix6("market_dominance").alias("market_dominance"), "price_rank")


@query("foreach_batch_refresh", feature_set_sql("panel", P) + "SELECT symbol, snapshot_time, price, hourly_return, "
       f"daily_return, {fix6_sql('rolling_mean_3')} AS rolling_mean_3, {fix6_sql('market_dominance')} AS market_dominance, "
       "price_rank FROM ms")
def q_foreach_batch(spark, sf):
    """Micro-batches of whole snapshots stored, then features rebuilt for the touched symbols."""
    return _refreshed(spark, sf)


@query("foreach_batch_refresh_hard", feature_set_sql("panel", P) + "SELECT symbol, snapshot_time, price, hourly_return, "
       f"daily_return, {fix6_sql('rolling_mean_3')} AS rolling_mean_3, {fix6_sql('market_dominance')} AS market_dominance, "
       "price_rank FROM ms")
def q_foreach_batch_hard(spark, sf):
    """S6 with every batch delivered twice, snapshots split over batches and late rows: the
    odd coins of each part arrive with the part after it (the last part's with it)."""
    def late(parts):
        odd = F.pmod(F.col("id").cast("int"), F.lit(2)) == 1
        held = [p.filter(odd) for p in parts]
        even = [p.filter(~odd) for p in parts]
        return [even[0], even[1].unionByName(held[0]), even[2].unionByName(held[1]).unionByName(held[2])]
    return _refreshed(spark, sf, late, again=True)


@query("stream_price_spike", T + f"""
SELECT symbol, snapshot_time,
  coalesce(price / nullif(LAG(price) OVER {W}, 0) - 1 > 0.1 OR (LAG(price) OVER {W} = 0 AND price > 0), false) AS is_price_spike
FROM tape QUALIFY snapshot_time <= {_WM}""")
def q_stream_spike(spark, sf):
    """S3: the price-spike alert from the same keyed state."""
    return _steps(spark, sf).select("symbol", "snapshot_time", "is_price_spike")


@query("stream_ingest_payloads", P + "SELECT coin_id, snapshot_time, symbol, cmc_rank, price FROM panel")
def q_stream_payloads(spark, sf):
    """S1 end to end: JSON payload lines (one per snapshot) streamed, decoded, de-duplicated, stored."""
    from tidemark.sources.payloads import encode_nested
    lines = encode_nested(panel(spark, sf)).select(F.col("snapshot_time").cast("string").alias("snapshot_time"),
                                                   "payload")
    path = _dir(spark, "landing")
    lines.repartition(FILES).write.mode("append").json(path)
    src = spark.readStream.schema("snapshot_time string, payload string").option("maxFilesPerTrigger", FILES).json(path)
    out = _run(ST.stream_payloads(src, delay="1 day", now=NOW), spark, partition="capture_date")
    return out.select("coin_id", "snapshot_time", "symbol", "cmc_rank", "price")


@query("foreach_batch_refresh_tail", feature_set_sql("panel", P) + "SELECT symbol, snapshot_time, price, hourly_return, "
       f"daily_return, {fix6_sql('rolling_mean_3')} AS rolling_mean_3, {fix6_sql('market_dominance')} AS market_dominance, "
       "price_rank FROM ms")
def q_foreach_batch_tail(spark, sf):
    """S6 with a look-back of 48 rows, the longest that these columns need (the daily
    return's), so that the cut acts on the panel's 79 rows a coin."""
    return _refreshed(spark, sf, lookback_rows=48)
