"""Stream semantics: a row stamped in the far future is dropped before the
watermark, so it cannot make later on-time rows late; distinct-time ranking
is the same however the times are chunked."""

import uuid

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from paths import SF_SMALL
from tidemark.fixtures import tape
from tidemark.session import checkpoint_dir
from tidemark.streaming import streams


def _dir(spark, what):
    return f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}/{what}"


def _write(spark, path, rows):
    pdf = pd.DataFrame(rows, columns=["coin_id", "symbol", "price", "snapshot_time"])
    pdf["snapshot_time"] = pd.to_datetime(pdf["snapshot_time"])
    spark.createDataFrame(pdf).coalesce(1).write.mode("append").parquet(path)


def test_future_row_does_not_advance_watermark(spark):
    land = _dir(spark, "landing")
    _write(spark, land, [("1", "A", 1.0, "2024-01-01 00:00"), ("2", "B", 1.0, "2200-01-01 00:00")])
    _write(spark, land, [("1", "A", 2.0, "2024-01-01 01:00")])
    schema = spark.read.parquet(land).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(land)
    out, chk = _dir(spark, "out"), _dir(spark, "chk")
    q = (streams.stream_ingest(src, delay="10 minutes", now="2030-01-01")
         .writeStream.format("parquet").option("checkpointLocation", chk).option("path", out)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    # both on-time rows of A are kept; the 2200 row is gone and did not make the second file late
    assert sorted(r["price"] for r in got.filter("symbol = 'A'").collect()) == [1.0, 2.0]
    assert got.filter("symbol = 'B'").count() == 0


def test_time_rank_chunked_equals_window(spark):
    from tidemark.operators import snapshots
    from tidemark.operators.series import with_entity_windows, ordinal
    t = tape(spark, SF_SMALL)
    ref = (t.select("snapshot_time").distinct()
           .withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("snapshot_time")))))
    times = t.select("snapshot_time").distinct().withColumn("_one", F.lit(1))

    def build(fr, w):
        return fr.withColumn("snap_rank", (F.col("_total") - ordinal("_one", "snapshot_time")).cast("int"))
    small = with_entity_windows(times, build, "_one", "snapshot_time", lookback=0, chunk_rows=37, bucket="hour")
    assert small.join(ref, "snapshot_time").filter("snap_rank <> r").count() == 0
    assert snapshots.time_rank(t).join(ref, "snapshot_time").filter("snap_rank <> r").count() == 0


def test_symbols_share_state_keys(spark, tmp_path):
    """Many symbols, few state keys: steps stay each symbol's own over several batches, also late in order."""
    import numpy as np
    rng = np.random.default_rng(2)
    rows = [(f"S{i % 40}" if i % 41 else None, 1_700_000_000 + int(t), float(p))
            for i, (t, p) in enumerate(zip(rng.permutation(4000) * 60, rng.integers(0, 9, 4000)))]
    df = spark.createDataFrame(rows, "symbol string, t long, price double").selectExpr("symbol", "timestamp_seconds(t) as snapshot_time", "price")
    src = str(tmp_path / "in")
    for k in range(3):
        df.where(f"int(unix_seconds(snapshot_time) / 80000) % 3 = {k}").coalesce(1).write.mode("append").parquet(src)
    from tidemark.streaming import streams
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(src)
    out = streams.stream_step_features(stream, buckets=3)
    (out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "chk")).option("path", str(tmp_path / "out"))
     .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(str(tmp_path / "out"))
    limit = max(t for _, t, _ in rows) - 3600
    want, ema = {}, {}
    last = {}
    for s, t, p in sorted(rows, key=lambda r: r[1]):
        if t <= limit:
            prev = last.get(s)
            ema[s] = p if s not in ema else ema[s] * (1 - 2 / 13) + p * (2 / 13)
            want[s, t] = (p, prev, prev is not None and (p > 0 if prev == 0 else p / prev - 1 > 0.1), round(ema[s], 9))
            last[s] = p
    assert {(r.symbol, r.t): (r.price, r.prev_price, r.is_price_spike, round(r.ema_12, 9)) for r in
            got.selectExpr("*", "unix_seconds(snapshot_time) t").collect()} == want
