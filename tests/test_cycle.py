"""A whole cycle over overlapping batches; per-symbol model orders; insert order."""

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from paths import SF_SMALL
from tidemark.fixtures import panel
from tidemark.operators import models
from tidemark.schema import CONTRACT_COLUMNS, CONTRACT_SCHEMA
from tidemark.session import checkpoint_dir
from tidemark.sources import store


def test_cycle_over_overlapping_batches(spark):
    base = f"{checkpoint_dir(spark)}/cycle-{uuid.uuid4().hex}"
    p = panel(spark, SF_SMALL).withColumnRenamed("coin_id", "id").select(*CONTRACT_COLUMNS)
    t = F.col("snapshot_time")
    first, second = p.filter(t < "2000-01-01"), p.filter(t >= "1999-07-01")
    a = store.run_cycle(first, f"{base}/store", f"{base}/backup").head()
    assert a["rows_inserted"] == first.count() == a["total_rows_in_db"]
    b = store.run_cycle(second, f"{base}/store", f"{base}/backup", f"{base}/out").head()
    assert b["rows_inserted"] == p.filter(t >= "2000-01-01").count() and b["total_rows_in_db"] == p.count()
    stored = spark.read.parquet(f"{base}/store")
    assert stored.select("coin_id", "snapshot_time").distinct().count() == p.count()
    assert store.read_csv(spark, f"{base}/backup", CONTRACT_SCHEMA).count() == first.count() + second.count()
    latest = spark.read.option("header", True).csv(f"{base}/out/latest")
    assert latest.count() == b["coins_in_latest_snapshot"] == p.filter(t == p.agg(F.max("snapshot_time")).head()[0]).count()
    # later writes come after earlier ones in table order
    cut = stored.groupBy(t < "2000-01-01").agg(F.min("ingest_ord").alias("lo"), F.max("ingest_ord").alias("hi")).collect()
    old, new = sorted(cut, key=lambda r: not r[0])
    assert old["hi"] < new["lo"]


def test_first_copy_wins_however_partitioned(spark):
    one = panel(spark, SF_SMALL).withColumnRenamed("coin_id", "id").select(*CONTRACT_COLUMNS).limit(20)
    rows = one.withColumn("o", F.lit(1)).unionByName(one.withColumn("price", F.col("price") + 1).withColumn("o", F.lit(0)))
    for n in (1, 7):
        path = f"{checkpoint_dir(spark)}/first-{uuid.uuid4().hex}"
        assert store.upsert_ignore(rows.repartition(n), path, order="o") == 20
        got = spark.read.parquet(path).join(one.select(F.col("id").alias("coin_id"), "snapshot_time", F.col("price").alias("p0")), ["coin_id", "snapshot_time"])
        assert got.filter(F.col("price") != F.col("p0") + 1).count() == 0


def _walk(n, seed, symbol):
    rng = np.random.default_rng(seed)
    y = 100 + np.cumsum(rng.normal(0, 1, n))
    return pd.DataFrame({"symbol": symbol, "snapshot_time": pd.date_range("2024-01-01", periods=n, freq="30min"), "price": y})


def test_short_symbol_leaves_neighbour_alone(spark):
    long = _walk(400, 1, "LONG")
    both = pd.concat([long, _walk(9, 2, "SHORT")])
    rows = [spark.createDataFrame(x) for x in (long, both)]
    alone, beside = [{r.step: r.yhat for r in models.forecast_arima(d, backtest=False)[0].filter("symbol = 'LONG'").collect()} for d in rows]
    assert alone.keys() == beside.keys() and all(abs(alone[k] - beside[k]) < 1e-9 for k in alone)


def test_every_symbol_gets_a_row(spark):
    d = spark.createDataFrame(pd.concat([_walk(400, 1, "LONG"), _walk(90, 3, "MID"), _walk(5, 4, "TINY")]))
    got = models.forecast_sarima(d, backtest=False, steps=4)[0].collect()
    by = {s: [r for r in got if r.symbol == s] for s in ("LONG", "MID", "TINY")}
    assert [r.status for r in by["LONG"]] == ["ok"] * 4 and [r.status for r in by["MID"]] == ["ok"] * 4
    assert [(r.status, r.step) for r in by["TINY"]] == [("too_short", None)]


def test_insert_order_is_unique_over_many_partitions(spark):
    rows = (spark.range(3000, numPartitions=300)
            .select(F.col("id").cast("string").alias("coin_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3).alias("snapshot_time"),
                    (F.lit(1_700_000_000_000_000) - F.col("id")).alias("o")))
    path = f"{checkpoint_dir(spark)}/order-{uuid.uuid4().hex}"
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert store.upsert_ignore(rows.filter("id % 2 = 0"), path, order="o") == 1500
        assert store.upsert_ignore(rows, path, order="o") == 1500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = [(r.ingest_ord, r.o, int(r.coin_id) % 2) for r in spark.read.parquet(path).collect()]
    assert len({x for x, _, _ in got}) == 3000
    for odd in (0, 1):      # table order is the batch's order inside a write
        assert [o for _, o, k in sorted(got) if k == odd] == sorted(o for _, o, k in got if k == odd)
    assert max(x for x, _, k in got if k == 0) < min(x for x, _, k in got if k == 1)


def test_refresh_outputs_equal_the_whole_run(spark):
    from tidemark.operators.anomaly import ANOMALY_FLAGS, run_anomaly_pipeline
    from tidemark.operators.features import build_feature_set
    from tidemark.operators.snapshots import latest_snapshot
    from tidemark.streaming.streams import refresh_batch
    base = f"{checkpoint_dir(spark)}/refresh-{uuid.uuid4().hex}"
    p = panel(spark, SF_SMALL).withColumnRenamed("coin_id", "id").select(*CONTRACT_COLUMNS)
    times = sorted(r.snapshot_time for r in p.select("snapshot_time").distinct().collect())
    t = F.col("snapshot_time")
    p = p.filter(t < times[18]).cache()
    late = (F.col("symbol") == p.filter(t == times[7]).first().symbol) & (t == times[7])
    body = refresh_batch(f"{base}/store", f"{base}/features", outputs_path=f"{base}/out")
    batches = [p.filter((t < times[12]) & ~late), p.filter(t >= times[12]), p.filter(late)]
    for i, b in enumerate(batches):
        body(b, i)
    body(batches[1], 1)         # redelivered
    history = store.scan_store(spark, f"{base}/store").drop("capture_date", "inserted_at")
    want = latest_snapshot(run_anomaly_pipeline(build_feature_set(history)))
    cols = ["symbol", "snapshot_time", *ANOMALY_FLAGS, "anomaly_score"]
    got = spark.read.parquet(f"{base}/out/latest")
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    last = spark.read.parquet(f"{base}/out/summary/batch_id=2").head()
    assert last["total_rows_in_db"] == p.count() and last["rows_inserted"] == batches[2].count()
