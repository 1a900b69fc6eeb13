"""Properties for operators without an exact SQL oracle, and the skew paths
(small chunks, split ranks, multi-block neighbour search) against the plain
single-partition answer."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paths import SF_MID, SF_SMALL
from tidemark.fixtures import bars, panel, tape
from tidemark.operators import anomaly as A
from tidemark.operators import cluster as CL
from tidemark.operators import features as FE
from tidemark.operators import timeseries as TS
from tidemark.operators.forest import isolation_forest_flags
from tidemark.operators.lof import lof_scores
from tidemark.operators.series import group_rank


def _pdf(df, keys):
    return df.toPandas().sort_values(keys).reset_index(drop=True)


def test_chunked_windows_equal_unchunked(spark):
    """Tiny chunks (every halo path used) give the same features as one chunk."""
    b = bars(spark, SF_SMALL)
    cols = ["symbol", "snapshot_time", "hourly_return", "weekly_return", "rolling_std_24", "ema_12",
            "price_acceleration", "sharpe_ratio_simplified"]
    big = _pdf(FE.add_return_features(b).select(*cols), ["symbol", "snapshot_time"])
    small = _pdf(FE.add_return_features(b, chunk_rows=7, bucket="hour").select(*cols), ["symbol", "snapshot_time"])
    pd.testing.assert_frame_equal(big, small, check_exact=False, rtol=1e-12)


def test_lookahead_halo(spark):
    """Centred frames (decomposition) with tiny chunks equal one chunk."""
    from tidemark.operators.series import with_entity_windows
    b = bars(spark, SF_SMALL).select("symbol", "snapshot_time", "price")

    def build(fr, w):
        return fr.withColumn("c", F.sum("price").over(w.rowsBetween(-5, 5)) + F.lead("price", 6).over(w))
    one = _pdf(with_entity_windows(b, build, lookback=5, lookahead=6), ["symbol", "snapshot_time"])
    many = _pdf(with_entity_windows(b, build, lookback=5, lookahead=6, chunk_rows=4, bucket="hour"),
                ["symbol", "snapshot_time"])
    pd.testing.assert_frame_equal(one, many, check_exact=False, rtol=1e-12)


def test_group_rank_split_equals_window(spark):
    t = tape(spark, SF_SMALL)
    r = group_rank(t, "event_type", "price", name="r1", target_rows=30)
    w = F.rank().over(Window.partitionBy("event_type").orderBy(F.desc_nulls_last("price")))
    bad = r.withColumn("r2", w).filter(~F.col("r1").eqNullSafe(F.col("r2"))).count()
    assert bad == 0


def test_lof_multi_block_equals_single_block(spark):
    p = panel(spark, SF_MID)
    cols = A.ML_COLUMNS
    a = _pdf(lof_scores(p, cols, k_max=3).select("symbol", "snapshot_time", "lof_score"),
             ["symbol", "snapshot_time"])
    b = _pdf(lof_scores(p, cols, k_max=3, block_rows=4).select("symbol", "snapshot_time", "lof_score"),
             ["symbol", "snapshot_time"])
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9)


def test_isolation_forest_properties(spark):
    t = tape(spark, SF_MID).select("symbol", "snapshot_time", "price", "volume_24h")
    extreme = t.limit(1).select(F.lit("U_OUT").alias("symbol"), "snapshot_time",
                                F.lit(1e7).alias("price"), F.lit(1e7).alias("volume_24h"))
    data = t.unionByName(extreme)
    f1 = isolation_forest_flags(data, ["price", "volume_24h"], flag="f")
    share = f1.agg(F.avg(F.col("f").cast("double"))).head()[0]
    assert 0.02 <= share <= 0.04
    assert f1.filter(F.col("symbol") == "U_OUT").head()["f"]
    f2 = isolation_forest_flags(data, ["price", "volume_24h"], flag="f")
    assert f1.join(f2.withColumnRenamed("f", "g"), ["symbol", "snapshot_time"]).filter("f <> g").count() == 0


def test_isolation_forest_split_groups_same_as_whole(spark):
    """Salted buckets grow the same forest, so splitting changes nothing."""
    t = tape(spark, SF_SMALL).select("symbol", "snapshot_time", "price", "volume_24h")
    a = isolation_forest_flags(t, ["price", "volume_24h"], flag="f")
    b = isolation_forest_flags(t, ["price", "volume_24h"], flag="f", rows_per_task=100)
    assert a.join(b.withColumnRenamed("f", "g"), ["symbol", "snapshot_time"]).filter("f <> g").count() == 0


def _yw_pacf(x, nlags):
    x = np.asarray(x, float) - np.mean(x)
    n = len(x)
    acov = np.array([np.dot(x[k:], x[: n - k]) / (n - k) for k in range(nlags + 1)])
    out = [1.0]
    for k in range(1, nlags + 1):
        r = np.array([[acov[abs(i - j)] for j in range(k)] for i in range(k)])
        out.append(np.linalg.solve(r, acov[1: k + 1])[-1])
    return np.array(out)


def test_pacf_matches_yule_walker(spark):
    b = bars(spark, SF_SMALL)
    got = TS.pacf(b, nlags=10).toPandas()
    series = b.toPandas().sort_values(["symbol", "snapshot_time"])
    for sym, g in series.groupby("symbol"):
        ref = _yw_pacf(g["price"].dropna().to_numpy(), 10)
        mine = got[got.symbol == sym].sort_values("lag")["pacf"].to_numpy()
        np.testing.assert_allclose(mine, ref[: len(mine)], rtol=1e-7, atol=1e-9)


def _naive_ward(x, k):
    clusters = [[i] for i in range(len(x))]
    while len(clusters) > k:
        best = None
        for i in range(len(clusters)):
            for j in range(i + 1, len(clusters)):
                a, b = x[clusters[i]], x[clusters[j]]
                cost = len(a) * len(b) / (len(a) + len(b)) * np.sum((a.mean(0) - b.mean(0)) ** 2)
                if best is None or cost < best[0]:
                    best = (cost, i, j)
        _, i, j = best
        clusters[i] = clusters[i] + clusters[j]
        del clusters[j]
    lab = np.empty(len(x), int)
    for c, members in enumerate(clusters):
        lab[members] = c
    return lab


def _same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_ward_matches_naive():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.3, size=(12, 3)) for c in (0, 3, 6, 9)] + [rng.normal(0, 5, size=(8, 3))])
    assert _same_partition(CL.ward_labels(x, 5), _naive_ward(x, 5))
    w = rng.integers(1, 5, size=len(x)).astype(float)
    xr = np.repeat(x, w.astype(int), axis=0)
    lab_w = CL.ward_labels(x, 4, w)
    lab_r = np.repeat(lab_w, w.astype(int))
    assert _same_partition(lab_r, _naive_ward(xr, 4)) or len(set(lab_w)) == 4


def test_kmeans_best_of_n_not_worse(spark):
    p = FE.build_feature_set(panel(spark, SF_MID))
    lt = p.filter(F.col("snapshot_time") == p.agg(F.max("snapshot_time")).head()[0])
    out = CL.cluster_kmeans(lt)
    assert out.select("kmeans_cluster").distinct().count() <= 5
    assert out.filter(F.col("kmeans_cluster").isNull()).count() == 0


def test_pandas_parity_one_symbol(spark):
    """E1-E14 against pandas rolling/ewm/pct_change on one symbol."""
    b = bars(spark, SF_MID).filter(F.col("symbol") == "BTC")
    got = FE.add_return_features(b).toPandas().sort_values("snapshot_time").reset_index(drop=True)
    g = b.toPandas().sort_values("snapshot_time").reset_index(drop=True)
    p = g["price"]
    np.testing.assert_allclose(got["hourly_return"], p.pct_change(2), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["daily_return"], p.pct_change(48), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["rolling_median_12"], p.rolling(12, min_periods=1).median(), rtol=1e-12)
    np.testing.assert_allclose(got["rolling_std_6"], p.rolling(6, min_periods=1).std(), rtol=1e-9, equal_nan=True)
    np.testing.assert_allclose(got["ema_12"], p.ewm(span=12, adjust=False).mean(), rtol=1e-12)
    hr = p.pct_change(2)
    np.testing.assert_allclose(got["volatility"], hr.rolling(12, min_periods=2).std(), rtol=1e-9, equal_nan=True)
    sharpe = (hr.rolling(24, min_periods=2).mean() / hr.rolling(24, min_periods=2).std()).replace(
        [np.inf, -np.inf], np.nan)
    np.testing.assert_allclose(got["sharpe_ratio_simplified"], sharpe, rtol=1e-9, equal_nan=True)
    vel = p.diff() / g["snapshot_time"].diff().dt.total_seconds().replace(0, np.nan)
    np.testing.assert_allclose(got["price_change_velocity"], vel, rtol=1e-12, equal_nan=True)


def test_decompose_small_series_is_empty(spark):
    p = panel(spark, SF_SMALL)  # 79 monthly rows per symbol < 2 x 48
    assert TS.decompose(p).count() == 0


def test_dbscan_finds_clusters(spark):
    p = FE.build_feature_set(panel(spark, SF_MID))
    out = CL.cluster_dbscan(p, group="snapshot_time")
    assert out.filter(F.col("dbscan_cluster") >= 0).count() > 0


def test_schema_contract_rejects_missing_columns(spark):
    from tidemark.sources.payloads import schema_contract
    with pytest.raises(ValueError):
        schema_contract(panel(spark, SF_SMALL).drop("percent_change_7d"))


def _series_df(spark, values_by_symbol, start="2024-01-01"):
    rows = []
    t0 = pd.Timestamp(start)
    for sym, vals in values_by_symbol.items():
        for i, v in enumerate(vals):
            rows.append((sym, t0 + pd.Timedelta(minutes=30 * i), float(v)))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["symbol", "snapshot_time", "price"]))


def test_adf_separates_random_walk_from_noise(spark):
    from tidemark.operators.models import adf_test
    rng = np.random.default_rng(7)
    noise = rng.normal(size=600)
    walk = np.cumsum(rng.normal(size=600)) + 100
    out = adf_test(_series_df(spark, {"NOISE": noise, "WALK": walk})).toPandas().set_index("symbol")
    assert out.loc["NOISE", "p_value"] < 0.01 and out.loc["NOISE", "is_stationary"]
    assert out.loc["WALK", "p_value"] > 0.05 and not out.loc["WALK", "is_stationary"]


def test_arima_recovers_ar1_and_interval_widens(spark):
    from tidemark.operators.models import _hr_fit
    rng = np.random.default_rng(3)
    x = np.zeros(2000)
    for i in range(1, len(x)):
        x[i] = 0.6 * x[i - 1] + rng.normal()
    df = _series_df(spark, {"AR": x})
    fc = _hr_fit(df, "symbol", "snapshot_time", "price", [1], [], 0, 0, 1, 12, lambda m: F.lit(8), 8, "AR1").orderBy("step").toPandas()
    # one-step forecast = 0.6 * last value (approximately)
    assert abs(fc.loc[0, "yhat"] - 0.6 * x[-1]) < 0.1 * max(1.0, abs(x[-1]))
    width = (fc["upper"] - fc["lower"]).to_numpy()
    assert np.all(np.diff(width) >= -1e-9)


def test_hot_symbol_spreads_over_chunks(spark):
    """One symbol with a third of all rows: its history is cut into many
    chunks (so many tasks), and features equal the single-window answer."""
    from tidemark.operators.series import chunked
    rng = np.random.default_rng(11)
    data = {"HOT": 100 + np.cumsum(rng.normal(size=3000))}
    for k in range(6):
        data[f"C{k}"] = 50 + np.cumsum(rng.normal(size=1000))
    df = _series_df(spark, data)
    chunks = chunked(df, chunk_rows=400, lookback=336, bucket="hour").filter("_home")
    per_symbol = {r["symbol"]: r["c"] for r in chunks.groupBy("symbol").agg(
        F.countDistinct("_chunk").alias("c")).collect()}
    assert per_symbol["HOT"] >= 7
    cols = ["symbol", "snapshot_time", "weekly_return", "ema_12", "rolling_median_24"]
    a = _pdf(FE.add_return_features(df, chunk_rows=400, bucket="hour").select(*cols), ["symbol", "snapshot_time"])
    b = _pdf(FE.add_return_features(df).select(*cols), ["symbol", "snapshot_time"])
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)


def test_exact_quantiles_bracket_path_equals_percentile(spark):
    """The scalable path (sketch bracket + sort of the bracket) gives the
    same numbers as Spark's exact percentile."""
    from tidemark.operators.stats import exact_quantiles
    df = tape(spark, SF_MID)
    probs = [0.0, 0.03, 0.25, 0.5, 0.75, 0.97, 1.0]
    for c in ("price", "volume_24h"):
        got = exact_quantiles(df, c, probs, small=100)
        ref = list(df.agg(F.percentile(c, F.array(*[F.lit(p) for p in probs]))).head()[0])
        assert got == ref


def test_grouped_quantiles_bracket_path_equals_percentile(spark):
    """Per-group quantiles through the hot-group path equal percentile."""
    from tidemark.operators.stats import grouped_quantiles
    df = tape(spark, SF_MID)
    probs = [0.25, 0.5, 0.97]
    got = grouped_quantiles(df, "event_type", {"price": probs}, sketch=50, small=10, check_sizes=False)
    ref = df.groupBy("event_type").agg(F.percentile("price", F.array(*[F.lit(p) for p in probs])).alias("r"))
    j = got.join(ref, "event_type")
    bad = j.filter(~(F.col("_q_price_0").eqNullSafe(F.col("r")[0]) & F.col("_q_price_1").eqNullSafe(F.col("r")[1])
                     & F.col("_q_price_2").eqNullSafe(F.col("r")[2])))
    assert bad.count() == 0 and j.count() == 5


def test_quantiles_with_mostly_ties(spark):
    """80 % of the values are one number: quantiles equal percentile, read off counts
    per value (a tie is one row), never off an array of the rows."""
    from tidemark.operators import stats
    df = spark.range(60000).select(F.when(F.col("id") % 5 == 0, F.rand(3)).otherwise(F.lit(0.25)).alias("x"), (F.col("id") % 3).alias("g")).cache()
    probs = [0.1, 0.25, 0.5, 0.9, 0.99]
    pct = F.percentile("x", F.array(*[F.lit(p) for p in probs]))
    assert stats.exact_quantiles(df, "x", probs, small=500) == df.agg(pct).head()[0]
    want = {r.g: list(r.q) for r in df.groupBy("g").agg(pct.alias("q")).collect()}
    got = stats.grouped_quantiles(df, "g", {"x": probs}, sketch=500, small=100)
    assert {r.g: [r[f"_q_x_{i}"] for i in range(5)] for r in got.collect()} == want


def test_selection_with_ties_over_many_distinct_values(spark):
    """60 % of the rows are one value, the rest all distinct, several columns at once."""
    from tidemark.operators import stats
    df = spark.range(400_000).select(
        F.when(F.col("id") % 5 < 3, F.lit(0.5)).otherwise(F.rand(5)).alias("x"), F.when(F.col("id") % 5 < 3, F.lit(0.0)).otherwise(F.randn(6) * 1e9).alias("y"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit(2.0)).alias("z")).cache()
    probs = [0.0, 0.2, 0.5, 0.81, 0.999, 1.0]
    got = stats.quantile_table(df, {c: probs for c in "xyz"}, small=1000)
    want = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in "xyz"]).head()
    out = spark.range(1).select(*[got[c, p].alias(f"{c}{i}") for c in "xyz" for i, p in enumerate(probs)]).head()
    assert list(out) == [v for c in "xyz" for v in want[c]]
