"""Edge cases pinned by the survey: single-row symbol, zero price, constant
volume, tied prices, a single snapshot."""

import math

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import anomaly, features


def _frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["symbol", "snapshot_time", "price", "volume_24h", "market_cap",
                                      "percent_change_24h"])
    pdf["snapshot_time"] = pd.to_datetime(pdf["snapshot_time"])
    return spark.createDataFrame(pdf)


def test_edge_cases(spark):
    t = ["2024-01-01 00:00", "2024-01-01 00:30", "2024-01-01 01:00"]
    rows = [
        ("ONE", t[0], 5.0, 10.0, 100.0, 1.0),                     # single-row symbol
        ("ZERO", t[0], 0.0, 10.0, 100.0, 1.0), ("ZERO", t[1], 2.0, 10.0, 100.0, 1.0),
        ("ZERO", t[2], 2.0, 10.0, 100.0, 1.0),                     # zero base, constant volume
        ("TIE", t[0], 2.0, 5.0, 50.0, 3.0), ("TIE", t[1], 2.0, 6.0, 60.0, 3.0), ("TIE", t[2], 1.0, 7.0, 70.0, 3.0),
    ]
    df = _frame(spark, rows)
    f = features.add_return_features(df).toPandas().set_index(["symbol", "snapshot_time"]).sort_index()
    one = f.loc["ONE"].iloc[0]
    assert math.isnan(one["rolling_std_3"]) and one["ema_12"] == 5.0 and math.isnan(one["price_momentum"])
    zero = f.loc["ZERO"]
    assert zero.iloc[1]["volume_growth"] == 0.0
    a = anomaly.step_flags(df).toPandas().set_index(["symbol", "snapshot_time"]).sort_index()
    assert bool(a.loc["ZERO"].iloc[1]["is_price_spike"])          # 0 -> 2 is +inf
    assert not bool(a.loc["ZERO"].iloc[2]["is_price_spike"])
    z = anomaly.volume_spike(df).toPandas()
    assert (z[z.symbol == "ZERO"]["volume_zscore"] == 0.0).all()  # constant volume -> 0
    ms = features.add_market_structure(df).toPandas()
    first = ms[pd.to_datetime(ms.snapshot_time) == pd.Timestamp(t[0])].set_index("symbol")
    assert first.loc["ZERO", "price_rank"] == 3.0 and first.loc["TIE", "price_rank"] == 2.0
    second = ms[pd.to_datetime(ms.snapshot_time) == pd.Timestamp(t[1])].set_index("symbol")
    assert second.loc["ZERO", "price_rank"] == 1.0 and second.loc["TIE", "price_rank"] == 1.0  # tie -> min rank
    # no BTC in any snapshot: relative strength uses the snapshot median
    assert first.loc["TIE", "relative_strength_vs_btc"] == 3.0 - 1.0


def test_single_snapshot_cross_section(spark):
    rows = [(f"S{i}", "2024-01-01 00:00", float(i + 1), 1.0, float(10 * (i + 1)), float(i)) for i in range(4)]
    ms = features.add_market_structure(_frame(spark, rows)).toPandas().set_index("symbol")
    assert abs(ms["market_dominance"].sum() - 1.0) < 1e-12
    assert list(ms.sort_values("price")["price_rank"]) == [4.0, 3.0, 2.0, 1.0]
