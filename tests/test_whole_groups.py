"""Small groups are scored whole, rolling medians by the batch: the same numbers as group by group and frame by frame."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import features, forest, lof

COLS = ["a", "b"]


def points(spark, n):
    """Groups of 5, 40 and 300 rows; missing values, and in group 3 a column of nothing else."""
    x = F.pmod(F.hash("id"), F.lit(10007)).cast("double")
    g = F.when(F.col("id") < 5, 1).when(F.col("id") < 45, 2).when(F.col("id") < 85, 3).otherwise(4)
    return spark.range(n).select(F.format_string("S%05d", "id").alias("symbol"), g.alias("g"), F.when(F.col("id") % 7 != 0, x).alias("a"),
                                 F.when(g != 3, x * x % 911).alias("b"))


def test_whole_groups_grow_the_same_trees(spark):
    df = points(spark, 385).where("g < 4").localCheckpoint()
    got = {r.symbol: r._if_path for r in forest.isolation_forest_scores(df, COLS, "g", key=["symbol"], min_rows=10).collect()}
    plain = forest._large(df.where("g > 1"), COLS, "g", 100, 256, 42, 1000, None, ["symbol"], 4096, 10, None).collect()
    assert len(got) == 85 and {k for k, v in got.items() if v is None} == {f"S{i:05d}" for i in range(5)}
    assert {r.symbol: r._if_path for r in plain} == {k: v for k, v in got.items() if v is not None}


def test_whole_groups_have_the_same_neighbours(spark):
    df = points(spark, 385).localCheckpoint()
    got = {r.symbol: r.lof_score for r in lof.lof_scores(df, COLS, "g").collect()}
    plain = {r.symbol: r.lof_score for r in lof._blocked(df, COLS, "g", "symbol", 20, 10, 1024, None).collect()}
    assert {k for k, v in got.items() if v is not None} == set(plain) and len(plain) == 340
    assert all(abs(got[k] - v) <= 1e-12 * v for k, v in plain.items())


def test_a_key_twice_counts_as_before(spark):
    df = points(spark, 45).where("g = 2")
    df = df.union(df.limit(3)).localCheckpoint()
    plain = {r.symbol: r.lof_score for r in lof._blocked(df, COLS, "g", "symbol", 20, 10, 1024, None).collect()}
    got = {r.symbol: r.lof_score for r in lof.lof_scores(df, COLS, "g").collect()}
    assert set(got) == set(plain) and all(abs(got[k] - v) <= 1e-12 * v for k, v in plain.items())


def test_rolling_medians_equal_percentile(spark):
    df = spark.range(400).select((F.col("id") % 7).alias("s"), "id", F.when(F.hash("id") % 5 != 0, F.when(F.col("id") % 91 == 0, F.lit(float("nan")))
                                 .otherwise(F.pmod(F.hash("id"), F.lit(50)) / 3)).alias("p"))
    w = Window.partitionBy("s").orderBy("id")
    df = df.withColumns({f"q{n}": F.percentile("p", F.lit(0.5)).over(w.rowsBetween(1 - n, 0)) for n in (3, 24)})
    df = df.withColumn("m", features.rolling_medians(F.col("p"), w, (3, 24)))
    assert df.where("not (q3 <=> m[0]) or not (q24 <=> m[1])").count() == 0 and df.where("m[0] is null").count() > 0
