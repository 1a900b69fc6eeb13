"""Isolation forest: rows walk the trees together, the input is worked out once."""

import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import forest


def test_rows_walk_as_one_by_one():
    rng = np.random.default_rng(1)
    trees, size = 5, 15
    f = rng.integers(-1, 3, trees * size)
    f.reshape(trees, size)[:, 7:] = -1                     # the last level holds leaves
    v = rng.integers(0, 9, trees * size).astype(float)
    v[(f >= 0) & (rng.random(trees * size) < 0.1)] = math.nan
    x = rng.integers(0, 9, (2500, 3)).astype(float)
    x[rng.random(x.shape) < 0.1] = math.nan

    def plain(row):
        total = 0.0
        for t in range(trees):
            node = 1
            while f[t * size + node - 1] >= 0:
                a, b = row[f[t * size + node - 1]], v[t * size + node - 1]
                left = a < b or (math.isnan(b) and not math.isnan(a))
                node = 2 * node + (0 if left else 1)
            total += v[t * size + node - 1]
        return total
    assert np.array_equal(forest._paths(x, f, v, trees), [plain(r) for r in x])


def test_input_is_read_once_and_small_groups_go_round(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(v):
        reads.add(1)
        return v
    slow = F.udf(seen, T.DoubleType()).asNondeterministic()
    df = spark.range(66).select(F.concat(F.lit("S"), "id").alias("symbol"), F.when(F.col("id") < 60, 1).when(F.col("id") < 65, 2).alias("g"),
                                slow(F.pmod(F.col("id") * 37, F.lit(61)).cast("double")).alias("x"), F.lit(1.0).alias("y"))
    out = forest.isolation_forest_flags(df, ["x", "y"], group="g", key=["symbol"], min_rows=10).collect()
    assert reads.value == 66 and len(out) == 66
    assert not any(r.is_isolation_forest_anomaly for r in out if r.g != 1) and any(r.is_isolation_forest_anomaly for r in out)


def test_walk_is_no_product_of_partitions(spark):
    df = spark.range(3000).select(F.col("id").alias("ingest_ord"), F.pmod(F.col("id") * 37, F.lit(3001)).cast("double").alias("x"))
    out = forest.isolation_forest_scores(df, ["x"])
    assert out.count() == 3000
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
