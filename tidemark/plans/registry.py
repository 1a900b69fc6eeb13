"""Registry of check queries: a Spark plan and, where one exists, equivalent
DuckDB SQL over the same parquet tables.

Every registered query reads the driver's tables through a fixture, so its
work grows with them. Timestamps are emitted as timestamp_ntz (naive UTC), the
type DuckDB reports for the same column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.exprs import to_ntz

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CHECKS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}     # as written, without the session's settings


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # results are defined on UTC wall-clock time (as the oracle reads them)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            _local_partitions(spark)
            return to_ntz(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        CHECKS[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _local_partitions(spark: SparkSession) -> None:
    """A local-mode session left at Spark's default of 200 shuffle partitions
    gets two per core instead; cluster sessions keep their own setting."""
    sc = spark.sparkContext
    if sc.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(max(2, sc.defaultParallelism * 2)))


def load_all() -> None:
    """Import every module that registers queries."""
    from tidemark.plans import (q_library, q_cleaning, q_features, q_anomaly,  # noqa: F401
                                q_reports, q_sources, q_timeseries, q_cluster, q_streams,
                                q_charts)
    from tidemark.plans import q_wide  # noqa: F401  (stands on the others)


def alias(new: str, existing: str) -> None:
    """Register an existing check under the inventory's name for the operator."""
    if new in QUERIES:
        raise ValueError(f"duplicate query {new}")
    QUERIES[new] = QUERIES[existing]
    if existing in ORACLES:
        ORACLES[new] = ORACLES[existing]
