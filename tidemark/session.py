"""Session set-up shared by tests, bench and the entry module.

The settings that change results are fixed here: UTC session time zone (the
oracle compares naive UTC timestamps) and ANSI mode left on (so every ratio in
the library goes through ``try_divide``). The rest are scale settings: AQE with
partition coalescing and skew-join splitting, so a hot symbol or a hot snapshot
is split at run time instead of landing in one task.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.pythonUDF.arrow.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster, ``master`` is left to spark-submit and the cluster's own
    ``spark.checkpoint.dir`` is kept; locally a scratch checkpoint folder is set
    only when none is configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
        active = SparkSession.getActiveSession()
        has_dir = active is not None and active.sparkContext.getConf().get("spark.checkpoint.dir")
        if not has_dir and "spark.checkpoint.dir" not in (extra or {}):
            conf["spark.checkpoint.dir"] = tempfile.mkdtemp(
                prefix="tidemark-ckpt-", dir=os.environ.get("TIDEMARK_SCRATCH", "/tmp"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's active checkpoint folder, setting it once.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; the
    library never falls back to a machine-local one there. A local-mode
    session without the setting (tests, the driver's smoke check) gets a fresh
    scratch folder. Spark adds its own sub-folder when the folder is set, so
    it is set only when none is active."""
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for the cluster")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TIDEMARK_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
