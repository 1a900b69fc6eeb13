"""The snapshot store and its sinks.

The store is a parquet table partitioned by capture date, so time filters
prune files. ``(coin_id, snapshot_time)`` is the natural key: parquet has no
unique constraint, so inserts anti-join the batch against the stored keys of
the batch's own dates only (partition pruning keeps that read small).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import to_ntz


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def keep_first(batch: DataFrame, keys=("coin_id", "snapshot_time"), order: str = "_batch_ord") -> DataFrame:
    """First row per key within a batch (insert order wins): ``min_by`` per key,
    combined map-side."""
    cols = batch.columns
    return (batch.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r"))
            .select("_r.*").select(*cols))


def new_rows(batch: DataFrame, stored: DataFrame | None, keys=("coin_id", "snapshot_time")) -> DataFrame:
    """Batch rows whose key is not stored yet (C6: ON CONFLICT DO NOTHING)."""
    if stored is None:
        return batch
    return batch.join(stored.select(*keys), list(keys), "left_anti")


MARK = "_max_ingest_ord"        # side table: one row per write, next to the store


def _mark_path(path: str) -> str:
    return f"{path.rstrip('/')}{MARK}"


def upsert_ignore(batch: DataFrame, path: str, order: str | None = None) -> int:
    """Insert a contract batch into the store at ``path``; skip keys already
    stored and later copies within the batch; return the number inserted (A6).

    Of copies within the batch the first by the column ``order`` wins; without one, by
    the row's own values, so the result does not depend on how the batch is
    partitioned. ``id`` is renamed ``coin_id``; ``ingest_ord`` is the write's number (kept
    in a side table, so the store is not scanned for it) above the row's place in the batch's
    order; it only grows from write to write and is the "table order" that keep-last cleaning
    relies on. ``inserted_at`` is the write's timestamp."""
    spark = batch.sparkSession
    b = batch.withColumnsRenamed({"id": "coin_id"}) if "id" in batch.columns else batch
    rest = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(b.columns)]
    b = b.withColumn("_batch_ord", F.struct(*([F.col(order)] if order else []), *rest))
    b = keep_first(b)
    stored, writes = None, 0
    if _exists(spark, path):
        # only the batch's own dates: a semi join on the partition column, so
        # dynamic partition pruning skips every other date's files
        days = b.select(F.to_date("snapshot_time").alias("capture_date")).distinct()
        stored = spark.read.parquet(path).join(days, "capture_date", "left_semi")
        if _exists(spark, _mark_path(path)):
            writes = spark.read.parquet(_mark_path(path)).agg(F.max("writes")).head()[0] or 0
        else:       # a store written before the side table was kept
            writes = (spark.read.parquet(path).agg(F.max("ingest_ord")).head()[0] or 0) // _ORD_STEP + 1
    from tidemark.operators.series import materialize
    fresh = new_rows(b, stored)
    # the row's place in the write: ranges of the batch's order, numbered inside each
    # range above the rows of the ranges before it
    fresh = materialize(fresh.repartitionByRange("_batch_ord").withColumn("_part", F.spark_partition_id()))
    sizes = fresh.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))      # a row per partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_batch_ord")) - 1 + F.col("_before")
    fresh = fresh.join(sizes.select("_part", before.alias("_before")), "_part")
    fresh = (fresh.withColumn("ingest_ord", F.lit((writes + 1) * _ORD_STEP) + place).drop("_batch_ord", "_part", "_before")
             .withColumn("inserted_at", F.current_timestamp())
             .withColumn("capture_date", F.to_date("snapshot_time")))
    fresh = materialize(fresh)
    n = fresh.count()
    if n:
        fresh.write.mode("append").partitionBy("capture_date").parquet(path)
        spark.range(1).select(F.lit(writes + 1).cast("long").alias("writes")).write.mode("append").parquet(_mark_path(path))
    return n


_ORD_STEP = 1 << 40


def run_cycle(raw: DataFrame, store_path: str, backup_path: str, processed_path: str | None = None,
              order: str | None = None) -> DataFrame:
    """M3: one whole cycle on a fetched contract batch: store (insert-ignore), back the batch up
    as CSV, clean the stored history, build features, flag anomalies, and return the one-row
    run summary. With ``processed_path`` the processed history and the latest snapshot are
    written there."""
    from tidemark.operators.anomaly import run_anomaly_pipeline
    from tidemark.operators.cleaning import clean_pipeline
    from tidemark.operators.features import build_feature_set
    from tidemark.operators.reports import run_summary
    from tidemark.operators.snapshots import latest_snapshot
    inserted = upsert_ignore(raw, store_path, order)
    csv_append(raw, backup_path)
    history = scan_store(raw.sparkSession, store_path).drop("capture_date", "inserted_at")
    final = run_anomaly_pipeline(build_feature_set(clean_pipeline(history)))
    if processed_path:
        csv_overwrite(final, f"{processed_path}/history")
        csv_overwrite(latest_snapshot(final), f"{processed_path}/latest")
    return run_summary(history, final, inserted)


def scan_store(spark: SparkSession, path: str) -> DataFrame:
    """The whole stored history."""
    return spark.read.parquet(path)


def csv_append(df: DataFrame, path: str) -> None:
    """Append rows as CSV with a header (A10). Spark writes one header per
    part file, so any number of appends reads back with ``header=True``."""
    df.write.mode("append").option("header", True).csv(path)


def csv_overwrite(df: DataFrame, path: str) -> None:
    """Processed history / latest snapshot as CSV, replacing the folder."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_report_tables(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Each named table in its own folder (A12); timestamps made naive UTC
    first (A13), as a workbook needs."""
    out = {}
    for name, df in tables.items():
        p = f"{base.rstrip('/')}/{name}"
        to_ntz(df).write.mode("overwrite").format(fmt).option("header", True).save(p)
        out[name] = p
    return out


def strip_timezone(df: DataFrame) -> DataFrame:
    """tz-aware → naive UTC timestamps."""
    return to_ntz(df)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower=None, upper=None, num_partitions: int = 8) -> DataFrame:
    """The same table from any JDBC database (A14). With ``partition_column``
    the read is split into ``num_partitions`` ranges, so it is not one task."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "append", batch_size: int = 10_000) -> None:
    """Bulk append over JDBC (A14), batched rather than one statement per row."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
