"""Tier 2/5: payload decoding, fallback, contract, insert-ignore, sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.fixtures import oracle_cte, panel
from tidemark.operators import reports as R
from tidemark.operators import snapshots as S
from tidemark.plans.registry import query
from tidemark.schema import CONTRACT_COLUMNS
from tidemark.session import checkpoint_dir
from tidemark.sources import payloads as PL
from tidemark.sources import store as ST

P = oracle_cte("panel")
CONTRACT_SQL = ("coin_id AS id, name, symbol, cmc_rank, price, market_cap, volume_24h, circulating_supply, "
                "percent_change_1h, percent_change_24h, percent_change_7d, last_updated, snapshot_time")
LATEST = "(SELECT max(snapshot_time) FROM panel)"


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/sinks/{uuid.uuid4().hex}"


@query("decode_nested_quotes", P + f"SELECT {CONTRACT_SQL} FROM panel")
def q_decode_nested(spark, sf):
    """One JSON payload per snapshot (quotes under 'USD') decoded back to rows."""
    return PL.decode_nested_quotes(PL.encode_nested(panel(spark, sf)))


@query("decode_batch_reject", P + f"SELECT {CONTRACT_SQL} FROM panel WHERE snapshot_time < {LATEST}")
def q_decode_reject(spark, sf):
    """A1: a coin without a symbol rejects its whole batch (the newest snapshot here)."""
    p = panel(spark, sf)
    newest = p.select(F.max("snapshot_time")).head()[0]
    return PL.decode_nested_quotes(PL.encode_nested(p, blank_symbol_at=newest))


@query("decode_flat_quotes", P + f"SELECT {CONTRACT_SQL} FROM panel")
def q_decode_flat(spark, sf):
    """A2: the flat provider's array, field names mapped, symbol upper-cased."""
    return PL.decode_flat_quotes(PL.encode_flat(panel(spark, sf)))


@query("provider_fallback", P + f"""
, r AS (SELECT *, dense_rank() OVER (ORDER BY snapshot_time) AS sr FROM panel)
SELECT {CONTRACT_SQL}, CASE WHEN sr % 3 = 0 THEN 'secondary' ELSE 'primary' END AS provider FROM r""")
def q_fallback(spark, sf):
    """A3: primary payloads miss every third snapshot; those come from the secondary."""
    p = panel(spark, sf)
    times = S.time_rank(p, descending=False, name="_sr")  # one row per snapshot
    prim_p = p.join(times.filter(F.col("_sr") % 3 != 0).select("snapshot_time"), "snapshot_time", "left_semi")
    primary = PL.decode_nested_quotes(PL.encode_nested(prim_p)).withColumn("provider", F.lit("primary"))
    secondary = PL.decode_flat_quotes(PL.encode_flat(p)).withColumn("provider", F.lit("secondary"))
    return PL.provider_fallback(primary, secondary)


@query("schema_contract", P + f"SELECT {CONTRACT_SQL} FROM panel")
def q_contract(spark, sf):
    """Text-typed batch → typed 13-column contract, in order."""
    p = panel(spark, sf).withColumnRenamed("coin_id", "id")
    as_text = p.select(*[F.col(c).cast("string").alias(c) if c not in ("name", "symbol") else F.col(c)
                         for c in p.columns])
    return PL.schema_contract(as_text)


@query("stamp_snapshot", P + "SELECT coin_id, TIMESTAMP '2024-01-01 00:00:00' AS snapshot_time FROM panel "
       f"WHERE snapshot_time = {LATEST}")
def q_stamp(spark, sf):
    """A5: one capture time for a whole batch (pinned here; current_timestamp() live)."""
    lt = S.latest_snapshot(panel(spark, sf)).select("coin_id")
    return PL.stamp_snapshot(lt, at="2024-01-01 00:00:00")


@query("anti_join_new_rows", P + """
SELECT coin_id, snapshot_time, price FROM panel b WHERE snapshot_time >= TIMESTAMP '1999-10-01 00:00:00'
AND NOT EXISTS (SELECT 1 FROM panel s WHERE s.snapshot_time < TIMESTAMP '2000-01-01 00:00:00'
                AND s.coin_id = b.coin_id AND s.snapshot_time = b.snapshot_time)""")
def q_anti_join(spark, sf):
    """Batch rows whose (coin_id, snapshot_time) is not stored yet."""
    p = panel(spark, sf).select("coin_id", "snapshot_time", "price")
    stored = p.filter(F.col("snapshot_time") < F.lit("2000-01-01 00:00:00").cast("timestamp"))
    batch = p.filter(F.col("snapshot_time") >= F.lit("1999-10-01 00:00:00").cast("timestamp"))
    return ST.new_rows(batch, stored)


@query("upsert_ignore", P + "SELECT coin_id, snapshot_time, symbol, price FROM panel")
def q_upsert(spark, sf):
    """Store the old part, then insert-ignore an overlapping batch; read the store back."""
    p = panel(spark, sf)
    contract = p.withColumnRenamed("coin_id", "id").select(*CONTRACT_COLUMNS)
    path = _scratch(spark)
    ST.upsert_ignore(contract.filter(F.col("snapshot_time") < F.lit("2000-01-01").cast("timestamp")), path)
    ST.upsert_ignore(contract.filter(F.col("snapshot_time") >= F.lit("1999-10-01").cast("timestamp")), path)
    return ST.scan_store(spark, path).select("coin_id", "snapshot_time", "symbol", "price")


@query("csv_append_sink", P + f"""
SELECT symbol, snapshot_time, price FROM panel WHERE snapshot_time >= (
  SELECT DISTINCT snapshot_time FROM panel ORDER BY snapshot_time DESC LIMIT 1 OFFSET 1)""")
def q_csv_append(spark, sf):
    """A10: two appends to one CSV folder read back as one table."""
    p = panel(spark, sf).select("symbol", "snapshot_time", "price")
    two = S.last_two_times(p)
    path = _scratch(spark)
    for rank in (2, 1):
        one = two.filter(F.col("snap_rank") == rank).select("snapshot_time")
        ST.csv_append(p.join(F.broadcast(one), "snapshot_time", "left_semi").select(*p.columns), path)
    return ST.read_csv(spark, path, p.schema)


@query("csv_overwrite_sink", P + f"SELECT symbol, snapshot_time, price FROM panel WHERE snapshot_time = {LATEST}")
def q_csv_overwrite(spark, sf):
    """The history written, then replaced by the latest snapshot."""
    p = panel(spark, sf).select("symbol", "snapshot_time", "price")
    path = _scratch(spark)
    ST.csv_overwrite(p, path)
    ST.csv_overwrite(S.latest_snapshot(p), path)
    return ST.read_csv(spark, path, p.schema)


@query("report_tables", P + f"""
SELECT symbol, name, price, percent_change_24h, snapshot_time FROM panel WHERE snapshot_time = {LATEST}
ORDER BY percent_change_24h DESC NULLS LAST, symbol LIMIT 20""")
def q_report_tables(spark, sf):
    """Workbook sheets written as folders (naive UTC times); 'top_gainers' read back."""
    lt = S.latest_snapshot(panel(spark, sf)).select("symbol", "name", "price", "percent_change_24h", "snapshot_time")
    paths = ST.write_report_tables(R.top_n_tables(lt), _scratch(spark))
    return spark.read.parquet(paths["top_gainers"])


@query("strip_timezone", P + "SELECT symbol, snapshot_time, last_updated FROM panel")
def q_strip_tz(spark, sf):
    """Session-zone timestamps → naive UTC."""
    out = ST.strip_timezone(panel(spark, sf).select("symbol", "snapshot_time", "last_updated"))
    assert dict(out.dtypes)["snapshot_time"] == "timestamp_ntz"
    return out
