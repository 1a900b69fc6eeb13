"""Provider payloads → the 13-column batch contract (A1-A5).

Landing JSON files replace the reference's HTTP client: one text per fetch
(a batch), read with ``spark.read.text``/``readStream.text`` or any string
column. Decoding is ``from_json`` with a fixed schema + ``explode`` — all
JVM-side, one pass, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import CONTRACT_COLUMNS, CONTRACT_SCHEMA, FLAT_PAYLOAD_SCHEMA, NESTED_PAYLOAD_SCHEMA

# Flat-provider field names → contract names.
FLAT_FIELDS = {
    "market_cap_rank": "cmc_rank", "current_price": "price", "market_cap": "market_cap",
    "total_volume": "volume_24h", "circulating_supply": "circulating_supply",
    "price_change_percentage_1h_in_currency": "percent_change_1h",
    "price_change_percentage_24h_in_currency": "percent_change_24h",
    "price_change_percentage_7d_in_currency": "percent_change_7d",
}


def _ts(c: Column) -> Column:
    return F.try_to_timestamp(c)


def decode_nested_quotes(df: DataFrame, payload: str = "payload", convert: str = "USD",
                         snapshot: str = "snapshot_time") -> DataFrame:
    """``{data: [{id, name, symbol, cmc_rank, circulating_supply, quote: {CUR: {...}}}]}``
    → contract rows (A1). A batch (one payload) in which any coin lacks id,
    name, symbol or the ``convert`` quote is rejected whole, as a missing key
    fails the reference's whole fetch. Optional fields become NULL."""
    parsed = df.withColumn("_p", F.from_json(F.col(payload), NESTED_PAYLOAD_SCHEMA))
    bad = F.exists(F.coalesce(F.col("_p.data"), F.array()),
                   lambda c: c["id"].isNull() | c["name"].isNull() | c["symbol"].isNull()
                   | c["quote"][convert].isNull())
    ok = parsed.filter(F.col("_p.data").isNotNull() & ~bad)
    rows = ok.select(F.col(snapshot), F.explode("_p.data").alias("c"))
    q = F.col("c.quote")[convert]
    return rows.select(
        F.col("c.id").alias("id"), F.col("c.name").alias("name"), F.col("c.symbol").alias("symbol"),
        F.col("c.cmc_rank").alias("cmc_rank"), q["price"].alias("price"), q["market_cap"].alias("market_cap"),
        q["volume_24h"].alias("volume_24h"), F.col("c.circulating_supply").alias("circulating_supply"),
        q["percent_change_1h"].alias("percent_change_1h"), q["percent_change_24h"].alias("percent_change_24h"),
        q["percent_change_7d"].alias("percent_change_7d"), _ts(q["last_updated"]).alias("last_updated"),
        F.col(snapshot).alias("snapshot_time"))


def decode_flat_quotes(df: DataFrame, payload: str = "payload", snapshot: str = "snapshot_time") -> DataFrame:
    """Top-level array with the second provider's field names → contract rows
    (A2); symbol upper-cased; a coin without id, name or symbol rejects its batch."""
    parsed = df.withColumn("_p", F.from_json(F.col(payload), FLAT_PAYLOAD_SCHEMA))
    bad = F.exists(F.coalesce(F.col("_p"), F.array()),
                   lambda c: c["id"].isNull() | c["name"].isNull() | c["symbol"].isNull())
    rows = parsed.filter(F.col("_p").isNotNull() & ~bad).select(F.col(snapshot), F.explode("_p").alias("c"))
    cols = [F.col("c.id").alias("id"), F.col("c.name").alias("name"), F.upper("c.symbol").alias("symbol")]
    cols += [F.col(f"c.{src}").alias(dst) for src, dst in FLAT_FIELDS.items()]
    cols += [_ts(F.col("c.last_updated")).alias("last_updated"), F.col(snapshot).alias("snapshot_time")]
    return rows.select(*cols).select(*CONTRACT_COLUMNS)


def provider_fallback(primary: DataFrame, secondary: DataFrame, batch: str = "snapshot_time") -> DataFrame:
    """Per batch: the primary's rows, else the secondary's, else nothing (A3).
    The batch keys of the primary (one row per batch) are anti-joined."""
    have = primary.select(batch).distinct()
    return primary.unionByName(secondary.join(have, batch, "left_anti"))


def schema_contract(df: DataFrame, contract: T.StructType = CONTRACT_SCHEMA) -> DataFrame:
    """The contract's fields, in its order and types (A4). A field that the frame
    lacks is an error at plan time; a value that does not convert, or NaN, is NULL."""
    lacking = [f.name for f in contract if f.name not in df.columns]
    if lacking:
        raise ValueError("batch does not meet the contract; no column " + ", ".join(lacking))
    return df.select(*[_as_field(F.col(f.name), dict(df.dtypes)[f.name], f) for f in contract])


def _as_field(v, given: str, field: T.StructField):
    text = given == "string"
    if isinstance(field.dataType, T.TimestampType):
        out = _ts(v) if text else v.cast(field.dataType)
    elif isinstance(field.dataType, T.StringType):
        out = F.regexp_replace(v.cast("string"), r"^\s+|\s+$", "") if field.name == "id" else v
    else:
        out = v.try_cast(field.dataType) if text else v.cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            out = F.when(~F.isnan(out), out)
    return out.alias(field.name)


def stamp_snapshot(df: DataFrame, at=None, col: str = "snapshot_time") -> DataFrame:
    """One capture time per batch (A5): ``current_timestamp()`` is fixed for a
    whole query (and per micro-batch in a stream); pass ``at`` to pin it."""
    v = F.current_timestamp() if at is None else F.lit(at).cast(T.TimestampType())
    return df.withColumn(col, v)


# --------------------------------------------------------------------------- fixtures for A1-A3
def encode_nested(panel: DataFrame, convert: str = "USD", blank_symbol_at=None) -> DataFrame:
    """Payload texts built from a panel (one per snapshot), for tests and checks.
    ``blank_symbol_at``: a snapshot time whose first coin loses its symbol."""
    sym = F.col("symbol")
    if blank_symbol_at is not None:
        first = (F.col("snapshot_time") == F.lit(blank_symbol_at).cast("timestamp")) & (F.col("cmc_rank") == 1)
        sym = F.when(first, F.lit(None).cast("string")).otherwise(sym)
    coin = F.struct(F.col("coin_id").alias("id"), "name", sym.alias("symbol"), "cmc_rank", "circulating_supply",
                    F.create_map(F.lit(convert), F.struct(
                        "price", "market_cap", "volume_24h", "percent_change_1h", "percent_change_24h",
                        "percent_change_7d", F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss'Z'")
                        .alias("last_updated"))).alias("quote"))
    return panel.groupBy("snapshot_time").agg(
        F.to_json(F.struct(F.collect_list(coin).alias("data"))).alias("payload"))


def encode_flat(panel: DataFrame) -> DataFrame:
    coin = F.struct(F.col("coin_id").alias("id"), "name", F.lower("symbol").alias("symbol"),
                    *[F.col(dst).alias(src) for src, dst in FLAT_FIELDS.items()],
                    F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_updated"))
    return panel.groupBy("snapshot_time").agg(F.to_json(F.collect_list(coin)).alias("payload"))
