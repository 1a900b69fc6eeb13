"""The fixed schemas of the snapshot data model.

Fixed values: the 13-column batch contract, in its order, and the numeric
columns of the stored table, must equal the reference's for the same results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Batch contract columns, in order.
CONTRACT_COLUMNS = [
    "id", "name", "symbol", "cmc_rank", "price", "market_cap", "volume_24h",
    "circulating_supply", "percent_change_1h", "percent_change_24h",
    "percent_change_7d", "last_updated", "snapshot_time",
]

# Numeric columns coerced during cleaning.
NUMERIC_COLUMNS = [
    "price", "market_cap", "volume_24h", "circulating_supply",
    "percent_change_1h", "percent_change_24h", "percent_change_7d",
]

PERCENT_COLUMNS = ["percent_change_1h", "percent_change_24h", "percent_change_7d"]
MEDIAN_FILL_COLUMNS = ["market_cap", "volume_24h", "circulating_supply"]

CONTRACT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("cmc_rank", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("volume_24h", T.DoubleType()),
    T.StructField("circulating_supply", T.DoubleType()),
    T.StructField("percent_change_1h", T.DoubleType()),
    T.StructField("percent_change_24h", T.DoubleType()),
    T.StructField("percent_change_7d", T.DoubleType()),
    T.StructField("last_updated", T.TimestampType()),
    T.StructField("snapshot_time", T.TimestampType()),
])

STORED_SCHEMA = T.StructType(
    [T.StructField("ingest_ord", T.LongType()), T.StructField("coin_id", T.StringType())]
    + [f for f in CONTRACT_SCHEMA.fields if f.name != "id"]
    + [T.StructField("inserted_at", T.TimestampType())]
)

# Nested provider payload: {data: [{..., quote: {CUR: {...}}}]}
QUOTE_STRUCT = T.StructType([
    T.StructField("price", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("volume_24h", T.DoubleType()),
    T.StructField("percent_change_1h", T.DoubleType()),
    T.StructField("percent_change_24h", T.DoubleType()),
    T.StructField("percent_change_7d", T.DoubleType()),
    T.StructField("last_updated", T.StringType()),
])
NESTED_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("cmc_rank", T.IntegerType()),
        T.StructField("circulating_supply", T.DoubleType()),
        T.StructField("quote", T.MapType(T.StringType(), QUOTE_STRUCT)),
    ]))),
])

# Flat provider payload: top-level array with the second provider's names.
FLAT_PAYLOAD_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("market_cap_rank", T.IntegerType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("total_volume", T.DoubleType()),
    T.StructField("circulating_supply", T.DoubleType()),
    T.StructField("price_change_percentage_1h_in_currency", T.DoubleType()),
    T.StructField("price_change_percentage_24h_in_currency", T.DoubleType()),
    T.StructField("price_change_percentage_7d_in_currency", T.DoubleType()),
    T.StructField("last_updated", T.StringType()),
]))
