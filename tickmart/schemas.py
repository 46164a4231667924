"""Schemas of landed payloads, raw tables and the numeric types used downstream."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw API numbers (JSON numbers of any size) land as decimal(38,18):
# 20 integer digits, 18 fractional.
RAW_NUM = T.DecimalType(38, 18)


def money(scale: int = 2) -> T.DecimalType:
    """Type of a rounded price / cap / volume / percent column."""
    return T.DecimalType(18 + scale, scale)


PRICE = money(2)
# Unrounded averages (market summary) keep a fixed scale of 6.
AVG = T.DecimalType(38, 6)
TOTAL = T.DecimalType(38, 2)

_SNAPSHOT_NUMERIC = [
    "current_price", "market_cap", "market_cap_rank", "fully_diluted_valuation",
    "total_volume", "high_24h", "low_24h", "price_change_24h",
    "price_change_percentage_24h", "market_cap_change_24h",
    "market_cap_change_percentage_24h", "circulating_supply", "total_supply",
    "max_supply", "ath", "ath_change_percentage",
]

# Raw snapshot table: payload with roi flattened, typed dates, lineage stamp.
RAW_SNAPSHOT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("id", "symbol", "name", "image")]
    + [T.StructField(c, RAW_NUM) for c in _SNAPSHOT_NUMERIC]
    + [T.StructField("ath_date", T.DateType()),
       T.StructField("atl", RAW_NUM),
       T.StructField("atl_change_percentage", RAW_NUM),
       T.StructField("atl_date", T.DateType()),
       T.StructField("roi_times", RAW_NUM),
       T.StructField("roi_currency", T.StringType()),
       T.StructField("roi_percentage", RAW_NUM),
       T.StructField("last_updated", T.TimestampNTZType()),
       T.StructField("_ingested_at", T.TimestampNTZType()),
       # Fields whose value did not fit: NULL here, the text is among the rejects.
       T.StructField("rejected_fields", T.ArrayType(T.StringType()))]
)

# Three series of [unix_ms, value] pairs.
SERIES = T.ArrayType(T.ArrayType(RAW_NUM))

RAW_SERIES = T.StructType([
    T.StructField("coin_id", T.StringType(), False),
    T.StructField("chart_days", T.IntegerType(), False),
    T.StructField("prices", SERIES, False),
    T.StructField("market_caps", SERIES, False),
    T.StructField("total_volumes", SERIES, False),
    T.StructField("_ingested_at", T.TimestampNTZType(), False),
])

# What a payload held that could not be loaded.
REJECTS = "batch_ts string, table_name string, id string, field string, raw string, reason string, source_file string"

# Coin detail payload used for the category bridge.
CATEGORY_PAYLOAD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
])

RAW_CATEGORIES = T.StructType([
    T.StructField("coin_id", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("_ingested_at", T.TimestampNTZType(), False),
])
