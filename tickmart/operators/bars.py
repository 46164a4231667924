"""Daily OHLC bars from price points (A-1, A-2, A-3, TOP-1, PRJ-6).

Input: one row per price point with columns

    coin_id, price_ts (timestamp_ntz, UTC), point_order (decimal(38,0) total
    order within an asset), price, market_cap, total_volume, _ingested_at

Output: one row per (coin_id, coin_date).  Open/close are the price at the
earliest/latest point of the UTC day (``min_by``/``max_by`` keep a NULL value
at the extreme, as an ordered ``array_agg(...)[1]`` does); high/low ignore
NULLs.  Every aggregate is mergeable, so Spark combines map-side and shuffles
at most one partial row per (asset, day, map task): a hot asset is reduced
before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tickmart.functions import round_to

BAR_COLUMNS = [
    "coin_id", "coin_date", "open_price", "close_price", "high_price", "low_price",
    "close_market_cap", "close_total_volume", "_ingested_at",
]


def closing(price_scale: int = 2) -> list[Column]:
    """A-2 + A-3: sibling series at the day's last point, latest ingest."""
    order = F.col("point_order")
    return [round_to(F.max_by("market_cap", order), price_scale).alias("close_market_cap"),
            round_to(F.max_by("total_volume", order), price_scale).alias("close_total_volume"),
            F.max("_ingested_at").alias("_ingested_at")]


def bar_aggregates(price_scale: int = 2) -> list[Column]:
    """The aggregates of a bar, in batch and in a stream."""
    order = F.col("point_order")
    return [round_to(F.min_by("price", order), price_scale).alias("open_price"),
            round_to(F.max_by("price", order), price_scale).alias("close_price"),
            round_to(F.max("price"), price_scale).alias("high_price"),
            round_to(F.min("price"), price_scale).alias("low_price"),
            *closing(price_scale)]


def _by_day(points: DataFrame) -> GroupedData:
    return points.groupBy("coin_id", F.to_date("price_ts").alias("coin_date"))


def daily_bars(points: DataFrame, price_scale: int = 2) -> DataFrame:
    return _by_day(points).agg(*bar_aggregates(price_scale))


def close_of_day(points: DataFrame, price_scale: int = 2) -> DataFrame:
    """A-2 + A-3 alone."""
    return _by_day(points).agg(*closing(price_scale))


def first_seen(bars: DataFrame) -> DataFrame:
    """A-5: first bar date per asset."""
    return bars.groupBy("coin_id").agg(F.min("coin_date").alias("first_seen_date"))


def high_water(bars: DataFrame) -> DataFrame:
    """A-4: latest contributing ingest time per asset."""
    return bars.groupBy("coin_id").agg(F.max("_ingested_at").alias("max_ingested_at"))
