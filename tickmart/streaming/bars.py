"""STR-1: daily OHLC bars over a stream of price points.

Same aggregates as the batch bars (mergeable, so the state store keeps one
partial row per (asset, day)); a 1-day tumbling event-time window with a
watermark; append mode emits a bar once its day can no longer change and
then drops its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.operators.bars import bar_aggregates


def stream_daily_bars(points: DataFrame, lateness: str = "1 day", price_scale: int = 2) -> DataFrame:
    """``points``: streaming canonical price points (``price_ts`` UTC)."""
    # Watermarks need a TIMESTAMP column; the session time zone is UTC.
    timed = points.withColumn("_event_time", F.col("price_ts").cast("timestamp"))
    return (
        timed.withWatermark("_event_time", lateness)
        .groupBy("coin_id", F.window("_event_time", "1 day").alias("w"))
        .agg(*bar_aggregates(price_scale))
        .select("coin_id", F.to_date(F.col("w.start")).alias("coin_date"), "open_price",
                "close_price", "high_price", "low_price", "close_market_cap",
                "close_total_volume", "_ingested_at")
    )
