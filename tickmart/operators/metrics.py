"""Per-asset daily metrics over bars (W-1, W-2, W-3, J-3).

Lag, the 7-row moving average and the change share one
``partitionBy(coin_id).orderBy(date_stamp)`` window: one exchange, one sort.
A window partition holds one asset's bars (one row per day), so its size is
bounded by the history length, never by the raw point volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.fixed import MOVING_AVERAGE_ROWS
from tickmart.functions import round_to

METRIC_COLUMNS = [
    "coin_id", "name_of_coin", "date_stamp", "open_price", "high_price", "low_price",
    "close_price", "close_market_cap", "close_total_volume", "prev_day_price",
    "daily_price_change_pcg", "moving_avg_7d",
]

def asset_window():
    return Window.partitionBy("coin_id").orderBy("date_stamp")


def change_pct(close: Column, prev: Column, scale: int = 2) -> Column:
    """W-3: no previous row -> 0; previous 0 -> NULL; else rounded % change.

    ``(c - p) * 100 / p`` equals ``(c - p) / p * 100`` exactly and keeps the
    decimal quotient at a scale of 14 instead of 6 before rounding.
    ``when`` is lazy, so the zero guard holds under ANSI division.
    """
    return (F.when(prev.isNull(), F.lit(0))
            .when(prev == 0, F.lit(None))
            .otherwise(F.round((close - prev) * 100 / prev, scale)))


def with_metrics(bars: DataFrame, price_scale: int = 2) -> DataFrame:
    """Add prev_day_price, daily_price_change_pcg and moving_avg_7d.

    ``bars`` has ``coin_id, date_stamp, close_price``; the previous value is the
    previous *row* of the asset (gaps are not filled).
    """
    w = asset_window()
    prev = F.lag("close_price", 1).over(w)
    avg7 = F.avg("close_price").over(w.rowsBetween(-(MOVING_AVERAGE_ROWS - 1), Window.currentRow))
    return (
        bars
        .withColumn("prev_day_price", prev)
        .withColumn("moving_avg_7d", round_to(avg7, price_scale))
        .withColumn(
            "daily_price_change_pcg",
            round_to(F.coalesce(change_pct(F.col("close_price"), F.col("prev_day_price"),
                                           price_scale), F.lit(0)), price_scale),
        )
    )


def daily_metrics(bars: DataFrame, assets: DataFrame, price_scale: int = 2) -> DataFrame:
    """JOB-2: bars ⟕ asset master (name) + window metrics.

    ``assets`` has ``name_id, name_of_coin`` with one row per id (the staged
    snapshot).  Bars without a master row keep ``name_of_coin`` NULL.
    Catalyst picks broadcast vs. shuffle for the master from its size.
    """
    history = bars.select(
        "coin_id", F.col("coin_date").alias("date_stamp"), "open_price", "close_price",
        "high_price", "low_price", "close_market_cap", "close_total_volume",
    )
    named = history.join(
        assets.select(F.col("name_id").alias("coin_id"), "name_of_coin"), "coin_id", "left")
    return with_metrics(named, price_scale).select(*METRIC_COLUMNS)
