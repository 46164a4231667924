"""Mart and intermediate models (JOB-2..JOB-6) as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.fixed import FACT_COLUMNS
from tickmart.operators.bars import first_seen
from tickmart.operators.metrics import daily_metrics  # noqa: F401  (re-export)
from tickmart.schemas import AVG, TOTAL


def daily_fact(metrics: DataFrame) -> DataFrame:
    """JOB-5 / PRJ-5: the daily fact is a renaming projection of the metrics."""
    return metrics.select(*[F.col(src).alias(dst) for src, dst in FACT_COLUMNS.items()])


def category_metrics(categories: DataFrame, metrics: DataFrame, how: str = "left") -> DataFrame:
    """JOB-3 / J-4: category bridge ⟕ daily metrics.

    One row per (asset, category, day); an asset without history keeps one
    row with NULL metrics (not with ``how="inner"``).  Both sides are keyed by
    asset; an asset's metrics are one row per day, so even a hot asset joins a
    bounded row set.
    """
    cats = categories.select(
        "coin_id", "category", F.col("_ingested_at").alias("category_ingested_at"))
    m = metrics.select("coin_id", "name_of_coin", "prev_day_price",
                       "daily_price_change_pcg", "moving_avg_7d", "date_stamp")
    return cats.join(m, "coin_id", how).select(
        "coin_id", "category", "name_of_coin", "prev_day_price", "daily_price_change_pcg",
        "moving_avg_7d", "category_ingested_at", "date_stamp")


def asset_dimension(categories: DataFrame, assets: DataFrame, bars: DataFrame) -> DataFrame:
    """JOB-4: one row per (asset, category) with name, symbol, first-seen date.

    The source fans out asset x category x day and keeps ``rn = 1``; name and
    symbol are constant per asset, so reducing to distinct (asset, category)
    first gives the same rows without the blow-up.  The name comes through the
    metrics, so it is NULL for an asset without history.
    """
    # Partition by asset once: the dedupe (clustered on asset, category) and
    # both asset joins then reuse this partitioning instead of reshuffling.
    pairs = (categories.select("coin_id", "category").repartition("coin_id")
             .dropDuplicates(["coin_id", "category"]))
    master = assets.select(F.col("name_id").alias("coin_id"), "name_of_coin",
                           F.col("symbol_name").alias("symbol"))
    seen = first_seen(bars)
    return (
        pairs.join(master, "coin_id", "left")
        .join(seen, "coin_id", "left")
        .select(
            "coin_id",
            F.when(F.col("first_seen_date").isNotNull(), F.col("name_of_coin")).alias("coin_name"),
            "symbol", "category", "first_seen_date",
        )
    )


def market_summary(metrics: DataFrame) -> DataFrame:
    """JOB-6 / A-6 / A-9: one ``groupBy(date)`` instead of two rankings + joins.

    Gainer = largest change, loser = smallest; ties go to the smallest id.
    Rows with a NULL change are skipped by both (``min_by`` ignores NULL
    orderings), so a day with only NULL changes keeps NULL winners.
    Every aggregate is partial-aggregated before the shuffle by date.  The
    (change, id) struct keys make Spark sort each map partition by date; a
    hash-only form (per-date extremes, then a broadcast pass for the winners)
    would read the metrics two or three times instead of once.
    """
    pct = F.col("daily_price_change_pcg")
    has_pct = pct.isNotNull()
    gain_key = F.when(has_pct, F.struct((-pct).alias("neg_pct"), F.col("coin_id")))
    loss_key = F.when(has_pct, F.struct(pct.alias("pct"), F.col("coin_id")))
    return metrics.groupBy("date_stamp").agg(
        F.sum("close_market_cap").cast(TOTAL).alias("total_market_cap"),
        F.min_by("coin_id", gain_key).alias("top_gainer"),
        F.min_by("coin_id", loss_key).alias("top_loser"),
        F.avg("close_total_volume").cast(AVG).alias("average_volume"),
    )
