"""Daily rankings (W-5, W-6, FLT-4, FLT-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickmart.sinks.tables import stage


# Rows of one date (some 50 MB) that one task sorts without ado.
PLAIN_ROWS = 1_000_000


def daily_ranks(metrics: DataFrame, descending: bool, rank_col: str,
                value: str = "daily_price_change_pcg", top: int | None = None,
                assets: int | None = None) -> DataFrame:
    """``row_number()`` per date by ``value`` (NULL rows dropped first), ties
    broken by ``coin_id``.

    No task holds a whole date: the rows are range-partitioned in rank order,
    numbered within each (date, part), and moved up by the date's rows in the
    parts before.  A date has a row an asset, so with at most ``PLAIN_ROWS``
    ``assets`` (their number, if the caller knows it) a date is small enough for one
    window partition and one shuffle does.  With ``top``, Catalyst inserts a partial ``WindowGroupLimit``
    before the shuffle instead, so only ``top`` rows per date and map task cross
    the network.
    """
    v = F.col(value)
    order = (v.desc_nulls_first() if descending else v.asc_nulls_last(), F.col("coin_id").asc())
    rows = metrics.where(v.isNotNull()).select("coin_id", "date_stamp", value)
    if top or assets is not None and assets <= PLAIN_ROWS:
        w = Window.partitionBy("date_stamp").orderBy(*order)
        ranked = rows.withColumn(rank_col, F.row_number().over(w))
        if top:
            ranked = ranked.where(F.col(rank_col) <= top)  # filter on the rank itself
    else:
        # Staged, so that the parts stay as they are whatever is computed again.
        parts = stage(rows.repartitionByRange(F.col("date_stamp").asc(), *order)
                      .withColumn("_part", F.spark_partition_id()), "rank-parts")
        before = (Window.partitionBy("_date").orderBy("_in")
                  .rowsBetween(Window.unboundedPreceding, -1))
        sizes = (parts.groupBy(F.col("date_stamp").alias("_date"), F.col("_part").alias("_in"))
                 .agg(F.count(F.lit(1)).alias("_n"))
                 .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
        inside = Window.partitionBy("date_stamp", "_part").orderBy(*order)
        ranked = (parts.withColumn("_place", F.row_number().over(inside))
                  .join(sizes, F.col("date_stamp").eqNullSafe(F.col("_date")) & (F.col("_part") == F.col("_in")))
                  .select("coin_id", "date_stamp", value, (F.col("_before") + F.col("_place")).alias(rank_col)))
    return ranked.withColumn(rank_col, F.col(rank_col).cast("long"))
