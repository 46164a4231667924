"""Asset state: what an increment needs to know of an asset's history.

One small row an asset (bucketed by it): the newest ingest time of its bars, and its
last ``TAIL_ROWS`` bars as (date, close).  The lag and the 7-row average of new bars
go on from the tail, the high-water mark says which raw rows are new; the bars table
is not read for either.  Only a change further back than the tail reaches reads old
bars, those of the assets it concerns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.fixed import MOVING_AVERAGE_ROWS
from tickmart.operators.joins import small_side
from tickmart.operators.metrics import METRIC_COLUMNS, daily_metrics
from tickmart.sinks.partitioned import (
    Months, create_buckets, live_months, merge_buckets, partitioned_exists, read_partitioned,
)
from tickmart.sinks.tables import stage
from tickmart.sinks.upsert import upsert

LOOKBACK_ROWS = MOVING_AVERAGE_ROWS - 1
# A re-sent last week is still served from the tail.
TAIL_ROWS = LOOKBACK_ROWS + 7


def _tail(bars) -> F.Column:
    """The last TAIL_ROWS of an array of (date, close)."""
    return F.slice(F.reverse(F.array_sort(bars)), 1, TAIL_ROWS)


def _closes() -> F.Column:
    return F.struct(F.col("coin_date").alias("d"), F.col("close_price").alias("c"))


def state_of(bars: DataFrame) -> DataFrame:
    """State rows from all bars (a full refresh): one aggregate, of a row an asset and day."""
    return bars.groupBy("coin_id").agg(F.max("_ingested_at").alias("max_ingested_at"), F.count(F.lit(1)).alias("n_bars"),
                                       F.collect_list(_closes()).alias("t")).select(
        "coin_id", "max_ingested_at", "n_bars", _tail(F.col("t")).alias("tail"))


def write_state(state: DataFrame, path: str) -> None:
    create_buckets(state, path, ["coin_id"])


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    return read_partitioned(spark, path) if partitioned_exists(spark, path) else None


def starts(changed: DataFrame, state: DataFrame) -> DataFrame:
    """coin_id, affected_from, tail before it, whether the tail is enough (``shallow``)."""
    first = changed.groupBy("coin_id").agg(F.min("coin_date").alias("affected_from"))
    before = F.filter("tail", lambda x: x["d"] < F.col("affected_from"))
    j = first.join(state, "coin_id", "left").withColumn("before", before)
    # Enough: the tail holds all rows of the window, or all bars that there are.
    enough = F.col("tail").isNull() | (F.size("before") >= LOOKBACK_ROWS) | (F.col("n_bars") <= F.size("tail"))
    return j.select("coin_id", "affected_from", F.slice(F.coalesce("before", F.array().cast(state.schema["tail"].dataType)),
                                                        1, LOOKBACK_ROWS).alias("before"), enough.alias("shallow"))


@dataclass
class Change:
    """Where the changed assets go on from (``start``, stored), and what that takes of the bars."""

    start: DataFrame
    months: list[str]     # months of bars from the first change on
    deep: bool            # some change lies beyond its asset's tail


def change_of(spark: SparkSession, changed: DataFrame, state: DataFrame) -> Change:
    """``changed`` is stored and not yet in ``state``."""
    start = stage(starts(changed, state), "starts")
    seen = start.groupBy("shallow").agg(F.date_format(F.min("affected_from"), "yyyy-MM").alias("month")).collect()
    return Change(start, [r["month"] for r in seen], any(not r["shallow"] for r in seen))


def _bars_from(spark: SparkSession, live: Months, change: Change) -> DataFrame:
    """The bars of the changed assets from their first change on."""
    months = [m for m in live.writes if any(first <= m for first in change.months)]
    sides = small_side(change.start.select("coin_id", "affected_from"))
    return live.read(spark, months).join(sides, "coin_id").where(F.col("coin_date") >= F.col("affected_from"))


def recompute(spark: SparkSession, bars_path: str, change: Change, assets: DataFrame, price_scale: int = 2) -> DataFrame:
    """INC-2 -> metric rows from each asset's first changed bar on.

    The changed bars are in the bars table already.  Of it only the months from the first
    change on are opened; bars before it come from the tails.
    """
    start, live = change.start, live_months(spark, bars_path)
    after = _bars_from(spark, live, change)
    halo = start.where("shallow").select("coin_id", "affected_from", F.explode("before").alias("b"))
    if change.deep:
        # Changes beyond the tail: the rows before them, of these assets only.
        deep = small_side(start.where(~F.col("shallow")).select("coin_id", "affected_from"))
        old = live.read(spark).select("coin_id", "coin_date", "close_price").join(deep, "coin_id").where(
            F.col("coin_date") < F.col("affected_from"))
        tails = old.groupBy("coin_id", "affected_from").agg(F.collect_list(_closes()).alias("b"))
        halo = halo.unionByName(tails.select("coin_id", "affected_from", F.explode(
            F.slice(F.reverse(F.array_sort("b")), 1, LOOKBACK_ROWS)).alias("b")))
    halo = halo.select("coin_id", "affected_from", F.col("b.d").alias("coin_date"), F.col("b.c").alias("close_price"))
    window = after.unionByName(halo, allowMissingColumns=True)
    return (daily_metrics(window.drop("affected_from"), assets, price_scale)
            .join(small_side(start.select("coin_id", "affected_from")), "coin_id")
            .where(F.col("date_stamp") >= F.col("affected_from")).select(*METRIC_COLUMNS))


def advance(spark: SparkSession, state_path: str, bars_path: str, changed: DataFrame, change: Change, state: DataFrame) -> None:
    """Bring the state of the changed assets up to date (only their buckets are
    rewritten).  Running it again for the same change gives the same state."""
    live = live_months(spark, bars_path)
    none = F.array().cast(state.schema["tail"].dataType)
    after = (_bars_from(spark, live, change).groupBy("coin_id").agg(F.collect_list(_closes()).alias("after")))
    marks = changed.groupBy("coin_id").agg(F.max("_ingested_at").alias("new_mark"))
    known = (change.start.select("coin_id", "affected_from", "shallow").join(marks, "coin_id")
             .join(state, "coin_id", "left").join(after, "coin_id", "left"))
    tail, after_ = F.coalesce("tail", none), F.coalesce("after", none)
    kept = F.filter(tail, lambda x: x["d"] < F.col("affected_from"))
    gone = F.size(tail) - F.size(kept)
    rows = known.select(
        "coin_id", F.greatest("max_ingested_at", "new_mark").alias("max_ingested_at"),
        (F.coalesce("n_bars", F.lit(0)) - gone + F.size(after_)).cast("long").alias("n_bars"),
        _tail(F.concat(kept, after_)).alias("tail"), "shallow")
    if change.deep:
        # Beyond the tail, count and tail come from all bars of the asset.
        every = live.read(spark).join(small_side(change.start.where(~F.col("shallow")).select("coin_id")), "coin_id", "left_semi")
        rows = rows.where("shallow").drop("shallow").unionByName(state_of(every))
    rows = stage(rows.drop("shallow"), "asset-state")
    merge_buckets(rows, state_path, lambda current: upsert(current, rows, ["coin_id"], stored=True))
