"""Incremental model refresh (INC-1, INC-2, INC-3, FLT-2, FLT-3, J-1, A-4, A-7).

Both refreshes must give exactly the full-refresh result:

* ``refresh_bars`` finds raw series rows that are new for their asset (no
  stored bar, or ingested after the asset's stored high-water mark), takes
  the (asset, day) bars they touch, and recomputes those bars from *all* raw
  points of the asset for those days, so a day split across raw rows is never
  rebuilt from a fragment.
* ``refresh_metrics`` recomputes each affected asset from the first changed
  bar onward, reading the 6 bars before it as look-back halo (by rows, so
  gaps in the calendar do not shorten it); lag and the 7-row average are then
  exact, and rows before the change are left alone.

Every intermediate is keyed by asset; per-asset state is one row per day.

``run_increment`` is the same over stored tables: the raw series are an ingest log
(``sinks.ingest_log``), of which only the batches not merged yet and those that
overlap the touched days are opened; the history that bars and metrics go on from is
the asset state (``plans.asset_state``); bars and metrics change by month.
"""

from __future__ import annotations

import contextvars
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickmart.fixed import MOVING_AVERAGE_ROWS
from tickmart.operators.bars import daily_bars, high_water
from tickmart.operators.joins import small_side
from tickmart.operators.metrics import METRIC_COLUMNS, daily_metrics
from tickmart.operators.unnest import sliced, unnest_series
from tickmart.plans import asset_state as S
from tickmart.sinks.ingest_log import IngestLog
from tickmart.sinks.partitioned import (
    commit, live_months, partitioned_exists, replace_partitioned, upsert_partitions, write_months,
)
from tickmart.sinks.tables import publish, publish_document, read_document, read_table, stage, table_exists
from tickmart.sinks.upsert import upsert

BAR_KEYS = ["coin_id", "coin_date"]
METRIC_KEYS = ["coin_id", "date_stamp"]
LOOKBACK_ROWS = MOVING_AVERAGE_ROWS - 1  # rows before a change that feed its window


def new_raw_rows(raw: DataFrame, bars: DataFrame | None) -> DataFrame:
    """J-1 + FLT-2 + A-4: raw rows of unseen assets or newer than the asset's
    stored ``max(_ingested_at)``."""
    if bars is None:
        return raw
    # One row an asset: stored and measured, so that the arrays of the raw rows
    # are not shuffled to it.
    return newer_than(raw, stage(high_water(bars), "high-water"))


def newer_than(raw: DataFrame, marks: DataFrame) -> DataFrame:
    """Raw rows whose asset has no mark or an older one (``max_ingested_at``)."""
    return (raw.join(small_side(marks), "coin_id", "left")
            .where(F.col("max_ingested_at").isNull()
                   | (F.col("_ingested_at") > F.col("max_ingested_at")))
            .drop("max_ingested_at"))


def refresh_bars(raw: DataFrame, bars: DataFrame | None, price_scale: int = 2,
                 full_refresh: bool = False, protect_boundary: bool = False,
                 window_cols: tuple[str, ...] = ("chart_days",)) -> tuple[DataFrame, DataFrame]:
    """INC-1 / INC-3 -> (new bars table, changed bars).

    ``protect_boundary``: a re-sent rolling window starts mid-day, so its
    first day holds only part of that day's points; with this flag a new raw
    row does not rebuild its earliest day when that bar is already stored.
    """
    if bars is None or full_refresh:
        full = daily_bars(unnest_series(raw), price_scale)
        return full, full
    fresh = new_raw_rows(raw, bars)
    if protect_boundary:
        w = list(window_cols)
        days = (unnest_series(fresh, keep=tuple(w))
                .select("coin_id", *w, F.to_date("price_ts").alias("coin_date")))
        first = days.groupBy("coin_id", *w).agg(F.min("coin_date").alias("coin_date"))
        stored_first = first.join(bars.select("coin_id", "coin_date"), BAR_KEYS, "left_semi")
        days = days.join(stored_first, ["coin_id", *w, "coin_date"], "left_anti")
    else:
        days = unnest_series(fresh).select("coin_id", F.to_date("price_ts").alias("coin_date"))
    # The touched (asset, day) keys are small: stage them once, so the new raw
    # rows are unnested a single time, then count and broadcast them (size
    # checked) so raw series and points are filtered in place, not shuffled.
    touched = stage(days.select("coin_id", "coin_date").distinct(), "touched-bars")
    changed = _bars_of(raw, touched, price_scale)
    return upsert(bars, changed, BAR_KEYS), changed


def _bars_of(raw: DataFrame, touched: DataFrame, price_scale: int) -> DataFrame:
    """The touched bars, from all points of the raw rows."""
    assets = small_side(touched.select("coin_id").distinct())
    points = (unnest_series(sliced(raw.join(assets, "coin_id", "left_semi")))
              .withColumn("coin_date", F.to_date("price_ts"))
              .join(small_side(touched), BAR_KEYS, "left_semi")
              .drop("coin_date"))
    return daily_bars(points, price_scale)


def affected_from(changed_bars: DataFrame) -> DataFrame:
    """Per asset: the earliest changed bar."""
    return changed_bars.groupBy("coin_id").agg(F.min("coin_date").alias("affected_from"))


def trailing_start(metrics: DataFrame, bars: DataFrame, days: int = LOOKBACK_ROWS) -> DataFrame:
    """FLT-3 + A-7 (the source's bound): every asset recomputes from
    ``max(stored date) - 6 days``.  Changes older than that are not seen.

    The bound is one scalar; it is fetched and applied as a literal, so date
    filters on it prune partitions and no join is needed.
    """
    latest = metrics.agg(F.max("date_stamp")).first()[0]
    bound = F.date_sub(F.lit(latest), days) if latest is not None else F.lit(None).cast("date")
    return bars.select("coin_id").distinct().withColumn("affected_from", bound)


def refresh_metrics(bars: DataFrame, changed_bars: DataFrame | None, metrics: DataFrame | None,
                    assets: DataFrame, price_scale: int = 2, full_refresh: bool = False,
                    mode: str = "changed") -> tuple[DataFrame, DataFrame]:
    """INC-2 / INC-3 -> (new metrics table, recomputed rows).

    ``mode="changed"`` starts each asset at its earliest changed bar;
    ``mode="trailing"`` uses the source's global 7-day bound instead.
    """
    if metrics is None or full_refresh:
        full = daily_metrics(bars, assets, price_scale)
        return full, full
    start = (trailing_start(metrics, bars) if mode == "trailing"
             else affected_from(changed_bars))
    scoped = bars.join(start, "coin_id")
    before = F.col("coin_date") < F.col("affected_from")
    w = Window.partitionBy("coin_id").orderBy(F.col("coin_date").desc())
    halo = (scoped.where(before).withColumn("_k", F.row_number().over(w))
            .where(F.col("_k") <= LOOKBACK_ROWS).drop("_k"))
    window_input = halo.unionByName(scoped.where(~before))
    recomputed = (daily_metrics(window_input.drop("affected_from"), assets, price_scale)
                  .join(start.withColumnRenamed("affected_from", "_from"), "coin_id")
                  .where(F.col("date_stamp") >= F.col("_from"))
                  .select(*METRIC_COLUMNS))
    return upsert(metrics, recomputed, METRIC_KEYS), recomputed


# --- over stored tables -----------------------------------------------------------------

@dataclass
class SeriesTables:
    """Paths of the stored tables that an increment goes through."""

    raw: str
    bars: str
    metrics: str
    state: str        # asset state
    merged: str       # ingest batches that the bars hold
    pending: str      # bars changed, metrics not yet

    def log(self, spark: SparkSession, window_cols: tuple[str, ...] = ("chart_days",)) -> IngestLog:
        return IngestLog(spark, self.raw, ("coin_id", *window_cols))


def changed_bars(log: IngestLog, pending: list[str], state: DataFrame, bars_path: str, price_scale: int = 2,
                 protect_boundary: bool = False, window_cols: tuple[str, ...] = ("chart_days",)) -> DataFrame | None:
    """INC-1 + J-1 + FLT-2: the bars that the ``pending`` batches touch, rebuilt from the
    current rows of every batch that overlaps their days.  None if nothing is touched."""
    spark = log.spark
    fresh = newer_than(log.read(pending), state.select("coin_id", "max_ingested_at"))
    w = list(window_cols) if protect_boundary else []
    days = unnest_series(sliced(fresh), keep=tuple(w)).select("coin_id", *w, F.to_date("price_ts").alias("coin_date"))
    touched = stage(days.where(F.col("coin_date").isNotNull()).distinct(), "touched-bars")
    lo, hi = touched.agg(F.min("coin_date"), F.max("coin_date")).first()
    if lo is None:
        return None
    if protect_boundary:
        live = live_months(spark, bars_path)
        months = [m for m in live.writes if f"{lo:%Y-%m}" <= m <= f"{hi:%Y-%m}"]
        first = touched.groupBy("coin_id", *w).agg(F.min("coin_date").alias("coin_date"))
        stored = first.join(live.read(spark, months).select(*BAR_KEYS), BAR_KEYS, "left_semi")
        touched = stage(touched.join(stored, ["coin_id", *w, "coin_date"], "left_anti"), "kept-bars")
    touched = touched.select(*BAR_KEYS).distinct()
    day = 86_400_000
    epoch = (lo - lo.replace(1970, 1, 1)).days, (hi - hi.replace(1970, 1, 1)).days
    raw = log.read(log.overlapping(epoch[0] * day, (epoch[1] + 1) * day - 1))
    return _bars_of(raw, touched, price_scale)


def run_increment(spark: SparkSession, t: SeriesTables, assets: DataFrame, price_scale: int = 2,
                  full_refresh: bool = False, protect_boundary: bool = False,
                  window_cols: tuple[str, ...] = ("chart_days",)) -> list[str] | None:
    """INC-1..3 over stored tables: bars, metrics and asset state follow the ingest log.
    Returns the months of the metrics that were rewritten (None: all).

    Changed bars are recorded before the bars table moves and cleared only once metrics
    and state caught up, and a batch counts as merged after that, so a run that dies in
    between is finished by the next one.
    """
    log = t.log(spark, window_cols)
    batches = log.batches()

    def done() -> None:
        publish_document(spark, t.merged, {"batches": batches})

    if full_refresh or not (partitioned_exists(spark, t.bars) and partitioned_exists(spark, t.state)):
        bars = daily_bars(unnest_series(sliced(log.read())), price_scale)
        # All are written before any is seen, the bars last: what a run leaves behind is
        # found again by the next one.
        new_bars = write_months(bars, t.bars, "coin_date")
        stored = new_bars.read(spark)
        new_metrics = write_months(daily_metrics(stored, assets, price_scale), t.metrics, "date_stamp")
        commit(spark, new_metrics)
        S.write_state(S.state_of(stored), t.state)
        commit(spark, new_bars)
        if table_exists(spark, t.pending):  # rebuilt from scratch: nothing pending
            publish(read_table(spark, t.pending).limit(0), t.pending)
        done()
        return None
    merged = set((read_document(spark, t.merged) or {"batches": []})["batches"])
    state = S.read_state(spark, t.state)
    changes = changed_bars(log, [b for b in batches if b not in merged], state, t.bars, price_scale, protect_boundary, window_cols)
    left = read_table(spark, t.pending) if table_exists(spark, t.pending) else None
    if changes is None and (left is None or left.isEmpty()):
        done()
        return []
    if changes is not None:
        # A newer recomputation of the same (asset, day) supersedes one left behind.
        publish(changes if left is None else upsert(left, changes, BAR_KEYS), t.pending)
    changed = read_table(spark, t.pending)
    upsert_partitions(changed, t.bars, BAR_KEYS, "coin_date", stored=True)
    change = S.change_of(spark, changed, state)

    def metrics() -> list[str] | None:
        if not partitioned_exists(spark, t.metrics):
            replace_partitioned(daily_metrics(live_months(spark, t.bars).read(spark), assets, price_scale), t.metrics, "date_stamp")
            return None
        return upsert_partitions(S.recompute(spark, t.bars, change, assets, price_scale), t.metrics, METRIC_KEYS, "date_stamp")

    # Independent of each other: two Spark jobs at a time.
    with ThreadPoolExecutor(max_workers=2) as pool:
        both = [pool.submit(contextvars.copy_context().run, f, *a) for f, *a in (
            (metrics,), (S.advance, spark, t.state, t.bars, changed, change, state))]
        months, _ = [one.result() for one in both]
    publish(changed.limit(0), t.pending)
    done()
    return months
