"""Driver queries: incremental bars and metrics over three growing loads.

events are landed as packed series rows keyed (asset, event_id div 8), like
the source's (asset, window) rows.  Load k re-sends every row that gained
points before cutoff k, carrying all of its points so far, stamped with the
load time.  The raw rows go into an ingest log, then bars and metrics follow it
incrementally; a repeated load changes nothing.  The oracle is the
full refresh computed straight from events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.plans.incremental import SeriesTables, run_increment
from tickmart.plans.queries.oracle_sql import ASSETS
from tickmart.plans.queries.registry import register
from tickmart.schemas import RAW_NUM
from tickmart.session import scratch_dir
from tickmart.sinks.partitioned import read_partitioned
from tickmart.sinks.tables import stage
from tickmart.sources.driver_tables import PRICE_IN, asset_master, market_cap_of, table

CUTOFFS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", None]
STAMPS = ["2024-01-11 06:00:00", "2024-01-21 06:00:00", "2024-02-01 06:00:00"]
RAW_KEYS = ["coin_id", "chunk_id"]


def _points(events: DataFrame) -> DataFrame:
    price = F.col("value").cast(PRICE_IN)
    cap = market_cap_of(F.col("props"))
    return events.select(
        F.col("user_id").alias("coin_id"),
        ((F.col("event_id") - F.col("event_id") % 8) / 8).cast("long").alias("chunk_id"),
        "ts",
        F.struct("ts", "event_id",
                 F.unix_millis(F.col("ts").cast("timestamp")).cast(RAW_NUM).alias("ms"),
                 price.cast(RAW_NUM).alias("price"), cap.cast(RAW_NUM).alias("cap"),
                 (price * cap).cast(RAW_NUM).alias("vol")).alias("pt"))


def load_batch(events: DataFrame, k: int) -> DataFrame:
    """Raw rows of load ``k``: rows with a point in [cutoff k-1, cutoff k)."""
    pts = _points(events)
    if CUTOFFS[k] is not None:
        pts = pts.where(F.col("ts") < F.lit(CUTOFFS[k]).cast("timestamp_ntz"))
    grouped = pts.groupBy(*RAW_KEYS).agg(F.array_sort(F.collect_list("pt")).alias("pts"),
                                         F.max("ts").alias("_last"))
    if k > 0:
        grouped = grouped.where(F.col("_last") >= F.lit(CUTOFFS[k - 1]).cast("timestamp_ntz"))

    def series(field: str):
        return F.transform("pts", lambda x: F.array(x["ms"], x[field]))

    return grouped.select(*RAW_KEYS, series("price").alias("prices"),
                          series("cap").alias("market_caps"), series("vol").alias("total_volumes"),
                          F.lit(STAMPS[k]).cast("timestamp_ntz").alias("_ingested_at"))


def run_loads(spark: SparkSession, sf: str) -> SeriesTables:
    """Run loads 1..3 then load 3 again; returns the tables."""
    events = table(spark, sf, "events")
    assets = stage(asset_master(table(spark, sf, "customer")), "assets")
    tables = SeriesTables(*(scratch_dir(spark, n) for n in ("raw", "bars", "metrics", "state", "merged", "pending")))
    for k in (0, 1, 2, 2):
        tables.log(spark, ("chunk_id",)).append(load_batch(events, k), STAMPS[k])
        run_increment(spark, tables, assets, window_cols=("chunk_id",))
    return tables


_CASE_STAMP = ("CASE WHEN max(ts) < TIMESTAMP '{c0}' THEN TIMESTAMP '{s0}' "
               "WHEN max(ts) < TIMESTAMP '{c1}' THEN TIMESTAMP '{s1}' ELSE TIMESTAMP '{s2}' END").format(
    c0=CUTOFFS[0], c1=CUTOFFS[1], s0=STAMPS[0], s1=STAMPS[1], s2=STAMPS[2])

FULL_REFRESH_BARS = f"""
p AS (
  SELECT user_id AS coin_id, event_id // 8 AS chunk_id, ts, event_id, epoch_us(ts) // 1000 AS ms,
         CAST(value AS DECIMAL(20,4)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4)) AS market_cap,
         CAST(value AS DECIMAL(20,4)) * CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4)) AS total_volume
  FROM events
),
stamps AS (SELECT coin_id, chunk_id, {_CASE_STAMP} AS stamp FROM p GROUP BY coin_id, chunk_id),
q AS (
  SELECT p.*, s.stamp,
         row_number() OVER (PARTITION BY p.coin_id, p.chunk_id ORDER BY p.ts, p.event_id) AS pos
  FROM p JOIN stamps s ON p.coin_id = s.coin_id AND p.chunk_id = s.chunk_id
),
bars AS (
  SELECT coin_id, CAST(ts AS DATE) AS coin_date,
    CAST(ROUND((array_agg(price ORDER BY ms, stamp, pos))[1], 2) AS DECIMAL(20,2)) AS open_price,
    CAST(ROUND((array_agg(price ORDER BY ms DESC, stamp DESC, pos DESC))[1], 2) AS DECIMAL(20,2)) AS close_price,
    CAST(ROUND(MAX(price), 2) AS DECIMAL(20,2)) AS high_price,
    CAST(ROUND(MIN(price), 2) AS DECIMAL(20,2)) AS low_price,
    CAST(ROUND((array_agg(market_cap ORDER BY ms DESC, stamp DESC, pos DESC))[1], 2) AS DECIMAL(20,2)) AS close_market_cap,
    CAST(ROUND((array_agg(total_volume ORDER BY ms DESC, stamp DESC, pos DESC))[1], 2) AS DECIMAL(20,2)) AS close_total_volume,
    MAX(stamp) AS _ingested_at
  FROM q GROUP BY coin_id, CAST(ts AS DATE)
)"""


@register("incremental_bars", "WITH " + FULL_REFRESH_BARS + "\nSELECT * FROM bars")
def incremental_bars(spark: SparkSession, sf: str) -> DataFrame:
    """INC-1 / SNK-6 / FLT-2 / J-1 / PRJ-2: equals the full refresh."""
    return read_partitioned(spark, run_loads(spark, sf).bars)


def _metrics_oracle() -> str:
    from tickmart.plans.queries.oracle_sql import METRICS

    return ("WITH " + FULL_REFRESH_BARS + "," + ASSETS + "," + METRICS
            + "\nSELECT * FROM metrics")


@register("incremental_metrics", _metrics_oracle())
def incremental_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """INC-2 / INC-3: per-asset recompute with a 6-row halo equals the full refresh."""
    return read_partitioned(spark, run_loads(spark, sf).metrics)
