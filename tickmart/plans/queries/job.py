"""Driver query: the daily job end to end on payloads landed from the tables.

Day 1 lands events before 2024-01-21, day 2 the windows that gained points
after it; both days land the asset universe, the market snapshot and the
category payloads.  The job is run once per day into one warehouse; the
query returns the final daily fact read back from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.operators.fingerprint import fingerprint_sql
from tickmart.plans.daily_job import FINGERPRINTS, JobConfig, run_daily_job, table_path
from tickmart.plans.queries.oracle_sql import ASSETS, BARS, FACT, METRICS, POINTS, SUMMARY, with_ctes
from tickmart.plans.queries.registry import register
from tickmart.plans.queries.shaping import snapshot_payloads
from tickmart.schemas import RAW_NUM
from tickmart.session import scratch_dir
from tickmart.sinks.partitioned import read_partitioned
from tickmart.sinks.tables import read_table
from tickmart.sources.driver_tables import PRICE_IN, market_cap_of, table

WINDOW = 64  # points per landed chart payload at most
DAYS = [("2024-01-21 00:00:00", "2024-01-21 06:00:00", "2024-01-21 12:00:00"),
        (None, "2024-01-31 06:00:00", "2024-01-31 12:00:00")]


def land_day(spark: SparkSession, sf: str, landing: str, day: int) -> None:
    events = table(spark, sf, "events")
    cutoff = DAYS[day][0]
    customer = table(spark, sf, "customer")
    # universe: every asset with events, 16 ids per line
    users = events.select(F.col("user_id")).distinct()
    lines = (users.groupBy((F.col("user_id") - F.col("user_id") % 16).alias("blk"))
             .agg(F.array_join(F.array_sort(F.collect_list(F.col("user_id").cast("string"))), ",")
                  .alias("value")))
    lines.select("value").write.text(f"{landing}/universe")
    # market snapshot lists of 50 coins, one a line: files that grow in size, not in number
    snap = snapshot_payloads(customer, dressed=False)
    snap.select(F.col("payload").alias("value")).write.text(f"{landing}/market_lines")
    # chart payloads: one per (asset, window of 64 event ids)
    price = F.col("value").cast(PRICE_IN)
    cap = market_cap_of(F.col("props"))
    pts = events.select(
        F.col("user_id").cast("string").alias("id"),
        ((F.col("event_id") - F.col("event_id") % WINDOW) / WINDOW).cast("int").alias("chart_days"),
        "ts",
        F.struct("ts", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).cast(RAW_NUM).alias("ms"),
                 price.cast(RAW_NUM).alias("price"), cap.cast(RAW_NUM).alias("cap"),
                 (price * cap).cast(RAW_NUM).alias("vol")).alias("pt"))
    if cutoff is not None:
        pts = pts.where(F.col("ts") < F.lit(cutoff).cast("timestamp_ntz"))
    windows = pts.groupBy("id", "chart_days").agg(F.array_sort(F.collect_list("pt")).alias("pts"),
                                                  F.max("ts").alias("_last"))
    if day > 0:
        windows = windows.where(F.col("_last") >= F.lit(DAYS[day - 1][0]).cast("timestamp_ntz"))

    def series(field):
        return F.transform("pts", lambda x: F.array(x["ms"], x[field]))

    charts = windows.select(
        F.to_json(F.struct("id", "chart_days", series("price").alias("prices"),
                           series("cap").alias("market_caps"),
                           series("vol").alias("total_volumes"))).alias("value"))
    charts.write.text(f"{landing}/charts")
    # category payloads: segment plus order priorities per customer
    prios = (table(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()
             .groupBy("o_custkey").agg(F.collect_list("o_orderpriority").alias("prios")))
    cats = (customer.join(prios, customer.c_custkey == prios.o_custkey, "left")
            .select(F.col("c_custkey").cast("string").alias("id"),
                    F.array_sort(F.array_union(F.array("c_mktsegment"),
                                               F.coalesce("prios", F.array().cast("array<string>"))))
                    .alias("categories")))
    cats.select(F.to_json(F.struct("id", "categories")).alias("value")).write.text(
        f"{landing}/categories")


def run_two_days(spark: SparkSession, sf: str) -> str:
    root = scratch_dir(spark, "daily_job")
    warehouse = f"{root}/warehouse"
    for day, (_, batch_ts, as_of) in enumerate(DAYS):
        landing = f"{root}/landing-{day}"
        land_day(spark, sf, landing, day)
        run_daily_job(spark, JobConfig(landing=landing, warehouse=warehouse,
                                       batch_ts=batch_ts, as_of=as_of))
    return warehouse


_TEXT_IDS = (POINTS.replace("SELECT user_id AS coin_id", "SELECT CAST(user_id AS VARCHAR) AS coin_id"),
             ASSETS.replace("SELECT c_custkey AS name_id", "SELECT CAST(c_custkey AS VARCHAR) AS name_id"))


@register("daily_job_end_to_end", with_ctes(_TEXT_IDS[0], BARS, _TEXT_IDS[1], METRICS, FACT) + "\nSELECT * FROM fact")
def daily_job_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-1 with SRC-4/5: two daily runs; the fact equals the one-shot fact."""
    cfg = JobConfig(landing="", warehouse=run_two_days(spark, sf), batch_ts="", as_of="")
    return read_partitioned(spark, table_path(cfg, "fct_daily_coin_performance"))


# What the job's other tables hold after two days, from the test tables alone.
_JOB_MODELS = f"""
markets AS (
  SELECT CAST(c_custkey AS VARCHAR) AS name_id, TRIM(COALESCE(lower(substr(c_mktsegment, 1, 3)), 'Unknown')) AS symbol_name,
    TRIM(COALESCE(c_name, 'Unknown')) AS name_of_coin,
    CAST(ROUND(CAST(COALESCE(CAST(c_acctbal AS DECIMAL(20,4)) * 0.125, 0) AS DECIMAL(38,18)), 2) AS DECIMAL(38,2)) AS current_price,
    CAST(ROUND(CAST(COALESCE(CAST(c_acctbal AS DECIMAL(20,4)) * 1000, 0) AS DECIMAL(38,18)), 2) AS DECIMAL(38,2)) AS market_cap,
    CAST(ROUND(CAST(COALESCE(CAST(c_acctbal AS DECIMAL(20,4)) + 1, 0) AS DECIMAL(38,18)), 2) AS DECIMAL(38,2)) AS high_24h,
    CAST(ROUND(CAST(COALESCE(CAST(c_acctbal AS DECIMAL(20,4)) - 1, 0) AS DECIMAL(38,18)), 2) AS DECIMAL(38,2)) AS low_24h,
    COALESCE(CAST(DATE '2021-11-10' + c_nationkey AS DATE), DATE '{DAYS[1][2][:10]}') AS all_time_high_date,
    TIMESTAMP '2024-01-31 00:00:00' + to_seconds(c_custkey) AS last_updated, TIMESTAMP '{DAYS[1][1]}' AS ingested_at
  FROM customer
), categories AS (
  SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS coin_id, category, TIMESTAMP '{DAYS[1][1]}' AS _ingested_at
  FROM (SELECT c_custkey, c_mktsegment AS category FROM customer
        UNION ALL SELECT c_custkey, o_orderpriority FROM customer JOIN orders ON o_custkey = c_custkey)
  WHERE category IS NOT NULL AND c_custkey IN (SELECT user_id FROM events)
), category_metrics AS (
  SELECT c.coin_id, TRIM(c.category) AS category, m.name_of_coin, m.prev_day_price, m.daily_price_change_pcg, m.moving_avg_7d,
         c._ingested_at AS category_ingested_at, m.date_stamp
  FROM categories c LEFT JOIN metrics m ON m.coin_id = c.coin_id
), first_days AS (
  SELECT coin_id, MIN(coin_date) AS now, MIN(coin_date) FILTER (WHERE coin_date < DATE '{DAYS[0][0][:10]}') AS before
  FROM bars GROUP BY coin_id
), both_days AS (
  SELECT DISTINCT c.coin_id, TRIM(c.category) AS category, m.symbol_name AS symbol, m.name_of_coin AS name, f.now, f.before
  FROM categories c LEFT JOIN markets m ON m.name_id = c.coin_id LEFT JOIN first_days f ON f.coin_id = c.coin_id
), dim AS (
  SELECT coin_id, CASE WHEN now IS NOT NULL THEN name END AS coin_name, symbol, category, now AS first_seen_date FROM both_days
), history AS (
  SELECT coin_id, CASE WHEN before IS NOT NULL THEN name END AS coin_name, symbol, category, before AS first_seen_date,
         TIMESTAMP '{DAYS[0][1]}' AS valid_from,
         CASE WHEN before IS DISTINCT FROM now THEN TIMESTAMP '{DAYS[1][1]}' END AS valid_to, before IS NOT DISTINCT FROM now AS is_current
  FROM both_days
  UNION ALL
  SELECT coin_id, name, symbol, category, now, TIMESTAMP '{DAYS[1][1]}', NULL, true
  FROM both_days WHERE before IS DISTINCT FROM now
)"""
_SOURCES = {"stg_coin_markets": "markets", "stg_coin_price_history": "bars", "int_coin_daily_metrics": "metrics",
            "int_coin_categories": "category_metrics", "dim_coins": "dim", "fct_daily_coin_performance": "fact",
            "fct_market_summary": "summary", "dim_coins_snapshot": "history"}


@register("daily_job_models", with_ctes(_TEXT_IDS[0], BARS, _TEXT_IDS[1], METRICS, FACT, SUMMARY, _JOB_MODELS) + "\n"
          + "\nUNION ALL ".join(fingerprint_sql(name, source, FINGERPRINTS[name]) for name, source in _SOURCES.items()))
def daily_job_models(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-1..6, SCD-1/2: the fingerprint of every model table after two daily runs."""
    cfg = JobConfig(landing="", warehouse=run_two_days(spark, sf), batch_ts="", as_of="")
    return read_table(spark, table_path(cfg, "table_fingerprints")).drop("batch_ts")
