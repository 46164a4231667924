"""Driver queries: bars, metrics, rankings and marts (events + customer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.functions import epoch_ms_to_seconds, epoch_ms_to_utc_date, epoch_ms_to_utc_ts
from tickmart.operators import bars as B
from tickmart.operators.ranking import daily_ranks
from tickmart.operators.standardise import standardise_categories
from tickmart.plans import models as M
from tickmart.plans.incremental import refresh_metrics
from tickmart.plans.queries.oracle_sql import (
    ASSETS, BARS, CATEGORIES, CATEGORY_BATCH_TS, DIMENSION, METRICS, POINTS, SUMMARY, with_ctes,
)
from tickmart.plans.queries.registry import register
from tickmart.sinks.tables import stage
from tickmart.sources.driver_tables import (
    asset_master, price_points, segment_categories, table,
)



def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return B.daily_bars(price_points(table(spark, sf, "events")))


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return M.daily_metrics(_bars(spark, sf), asset_master(table(spark, sf, "customer")))


FLAGSHIP_SQL = with_ctes(POINTS, BARS, ASSETS, METRICS) + """
SELECT coin_id, name_of_coin, date_stamp AS trade_date, open_price AS open_price_usd,
       high_price AS high_price_usd, low_price AS low_price_usd, close_price AS close_price_usd,
       close_total_volume AS volume, close_market_cap AS market_cap,
       daily_price_change_pcg AS daily_price_change_pct, moving_avg_7d AS moving_avg_7d_price
FROM metrics"""


@register("flagship_daily_fact", FLAGSHIP_SQL)
def flagship_daily_fact(spark: SparkSession, sf: str) -> DataFrame:
    """events -> bars -> metrics (⟕ asset names) -> daily fact."""
    return M.daily_fact(_metrics(spark, sf))


@register("ohlc_bars", with_ctes(POINTS, BARS) + "\nSELECT * FROM bars")
def ohlc_bars(spark: SparkSession, sf: str) -> DataFrame:
    return _bars(spark, sf)


@register("close_sibling_series", with_ctes(POINTS, """
bars AS (
  SELECT coin_id, CAST(ts AS DATE) AS coin_date,
    CAST(ROUND((array_agg(market_cap ORDER BY ts DESC, event_id DESC))[1], 2) AS DECIMAL(20,2)) AS close_market_cap,
    CAST(ROUND((array_agg(total_volume ORDER BY ts DESC, event_id DESC))[1], 2) AS DECIMAL(20,2)) AS close_total_volume,
    MAX(_ingested_at) AS _ingested_at
  FROM pts GROUP BY coin_id, CAST(ts AS DATE)
)""") + "\nSELECT * FROM bars")
def close_sibling_series(spark: SparkSession, sf: str) -> DataFrame:
    return B.close_of_day(price_points(table(spark, sf, "events")))


@register("epoch_to_utc_date", """
SELECT event_id, ms, epoch_ms((ms // 1000) * 1000) AS price_ts, CAST(epoch_ms((ms // 1000) * 1000) AS DATE) AS coin_date,
       ms // 1000 AS epoch_seconds
FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)""")
def epoch_to_utc_date(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-6: unix millis -> whole-second UTC timestamp -> UTC date."""
    ev = table(spark, sf, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return ev.select(
        "event_id", "ms",
        epoch_ms_to_utc_ts(F.col("ms")).alias("price_ts"),
        epoch_ms_to_utc_date(F.col("ms")).alias("coin_date"),
        epoch_ms_to_seconds(F.col("ms")).alias("epoch_seconds"),
    )


_METRICS_SQL = with_ctes(POINTS, BARS, ASSETS, METRICS)


@register("prev_value_lag", _METRICS_SQL + """
SELECT coin_id, date_stamp, close_price, prev_day_price FROM metrics""")
def prev_value_lag(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).select("coin_id", "date_stamp", "close_price", "prev_day_price")


@register("moving_avg_7", _METRICS_SQL + """
SELECT coin_id, date_stamp, close_price, moving_avg_7d FROM metrics""")
def moving_avg_7(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).select("coin_id", "date_stamp", "close_price", "moving_avg_7d")


@register("daily_change_pct", _METRICS_SQL + """
SELECT coin_id, date_stamp, close_price, prev_day_price, daily_price_change_pcg FROM metrics""")
def daily_change_pct(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).select(
        "coin_id", "date_stamp", "close_price", "prev_day_price", "daily_price_change_pcg")


def _assets(spark: SparkSession, sf: str) -> int:
    """Assets at most (from the files' footers)."""
    return table(spark, sf, "customer").count()


@register("rank_gainers", _METRICS_SQL + """
SELECT coin_id, date_stamp, daily_price_change_pcg,
       row_number() OVER (PARTITION BY date_stamp
                          ORDER BY daily_price_change_pcg DESC NULLS FIRST, coin_id) AS ranked_gainer
FROM metrics WHERE daily_price_change_pcg IS NOT NULL""")
def rank_gainers(spark: SparkSession, sf: str) -> DataFrame:
    """W-5 / FLT-4: every asset's daily rank by change, largest first."""
    return daily_ranks(_metrics(spark, sf), descending=True, rank_col="ranked_gainer", assets=_assets(spark, sf))


@register("rank_losers", _METRICS_SQL + """
SELECT coin_id, date_stamp, daily_price_change_pcg,
       row_number() OVER (PARTITION BY date_stamp
                          ORDER BY daily_price_change_pcg ASC NULLS LAST, coin_id) AS ranked_loser
FROM metrics WHERE daily_price_change_pcg IS NOT NULL""")
def rank_losers(spark: SparkSession, sf: str) -> DataFrame:
    """W-6 / FLT-4: every asset's daily rank by change, smallest first."""
    return daily_ranks(_metrics(spark, sf), descending=False, rank_col="ranked_loser", assets=_assets(spark, sf))


MARKET_SUMMARY_SQL = with_ctes(POINTS, BARS, ASSETS, METRICS, SUMMARY) + "\nSELECT * FROM summary"


@register("market_summary", MARKET_SUMMARY_SQL)
def market_summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.market_summary(_metrics(spark, sf))


@register("category_metrics", with_ctes(POINTS, BARS, ASSETS, METRICS, CATEGORIES)
          + "\nSELECT * FROM category_metrics")
def category_metrics(spark: SparkSession, sf: str) -> DataFrame:
    cats = segment_categories(table(spark, sf, "customer"), CATEGORY_BATCH_TS)
    return M.category_metrics(cats, _metrics(spark, sf))


ASSET_DIMENSION_SQL = (with_ctes(POINTS, BARS, ASSETS, METRICS, CATEGORIES, DIMENSION)
                       + "\nSELECT * FROM dim")


@register("asset_dimension", ASSET_DIMENSION_SQL)
def asset_dimension(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    cats = segment_categories(customer, CATEGORY_BATCH_TS)
    assets = asset_master(customer, table(spark, sf, "nation"))
    return M.asset_dimension(cats, assets, _bars(spark, sf))


@register("first_seen", with_ctes(POINTS, BARS) + """
SELECT coin_id, MIN(coin_date) AS first_seen_date FROM bars GROUP BY coin_id""")
def first_seen_q(spark: SparkSession, sf: str) -> DataFrame:
    return B.first_seen(_bars(spark, sf))


@register("high_water", with_ctes(POINTS, BARS) + """
SELECT coin_id, MAX(_ingested_at) AS max_ingested_at FROM bars GROUP BY coin_id""")
def high_water_q(spark: SparkSession, sf: str) -> DataFrame:
    return B.high_water(_bars(spark, sf))


STORED_BEFORE = "2024-01-21"
STALE = -1


@register("trailing_metrics", with_ctes(POINTS, BARS, ASSETS, METRICS) + f"""
SELECT * REPLACE (
  CASE WHEN date_stamp < (SELECT max(coin_date) FROM bars WHERE coin_date < DATE '{STORED_BEFORE}') - 6
       THEN CAST({STALE} AS DECIMAL(20,2)) ELSE moving_avg_7d END AS moving_avg_7d)
FROM metrics""")
def trailing_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-3 / A-7: the stored metrics hold a stale average; the refresh from the
    newest stored date less six days on replaces it there and leaves it before."""
    metrics = stage(_metrics(spark, sf), "metrics")
    average = metrics.schema["moving_avg_7d"].dataType
    stored = (metrics.where(F.col("date_stamp") < F.lit(STORED_BEFORE).cast("date"))
              .withColumn("moving_avg_7d", F.lit(STALE).cast(average)))
    new, _ = refresh_metrics(stage(_bars(spark, sf), "bars"), None, stored,
                             asset_master(table(spark, sf, "customer")), mode="trailing")
    return new


@register("bridge_cleanup", f"""
SELECT CAST(c_custkey AS VARCHAR) AS coin_id, TRIM(c_mktsegment) AS category,
       TIMESTAMP '{CATEGORY_BATCH_TS}' AS _ingested_at
FROM customer""")
def bridge_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-4: ids and categories landed with spaces around them."""
    raw = table(spark, sf, "customer").select(
        F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("coin_id"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("   ")).alias("category"),
        F.lit(CATEGORY_BATCH_TS).cast("timestamp").alias("_ingested_at"))
    return standardise_categories(raw)
