"""Bindings from the shared parquet test tables to this engine's inputs.

The test tables stand in for the market domain:

* ``events``: price points.  ``user_id`` = asset, ``ts`` = point time (UTC),
  ``value`` = price (a 4-decimal number), ``props.k`` = market cap, and
  ``value * k`` = total volume.  A point is landed by the hourly load after
  it, so ``_ingested_at = date_trunc('hour', ts) + 1 hour``.
* ``customer``: asset master (``c_custkey`` = id, ``c_name`` = name,
  nation name = symbol) and category bridge (``c_mktsegment``).
* ``orders`` / ``lineitem``: keyed loads for the sink and quality operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.functions import event_order, text_or_unknown

PRICE_IN = "decimal(20,4)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def market_cap_of(props) -> F.Column:
    return F.get_json_object(props, "$.k").cast(PRICE_IN)


def price_points(events: DataFrame) -> DataFrame:
    """events -> canonical price points (see ``operators.bars``)."""
    price = F.col("value").cast(PRICE_IN)
    cap = market_cap_of(F.col("props"))
    return events.select(
        F.col("user_id").alias("coin_id"),
        F.col("ts").alias("price_ts"),
        event_order(F.col("ts"), F.col("event_id")).alias("point_order"),
        price.alias("price"),
        cap.alias("market_cap"),
        (price * cap).alias("total_volume"),
        (F.date_trunc("hour", F.col("ts")) + F.expr("INTERVAL 1 HOUR")).alias("_ingested_at"),
    )


def asset_master(customer: DataFrame, nation: DataFrame | None = None) -> DataFrame:
    """Staged snapshot subset: ``name_id, name_of_coin, symbol_name``."""
    base = customer.select(
        F.col("c_custkey").alias("name_id"),
        text_or_unknown(F.col("c_name")).alias("name_of_coin"),
        "c_nationkey",
    )
    if nation is None:
        return base.select("name_id", "name_of_coin",
                           F.lit("Unknown").alias("symbol_name"))
    symbols = nation.select(F.col("n_nationkey").alias("c_nationkey"),
                            text_or_unknown(F.col("n_name")).alias("symbol_name"))
    return base.join(symbols, "c_nationkey", "left").select(
        "name_id", "name_of_coin",
        F.coalesce(F.col("symbol_name"), F.lit("Unknown")).alias("symbol_name"))


def segment_categories(customer: DataFrame, ingested_at: str) -> DataFrame:
    """Staged category bridge: one (asset, segment) row per customer."""
    return customer.select(
        F.col("c_custkey").alias("coin_id"),
        F.trim(F.col("c_mktsegment")).alias("category"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
    ).where(F.col("category").isNotNull())
