"""Driver queries: SCD2 history of a customer-derived dimension and as-of reads.

Versions of the dimension (key ``coin_id, category``; check columns
``coin_name, symbol, first_seen_date``):

* v1 at T1: every customer; ``first_seen_date`` NULL for ids ``% 13 == 0``.
* v2 at T2: symbol changed for ids ``% 10 == 0``, first-seen filled in
  (NULL -> value), ids ``% 17 == 0`` gone.
* v3 at T3: v2 plus the gone ids ``% 34 == 0`` returning; loaded twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.plans.queries.registry import register
from tickmart.session import scratch_dir
from tickmart.sinks.history import merge_history, read_as_of, read_history
from tickmart.sources.driver_tables import table

T1, T2, T3 = "2024-01-10 06:00:00", "2024-01-20 06:00:00", "2024-01-30 06:00:00"
AS_OF_T = "2024-01-25 00:00:00"
KEYS = ["coin_id", "category"]
CHECK = ["coin_name", "symbol", "first_seen_date"]


def dimension_version(customer: DataFrame, v: int) -> DataFrame:
    k = F.col("c_custkey")
    seen = F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int"))
    dim = customer.select(
        k.alias("coin_id"), F.col("c_name").alias("coin_name"),
        (F.when(k % 10 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")) if v > 1
         else F.col("c_mktsegment")).alias("symbol"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("category"),
        (seen if v > 1 else F.when(k % 13 != 0, seen)).alias("first_seen_date"),
    )
    if v == 2:
        dim = dim.where(k % 17 != 0)
    elif v == 3:
        dim = dim.where((k % 17 != 0) | (k % 34 == 0))
    return dim


def run_history(spark: SparkSession, sf: str) -> str:
    customer = table(spark, sf, "customer")
    path = scratch_dir(spark, "scd2")
    for v, ts in ((1, T1), (2, T2), (3, T3), (3, T3)):
        merge_history(path, dimension_version(customer, v), KEYS, CHECK, ts)
    return path


_V1 = """c_custkey AS coin_id, c_name AS coin_name, c_mktsegment AS symbol,
  'NATION_' || CAST(c_nationkey AS VARCHAR) AS category,
  CASE WHEN c_custkey % 13 <> 0 THEN DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER) END AS first_seen_date"""
_V2 = """c_custkey AS coin_id, c_name AS coin_name,
  CASE WHEN c_custkey % 10 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS symbol,
  'NATION_' || CAST(c_nationkey AS VARCHAR) AS category,
  DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER) AS first_seen_date"""

HISTORY_SQL = f"""
history AS (
  SELECT {_V1}, TIMESTAMP '{T1}' AS valid_from, TIMESTAMP '{T2}' AS valid_to, false AS is_current
  FROM customer WHERE c_custkey % 17 = 0 OR c_custkey % 10 = 0 OR c_custkey % 13 = 0
  UNION ALL
  SELECT {_V1}, TIMESTAMP '{T1}', CAST(NULL AS TIMESTAMP), true
  FROM customer WHERE NOT (c_custkey % 17 = 0 OR c_custkey % 10 = 0 OR c_custkey % 13 = 0)
  UNION ALL
  SELECT {_V2}, TIMESTAMP '{T2}', CAST(NULL AS TIMESTAMP), true
  FROM customer WHERE c_custkey % 17 <> 0 AND (c_custkey % 10 = 0 OR c_custkey % 13 = 0)
  UNION ALL
  SELECT {_V2}, TIMESTAMP '{T3}', CAST(NULL AS TIMESTAMP), true
  FROM customer WHERE c_custkey % 34 = 0
)"""


@register("scd2_history", "WITH " + HISTORY_SQL + "\nSELECT * FROM history")
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    """SCD-1 / SCD-2: changes, NULL -> value, hard deletes, returns, rerun."""
    return read_history(spark, run_history(spark, sf))


@register("scd2_as_of", "WITH " + HISTORY_SQL + f"""
SELECT * FROM history WHERE valid_from <= TIMESTAMP '{AS_OF_T}'
  AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AS_OF_T}')""")
def scd2_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """SCD-3: the dimension between the second and third load."""
    return read_as_of(spark, run_history(spark, sf), AS_OF_T)
