"""Driver queries: data-quality checks, report, freshness and write constraints."""

from __future__ import annotations

import contextvars
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.operators import quality as Q
from tickmart.operators.bars import daily_bars
from tickmart.operators.ledger import LedgerTable, QualityLedger
from tickmart.plans import models as M
from tickmart.plans.daily_job import model_checks as job_checks
from tickmart.plans.queries.oracle_sql import (
    ASSETS, BARS, CATEGORIES, CATEGORY_BATCH_TS, DIMENSION, FACT, METRICS, POINTS, SUMMARY,
)
from tickmart.plans.queries.registry import register
from tickmart.session import scratch_dir
from tickmart.sinks.load import REFUSED, load
from tickmart.sinks.partitioned import live_months, read_partitioned, replace_partitioned
from tickmart.plans.queries.shaping import staged_snapshot, staged_snapshot_ctes
from tickmart.sinks.tables import stage
from tickmart.sources.driver_tables import (
    asset_master, price_points, segment_categories, table,
)

TABLE_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


@register("dq_unique", """
SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL
GROUP BY l_orderkey HAVING count(*) > 1""")
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return Q.unique_violations(table(spark, sf, "lineitem"), "l_orderkey")


@register("dq_not_null", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS violations FROM {t}"
    for t, cols in TABLE_COLUMNS.items() for c in cols))
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-2: every column of four tables, one aggregation pass per table."""
    parts = [Q.null_counts(table(spark, sf, t), cols).select(F.lit(t).alias("table_name"), "*")
             for t, cols in TABLE_COLUMNS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq_unique_combo", """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_unique_combo(spark: SparkSession, sf: str) -> DataFrame:
    return Q.unique_combination_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_relationships", """
SELECT 'orders.o_orderkey->lineitem.l_orderkey' AS check_name, o_orderkey AS value, count(*) AS n_records
FROM orders WHERE o_orderkey IS NOT NULL
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)
GROUP BY o_orderkey
UNION ALL
SELECT 'events.user_id->customer.c_custkey', user_id, count(*) FROM events
WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
GROUP BY user_id""")
def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-4: orders without lines (257 at sf0.01), event assets without master."""
    a = Q.relationship_violations(table(spark, sf, "orders"), "o_orderkey",
                                  table(spark, sf, "lineitem"), "l_orderkey")
    b = Q.relationship_violations(table(spark, sf, "events"), "user_id",
                                  table(spark, sf, "customer"), "c_custkey")
    return (a.select(F.lit("orders.o_orderkey->lineitem.l_orderkey").alias("check_name"),
                     F.col("o_orderkey").alias("value"), "n_records")
            .unionByName(b.select(F.lit("events.user_id->customer.c_custkey").alias("check_name"),
                                  F.col("user_id").alias("value"), "n_records")))


@register("dq_non_negative", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0""")
def dq_non_negative(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-5: negative balances fail; zero and NULL pass."""
    return Q.non_negative_violations(table(spark, sf, "customer"), "c_acctbal").select(
        "c_custkey", "c_acctbal")


# --- report over the built models (the source project's model tests) ---------------

# The job's tables as this report names them.
_NAMES = {"stg_coin_markets": "markets", "stg_coin_price_history": "bars", "int_coin_daily_metrics": "metrics",
          "int_coin_categories": "category_metrics", "dim_coins": "dim",
          "fct_daily_coin_performance": "fact", "fct_market_summary": "summary"}


def model_checks() -> list[Q.Check]:
    return [replace(c, table=_NAMES[c.table], parent=_NAMES[c.parent] if c.parent else c.parent)
            for c in job_checks()]


def model_tables(spark: SparkSession, sf: str) -> dict[str, LedgerTable]:
    """The models the checks run on, each written once to the shared scratch root
    and read back: ~50 checks each prune different columns, so without this every
    check would compute its model again.  What grows with history is in months."""
    customer = stage(table(spark, sf, "customer"), "dq-customer")
    root = scratch_dir(spark, "dq")
    cats = segment_categories(customer, CATEGORY_BATCH_TS)
    assets = asset_master(customer, table(spark, sf, "nation"))

    def months(df: DataFrame, name: str, date_col: str) -> LedgerTable:
        replace_partitioned(df, f"{root}/{name}", date_col)
        return LedgerTable.of_months(spark, live_months(spark, f"{root}/{name}"), date_col)

    bars = months(daily_bars(price_points(table(spark, sf, "events"))), "bars", "coin_date")
    stored_bars = read_partitioned(spark, f"{root}/bars")
    metrics = months(M.daily_metrics(stored_bars, asset_master(customer)), "metrics", "date_stamp")
    stored = read_partitioned(spark, f"{root}/metrics")
    rest = {
        "markets": staged_snapshot(customer),
        "category_metrics": M.category_metrics(cats, stored),
        "dim": M.asset_dimension(cats, assets, stored_bars),
        "summary": M.market_summary(stored),
    }
    with ThreadPoolExecutor(max_workers=len(rest)) as pool:      # independent of each other
        staged = {name: pool.submit(contextvars.copy_context().run, stage, df, f"dq-{name}") for name, df in rest.items()}
        whole = {name: LedgerTable.whole(f.result(), "first") for name, f in staged.items()}
    # The fact is a renaming of the metrics: the same parts.
    fact = LedgerTable(metrics.writes, lambda parts: M.daily_fact(metrics.read(parts)).withColumn(
        "_part", F.coalesce(F.date_format("trade_date", "yyyy-MM"), F.lit("none"))), "trade_date")
    return {"bars": bars, "metrics": metrics, "fact": fact, **whole}


def _check_sql(c: Q.Check) -> str:
    col = c.columns[0]
    if c.kind == "not_null":
        n = f"(SELECT count(*) FROM {c.table} WHERE {col} IS NULL)"
    elif c.kind == "non_negative":
        n = f"(SELECT count(*) FROM {c.table} WHERE {col} < 0)"
    elif c.kind == "unique":
        n = (f"(SELECT count(*) FROM (SELECT {col} FROM {c.table} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING count(*) > 1))")
    elif c.kind == "unique_combination":
        cols = ", ".join(c.columns)
        n = f"(SELECT count(*) FROM (SELECT {cols} FROM {c.table} GROUP BY {cols} HAVING count(*) > 1))"
    else:
        n = (f"(SELECT count(*) FROM {c.table} WHERE {col} IS NOT NULL AND {col} NOT IN "
             f"(SELECT TRY_CAST({c.parent_column} AS BIGINT) FROM {c.parent} "
             f"WHERE TRY_CAST({c.parent_column} AS BIGINT) IS NOT NULL))")
    return (f"SELECT '{c.table}' AS table_name, '{c.kind}' AS check_name, "
            f"'{c.column_label}' AS column_name, '{c.severity}' AS severity, "
            f"CAST({n} AS BIGINT) AS violations")


DQ_REPORT_SQL = (
    "WITH " + ",".join([staged_snapshot_ctes(), POINTS, BARS, ASSETS, METRICS, CATEGORIES,
                        DIMENSION, FACT, SUMMARY])
    + ",\nchecks AS (\n" + "\nUNION ALL\n".join(_check_sql(c) for c in model_checks()) + "\n)\n"
    + "SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
      "ELSE 'fail' END AS status FROM checks")


@register("dq_report", DQ_REPORT_SQL)
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-6 / DQ-8: every model check as one report row (the gate raises on 'fail'), part by
    part through a new ledger."""
    return QualityLedger(spark, scratch_dir(spark, "dq-ledger")).refresh(model_tables(spark, sf), model_checks())


AS_OF = "2024-01-31 12:00:00"
FRESHNESS_RULES = [
    Q.Freshness("price_history", "_ingested_at", 12 * 3600, 24 * 3600),
    Q.Freshness("categories", "_ingested_at", 3 * 86400, 7 * 86400),
    Q.Freshness("markets", "o_orderdate", 12 * 3600, 24 * 3600),
]


@register("dq_freshness", f"""
WITH src AS (
  SELECT 'price_history' AS source_name, MAX(date_trunc('hour', ts) + INTERVAL 1 HOUR) AS max_loaded_at,
         12 * 3600 AS warn_s, 24 * 3600 AS error_s FROM events
  UNION ALL
  SELECT 'categories', MAX(TIMESTAMP '{CATEGORY_BATCH_TS}'), 3 * 86400, 7 * 86400 FROM customer
  UNION ALL
  SELECT 'markets', MAX(o_orderdate), 12 * 3600, 24 * 3600 FROM orders
)
SELECT source_name, max_loaded_at,
       CAST(date_diff('second', max_loaded_at, TIMESTAMP '{AS_OF}') AS BIGINT) AS age_seconds,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN date_diff('second', max_loaded_at, TIMESTAMP '{AS_OF}') > error_s THEN 'error'
            WHEN date_diff('second', max_loaded_at, TIMESTAMP '{AS_OF}') > warn_s THEN 'warn'
            ELSE 'pass' END AS status
FROM src""")
def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-7: price history loaded exactly 12 h before ``as_of`` is still fresh."""
    tables = {
        "price_history": price_points(table(spark, sf, "events")),
        "categories": segment_categories(table(spark, sf, "customer"), CATEGORY_BATCH_TS),
        "markets": table(spark, sf, "orders"),
    }
    return Q.freshness(spark, tables, FRESHNESS_RULES, AS_OF)


@register("write_constraints", """
SELECT 'lineitem' AS table_name, 'primary_key' AS check_name, 'l_orderkey,l_linenumber' AS column_name,
  (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'lineitem', 'not_null', 'l_orderkey', (SELECT count(*) - count(l_orderkey) FROM lineitem)
UNION ALL SELECT 'lineitem', 'not_null', 'l_linenumber', (SELECT count(*) - count(l_linenumber) FROM lineitem)
UNION ALL SELECT 'orders', 'primary_key', 'o_orderkey',
  (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'not_null', 'o_orderkey', (SELECT count(*) - count(o_orderkey) FROM orders)
UNION ALL SELECT 'orders', 'refused', 'null in o_custkey', (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0)
UNION ALL SELECT 'orders', 'refused', 'null in o_orderkey', (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0)
UNION ALL SELECT 'orders', 'refused', 'null in o_orderkey, o_custkey', (SELECT count(*) FROM orders WHERE o_orderkey % 35 = 0)
UNION ALL SELECT 'orders', 'accepted', 'o_orderkey', (SELECT count(*) FROM orders)""")
def write_constraints(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-11: key and NOT NULL constraints checked before a write; then a load whose
    batch holds, beside all orders, copies that lost a key or a NOT NULL column: they are
    refused by reason, and the rest is stored."""
    orders = table(spark, sf, "orders")
    before = pre_write_violations({
        "lineitem": (table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "orders": (orders, ["o_orderkey"]),
    })
    key = F.col("o_orderkey")
    broken = orders.where((key % 5 == 0) | (key % 7 == 0)).select(
        "*", F.when(key % 5 != 0, key).alias("_key"), F.when(key % 7 != 0, F.col("o_custkey")).alias("_cust"))
    broken = broken.withColumn("o_orderkey", F.col("_key")).withColumn("o_custkey", F.col("_cust")).drop("_key", "_cust")
    path = scratch_dir(spark, "write_constraints")
    report = load(orders.unionByName(broken), path, ["o_orderkey"], not_null=["o_custkey"], refuse="keep")
    refused = report.rows_of(spark, REFUSED).groupBy(F.col("_refusal").alias("column_name")).agg(
        F.count(F.lit(1)).alias("violations")).select(F.lit("orders").alias("table_name"), F.lit("refused").alias("check_name"),
                                                      "column_name", "violations")
    stored = read_partitioned(spark, path).agg(F.count("o_orderkey").alias("violations")).select(
        F.lit("orders").alias("table_name"), F.lit("accepted").alias("check_name"), F.lit("o_orderkey").alias("column_name"), "violations")
    return before.unionByName(refused).unionByName(stored)


def pre_write_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Primary-key (composite unique) and NOT NULL violation counts per table."""
    parts = []
    for name, (df, keys) in tables.items():
        dup = Q.unique_combination_violations(df, keys).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(dup.select(F.lit(name).alias("table_name"), F.lit("primary_key").alias("check_name"),
                                F.lit(",".join(keys)).alias("column_name"), "violations"))
        parts.append(Q.null_counts(df, keys).select(
            F.lit(name).alias("table_name"), F.lit("not_null").alias("check_name"),
            "column_name", "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
