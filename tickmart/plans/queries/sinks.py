"""Driver queries: keyed loads, publish, layer placement, audit.

Each query writes to a fresh folder under the session's shared scratch root
(``spark.checkpoint.dir``) and returns the table read back from it.  The
batches are whole-table slices of orders / lineitem / customer split by key
residue; together they cover every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.operators.dedupe import keep_first
from tickmart.plans.queries.registry import register
from tickmart.session import scratch_dir
from tickmart.sinks.load import COLLIDED, load
from tickmart.sinks.partitioned import create_buckets, read_partitioned
from tickmart.sinks.tables import layer_path, publish, read_table
from tickmart.sinks.upsert import ensure_columns, upsert
from tickmart.sources.driver_tables import table

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]
_OC = ", ".join(ORDER_COLS)
LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_LC = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
       "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*ORDER_COLS)


def _revised(orders: DataFrame, status: str) -> DataFrame:
    return (orders.withColumn("o_orderstatus", F.lit(status))
            .withColumn("o_totalprice", F.col("o_totalprice") * 2))


@register("upsert_keyed", f"""
WITH t AS (SELECT {_OC} FROM orders WHERE o_orderkey % 3 <> 2),
u AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice,
             o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0)
SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)
UNION ALL SELECT * FROM u""")
def upsert_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1 / J-8: overlapping load with repeated keys in one batch (last wins)."""
    orders = _orders(spark, sf)
    path = scratch_dir(spark, "upsert_keyed")
    load(orders.where(F.col("o_orderkey") % 3 != 2), path, ["o_orderkey"])
    newer = _revised(orders.where(F.col("o_orderkey") % 3 != 0), "U").withColumn("_seq", F.lit(2))
    older = (_revised(orders.where((F.col("o_orderkey") % 3 != 0) & (F.col("o_orderkey") % 5 == 0)), "X")
             .withColumn("_seq", F.lit(1)))
    load(older.unionByName(newer), path, ["o_orderkey"], order=["_seq"], transient=["_seq"])
    return read_partitioned(spark, path)


@register("upsert_composite", f"""
WITH t AS (
  SELECT {_LC} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in LI_ORDER)}) AS rn
    FROM lineitem WHERE l_orderkey % 3 <> 2) WHERE rn = 1),
u AS (
  SELECT {_LC} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in LI_ORDER)}) AS rn
    FROM lineitem WHERE l_orderkey % 3 <> 0) WHERE rn = 1)
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM u WHERE u.l_orderkey = t.l_orderkey AND u.l_linenumber = t.l_linenumber)
UNION ALL SELECT * FROM u""")
def upsert_composite(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2: composite key; the raw batch repeats keys and is reduced first."""
    li = table(spark, sf, "lineitem")
    path = scratch_dir(spark, "upsert_composite")
    create_buckets(keep_first(li.where(F.col("l_orderkey") % 3 != 2), LI_KEYS, LI_ORDER), path, LI_KEYS)
    load(li.where(F.col("l_orderkey") % 3 != 0), path, LI_KEYS, order=LI_ORDER)
    return read_partitioned(spark, path)


_T1, _T2 = "2024-01-30 06:00:00", "2024-01-31 06:00:00"


@register("upsert_bridge", f"""
WITH t AS (SELECT c_custkey AS coin_id, c_mktsegment AS category, TIMESTAMP '{_T1}' AS _ingested_at
           FROM customer WHERE c_custkey % 3 <> 2),
u AS (SELECT c_custkey AS coin_id, c_mktsegment AS category, TIMESTAMP '{_T2}' AS _ingested_at
      FROM customer WHERE c_custkey % 3 <> 0
      UNION ALL
      SELECT c_custkey, 'PREMIUM', TIMESTAMP '{_T2}' FROM customer WHERE c_custkey % 6 = 0)
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM u WHERE u.coin_id = t.coin_id AND u.category = t.category)
UNION ALL SELECT * FROM u""")
def upsert_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: (asset, category) bridge: repeats refresh ``_ingested_at`` only,
    vanished pairs stay."""
    cust = table(spark, sf, "customer")

    def pairs(where, category, ts):
        return cust.where(where).select(F.col("c_custkey").alias("coin_id"), category.alias("category"),
                                        F.lit(ts).cast("timestamp_ntz").alias("_ingested_at"))

    path = scratch_dir(spark, "upsert_bridge")
    load(pairs(F.col("c_custkey") % 3 != 2, F.col("c_mktsegment"), _T1), path, ["coin_id", "category"])
    batch = pairs(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"), _T2).unionByName(
        pairs(F.col("c_custkey") % 6 == 0, F.lit("PREMIUM"), _T2))
    load(batch, path, ["coin_id", "category"])
    return read_partitioned(spark, path)


@register("insert_only", f"""
WITH t AS (SELECT {_OC} FROM orders WHERE o_orderkey % 2 = 0),
u AS (SELECT o_orderkey, o_custkey, 'N' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0),
again AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(-1 AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority
          FROM u WHERE o_orderkey % 5 = 0)
SELECT *, 'stored' AS outcome FROM t UNION ALL
SELECT *, 'inserted' FROM u WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t) UNION ALL
SELECT *, 'collided' FROM (SELECT * FROM u UNION ALL SELECT * FROM again)
WHERE o_orderkey IN (SELECT o_orderkey FROM t)""")
def insert_only_q(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4: colliding keys keep the stored row and the batch's rows with such keys are
    kept as collisions; only new keys are appended, once each although the batch
    repeats some."""
    orders = _orders(spark, sf)
    path = scratch_dir(spark, "insert_only")
    load(orders.where(F.col("o_orderkey") % 2 == 0), path, ["o_orderkey"])
    key = F.col("o_orderkey")
    batch = orders.where((key % 2 == 1) | (key % 3 == 0)).withColumn("o_orderstatus", F.lit("N"))
    # Keys repeated within the batch: the last by ``order`` is inserted.
    repeats = batch.where(key % 5 == 0).withColumn("o_totalprice", F.lit(-1.0))
    report = load(batch.withColumn("_seq", F.lit(2)).unionByName(repeats.withColumn("_seq", F.lit(1))),
                  path, ["o_orderkey"], order=["_seq"], mode="insert_only", transient=["_seq"])
    table_rows = read_partitioned(spark, path).withColumn("outcome", F.when(key % 2 == 0, "stored").otherwise("inserted"))
    collided = report.rows_of(spark, COLLIDED).select(*ORDER_COLS).withColumn("outcome", F.lit("collided"))
    return table_rows.select(*ORDER_COLS, "outcome").unionByName(collided)


@register("schema_evolve", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT {_OC} FROM orders WHERE o_orderkey % 2 = 1""")
def schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-8: the stored table predates ``o_orderpriority``; it gains the
    column (NULL for old rows) when a batch carrying it is loaded."""
    orders = _orders(spark, sf)
    path = scratch_dir(spark, "schema_evolve")
    publish(orders.where(F.col("o_orderkey") % 2 == 0).drop("o_orderpriority"), path)
    evolved = ensure_columns(read_table(spark, path), orders.schema)
    batch = orders.where(F.col("o_orderkey") % 2 == 1)
    publish(upsert(evolved, batch, ["o_orderkey"]), path)
    return read_table(spark, path).select(*ORDER_COLS)


@register("replace_and_reload", f"""
SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority FROM orders""")
def replace_and_reload(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-5 / SNK-9: a full rebuild replaces the table as a new version; the
    old version stays readable until vacuumed."""
    orders = _orders(spark, sf)
    path = scratch_dir(spark, "replace_and_reload")
    publish(orders.where(F.col("o_orderkey") % 2 == 0), path)
    publish(orders.withColumn("o_orderstatus", F.lower("o_orderstatus")), path)
    return read_table(spark, path)


@register("load_audit", """
SELECT * FROM (VALUES
  (1, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0), false,
      (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)),
  (2, 0, true, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)),
  (3, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 4 = 0), false,
      (SELECT count(*) FROM orders))
) AS a(load_no, batch_rows, skipped, table_rows)""")
def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-10 / A-8: audit rows of three loads (the second one empty, skipped)."""
    orders = _orders(spark, sf)
    path = scratch_dir(spark, "load_audit")
    key = F.col("o_orderkey")
    reports = [
        load(orders.where(key % 2 == 0), path, ["o_orderkey"]),
        load(orders.where(F.lit(False)), path, ["o_orderkey"]),
        load(orders.where((key % 2 == 1) | (key % 4 == 0)), path, ["o_orderkey"]),
    ]
    rows = [(i + 1, r.batch_rows, r.skipped, r.table_rows) for i, r in enumerate(reports)]
    return spark.createDataFrame(
        rows, "load_no int, batch_rows long, skipped boolean, table_rows long")


@register("layer_placement", f"""
SELECT {_OC}, 'staging' AS layer FROM orders""")
def layer_placement(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7: the custom schema ``' staging '`` resolves to folder ``staging``;
    the layer is read back from where the files actually landed."""
    root = scratch_dir(spark, "layer_placement")
    path = layer_path(root, "orders", custom_schema=" staging ", default_schema="public")
    publish(_orders(spark, sf), path)
    layer = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/orders/v\d+/", 1)
    return read_table(spark, path).select(*ORDER_COLS, layer.alias("layer"))
