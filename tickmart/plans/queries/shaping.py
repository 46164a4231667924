"""Driver queries: payload scans, unnest, staging projections, dedupe, universe.

The payload fixtures are built in Spark from the whole test tables (bounded
groups: at most 8 points per packed series row, 50 coins per snapshot
payload, 16 ids per universe line).  Modulo rules only decide *how* a row is
dressed up (NULLs, spaces, repeats, error payloads), never which rows run.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.fixed import SNAPSHOT_PAGE_SIZE
from tickmart.operators.dedupe import keep_first, keep_latest, missing_keys, top_n
from tickmart.operators.standardise import SNAPSHOT_RULES, standardise_snapshot
from tickmart.operators.unnest import sliced, unnest_series
from tickmart.plans.queries.registry import register
from tickmart.schemas import RAW_NUM, RAW_SNAPSHOT
from tickmart.sources.driver_tables import PRICE_IN, market_cap_of, table
from tickmart.session import scratch_dir
from tickmart.sinks.tables import stage
from tickmart.sources.payloads import accepted_charts, category_rows, parse_charts, read_payloads, rejects, snapshot_rows
from tickmart.sources.universe import parse_universe, restrict_to_universe

BATCH_TS = "2024-01-31 06:00:00"
AS_OF_DATE = "2024-02-01"
AS_OF_TS = "2024-02-01 06:00:00"


def _mod(c: str, n: int) -> Column:
    return F.col(c) % n


# --- J-2 / SRC-2 -----------------------------------------------------------

def packed_series(events: DataFrame) -> DataFrame:
    """events -> raw series rows: per (asset, event_id div 8) three arrays of
    ``[ms, value]`` in time order; odd chunks lose the last market cap, chunks
    ``% 3 == 2`` lose the first volume (unequal lengths)."""
    price = F.col("value").cast(PRICE_IN)
    cap = market_cap_of(F.col("props"))
    pts = events.select(
        F.col("user_id").alias("coin_id"),
        (F.col("event_id") - F.col("event_id") % 8).cast("long").alias("_c8"),
        F.struct("ts", "event_id",
                 F.unix_millis(F.col("ts").cast("timestamp")).cast(RAW_NUM).alias("ms"),
                 price.cast(RAW_NUM).alias("price"), cap.cast(RAW_NUM).alias("cap"),
                 (price * cap).cast(RAW_NUM).alias("vol")).alias("pt"),
    ).withColumn("chunk_id", (F.col("_c8") / 8).cast("long")).drop("_c8")
    packed = pts.groupBy("coin_id", "chunk_id").agg(F.array_sort(F.collect_list("pt")).alias("pts"))
    n = F.size("pts")

    def series(field: str) -> Column:
        return F.transform("pts", lambda x: F.array(x["ms"], x[field]))

    return packed.select(
        "coin_id", "chunk_id",
        series("price").alias("prices"),
        F.when(_mod("chunk_id", 2) == 1, F.slice(series("cap"), 1, n - 1))
        .otherwise(series("cap")).alias("market_caps"),
        F.when(_mod("chunk_id", 3) == 2, F.slice(series("vol"), 2, n - 1))
        .otherwise(series("vol")).alias("total_volumes"),
        F.lit(BATCH_TS).cast("timestamp_ntz").alias("_ingested_at"),
    )


@register("series_unnest_positional", """
WITH p AS (
  SELECT user_id AS coin_id, event_id // 8 AS chunk_id, ts, event_id,
    epoch_us(ts) // 1000 AS ms,
    CAST(CAST(value AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS price,
    CAST(CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS market_cap,
    CAST(CAST(value AS DECIMAL(20,4)) * CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4))
         AS DECIMAL(38,18)) AS vol
  FROM events
),
q AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY coin_id, chunk_id) AS n,
         lead(vol) OVER w AS next_vol
  FROM p WINDOW w AS (PARTITION BY coin_id, chunk_id ORDER BY ts, event_id)
)
SELECT coin_id, chunk_id, pos AS ordinality, ms AS price_ms,
       make_timestamp((ms // 1000) * 1000000) AS price_ts, price, market_cap,
       CASE WHEN chunk_id % 3 = 2 THEN next_vol ELSE vol END AS total_volume
FROM q
WHERE pos <= n - GREATEST(CASE WHEN chunk_id % 2 = 1 THEN 1 ELSE 0 END,
                          CASE WHEN chunk_id % 3 = 2 THEN 1 ELSE 0 END)""")
def series_unnest_positional(spark: SparkSession, sf: str) -> DataFrame:
    """J-2: every packed series is cut into slices of 4 points before it is unnested."""
    pts = unnest_series(sliced(packed_series(table(spark, sf, "events")), points=4), keep=("chunk_id",))
    return pts.select("coin_id", "chunk_id", F.col("ordinality").cast("long").alias("ordinality"),
                      "price_ms", "price_ts", "price", "market_cap", "total_volume")


# --- PRJ-3 ------------------------------------------------------------------

# Raw snapshot columns dressed from customer; SQL text valid in Spark and DuckDB.
_RAW_FROM_CUSTOMER = [
    ("id", "CASE WHEN c_custkey % 13 = 0 THEN concat('  ', CAST(c_custkey AS STRING), ' ') "
           "ELSE CAST(c_custkey AS STRING) END"),
    ("symbol", "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 4 = 0 "
               "THEN concat(' ', lower(substr(c_mktsegment, 1, 3)), ' ') "
               "ELSE lower(substr(c_mktsegment, 1, 3)) END"),
    ("name", "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 9 = 0 "
             "THEN concat(c_name, chr(9)) ELSE c_name END"),
    ("image", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('img/', CAST(c_custkey AS STRING), '.png') END"),
    ("current_price", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(20,4)) * 0.125 END"),
    ("market_cap", "CAST(c_acctbal AS DECIMAL(20,4)) * 1000"),
    ("market_cap_rank", "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_nationkey + 1 END"),
    ("fully_diluted_valuation", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(20,4)) * 2000 END"),
    ("total_volume", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.375"),
    ("high_24h", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.125 + 1"),
    ("low_24h", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.125 - 1"),
    ("price_change_24h", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.005"),
    ("price_change_percentage_24h", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.001"),
    ("market_cap_change_24h", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.0625"),
    ("market_cap_change_percentage_24h", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.002"),
    ("circulating_supply", "CAST(c_custkey AS DECIMAL(20,4)) * 1000"),
    ("total_supply", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey AS DECIMAL(20,4)) * 2000 END"),
    ("max_supply", "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(c_custkey AS DECIMAL(20,4)) * 2100 END"),
    ("ath", "CAST(c_acctbal AS DECIMAL(20,4)) * 1.5"),
    ("ath_change_percentage", "CAST(c_acctbal AS DECIMAL(20,4)) * -0.015"),
    ("ath_date", "CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE DATE '2021-11-10' + c_nationkey END"),
    ("atl", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.005"),
    ("atl_change_percentage", "CAST(c_acctbal AS DECIMAL(20,4)) * 0.25"),
    ("atl_date", "CASE WHEN c_custkey % 8 = 3 THEN NULL ELSE DATE '2015-10-20' + CAST(c_custkey % 100 AS INT) END"),
    ("roi_times", "CASE WHEN c_custkey % 3 = 0 THEN CAST(c_acctbal AS DECIMAL(20,4)) * 0.0125 END"),
    ("roi_currency", "CASE WHEN c_custkey % 3 = 0 THEN ' usd' END"),
    ("roi_percentage", "CASE WHEN c_custkey % 3 = 0 THEN CAST(c_acctbal AS DECIMAL(20,4)) * 1.25 END"),
]
_NUMERIC_RAW = {f.name for f in RAW_SNAPSHOT.fields if f.dataType == RAW_NUM}


def _raw_expr(name: str, sql: str) -> str:
    return f"CAST({sql} AS DECIMAL(38,18)) AS {name}" if name in _NUMERIC_RAW else f"{sql} AS {name}"


def raw_snapshot_from_customer(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        *[_raw_expr(n, s) for n, s in _RAW_FROM_CUSTOMER],
        "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE "
        "TIMESTAMP_NTZ '2024-01-31 00:00:00' + make_dt_interval(0, 0, 0, c_custkey) END AS last_updated",
        f"CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE TIMESTAMP_NTZ '{BATCH_TS}' END AS _ingested_at",
    )


def staged_snapshot_ctes() -> str:
    """DuckDB CTEs ``raw`` (snapshot dressed from customer) and ``markets``."""
    raw = ",\n    ".join(
        [_raw_expr(n, s) for n, s in _RAW_FROM_CUSTOMER]
        + ["CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE "
           "TIMESTAMP '2024-01-31 00:00:00' + to_seconds(c_custkey) END AS last_updated",
           f"CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE TIMESTAMP '{BATCH_TS}' END AS _ingested_at"])
    cols = []
    for dst, src, rule in SNAPSHOT_RULES:
        if rule == "text":
            e = f"TRIM(COALESCE(CAST({src} AS VARCHAR), 'Unknown'))"
        elif rule == "round":
            e = f"CAST(ROUND(CAST(COALESCE({src}, 0) AS DECIMAL(38,18)), 2) AS DECIMAL(38,2))"
        elif rule == "number":
            e = f"CAST(COALESCE({src}, 0) AS DECIMAL(38,18))"
        elif rule == "date":
            e = f"COALESCE(CAST({src} AS DATE), DATE '{AS_OF_DATE}')"
        else:
            e = f"COALESCE(CAST({src} AS TIMESTAMP), TIMESTAMP '{AS_OF_TS}')"
        cols.append(f"{e} AS {dst}")
    return (f"raw AS (\n  SELECT\n    {raw}\n  FROM customer\n),\nmarkets AS (\n  SELECT\n  "
            + ",\n  ".join(cols) + "\n  FROM raw\n)")


def staged_snapshot(customer: DataFrame) -> DataFrame:
    return standardise_snapshot(raw_snapshot_from_customer(customer), AS_OF_DATE, AS_OF_TS)


@register("standardise_snapshot", "WITH " + staged_snapshot_ctes() + "\nSELECT * FROM markets")
def standardise_snapshot_q(spark: SparkSession, sf: str) -> DataFrame:
    return staged_snapshot(table(spark, sf, "customer"))


# --- SRC-1 / PRJ-1 / FLT-1 / TOP-4 -----------------------------------------

def snapshot_payloads(customer: DataFrame, dressed: bool = True) -> DataFrame:
    """customer -> JSON list payloads of about 50 to 100 coins (50 ids, some twice).

    ``roi`` is an object, ``null`` or a string by id; ``high_24h`` is out of range for ids
    ``% 17 == 0``, ``low_24h`` no number for ids ``% 19 == 0``, and ``last_updated`` no
    date for ids ``% 23 == 0``; beside the real coins, ids
    ``% 31 == 0`` have a copy without id, ids ``% 25 == 0`` a second copy that
    differs, and there is an API error object for every tenth payload.  With
    ``dressed=False`` there are only the real coins.
    """
    c = customer.select(
        F.col("c_custkey").alias("k"),
        F.col("c_custkey").cast("string").alias("id"),
        F.lower(F.substring("c_mktsegment", 1, 3)).alias("symbol"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal").cast(PRICE_IN) * F.lit(Decimal("0.125"))).cast(RAW_NUM).alias("current_price"),
        (F.col("c_acctbal").cast(PRICE_IN) * 1000).cast(RAW_NUM).alias("market_cap"),
        F.date_format(F.date_add(F.lit("2021-11-10").cast("date"), F.col("c_nationkey")),
                      "yyyy-MM-dd'T'00:00:00.000'Z'").alias("ath_date"),
        F.date_format(F.timestamp_seconds(F.lit(1706659200) + F.col("c_custkey")),
                      "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("stamp"),
        (F.col("c_acctbal").cast(PRICE_IN) + 1).cast(RAW_NUM).cast("string").alias("high"),
        (F.col("c_acctbal").cast(PRICE_IN) - 1).cast(RAW_NUM).cast("string").alias("low"),
        F.to_json(F.struct((F.col("c_acctbal").cast(PRICE_IN) * F.lit(Decimal("0.0125"))).cast(RAW_NUM).alias("times"),
                           F.lit("usd").alias("currency"),
                           (F.col("c_acctbal").cast(PRICE_IN) * F.lit(Decimal("1.25"))).cast(RAW_NUM).alias("percentage")))
        .alias("roi_obj"),
    )
    roi = (F.when(_mod("k", 3) == 0, F.col("roi_obj"))
           .when(_mod("k", 3) == 1, F.lit("null")).otherwise(F.lit('"n/a"')))
    def odd(n: int, value: str, usual: str) -> Column:
        return F.when(F.lit(dressed) & (_mod("k", n) == 0), F.lit(value)).otherwise(F.col(usual))

    first = c.select("k", F.lit(0).alias("copy"), "id", "symbol", "name", "current_price",
                     "market_cap", "ath_date", odd(23, "yesterday", "stamp").alias("last_updated"), roi.alias("roi"),
                     odd(17, "1e21", "high").alias("high"), odd(19, '"n/a"', "low").alias("low"))
    again = (first.where(F.lit(dressed) & (_mod("k", 25) == 0))
             .withColumn("copy", F.lit(1))
             .withColumn("current_price", (F.col("current_price") * 2).cast(RAW_NUM)))
    blank = first.where(F.lit(dressed) & (_mod("k", 31) == 0)).withColumn("copy", F.lit(2)).withColumn("id", F.lit(""))
    coins = first.unionByName(again).unionByName(blank)
    body = F.to_json(F.struct("id", "symbol", "name", "current_price", "market_cap",
                              "ath_date", "last_updated"))
    text = F.concat(F.expr("substr(_body, 1, length(_body) - 1)"), F.lit(',"high_24h":'), F.col("high"),
                    F.lit(',"low_24h":'), F.col("low"), F.lit(',"roi":'), F.col("roi"), F.lit("}"))
    coins = coins.withColumn("_body", body).select(
        (F.col("k") - F.col("k") % 50).alias("chunk"), "k", "copy", text.alias("coin"))
    payloads = coins.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("k", "copy", "coin"))).alias("coins"))
    listing = F.concat(F.lit("["), F.array_join(F.transform("coins", lambda x: x["coin"]), ","),
                       F.lit("]"))
    errors = payloads.where(F.lit(dressed) & (((F.col("chunk") / 50).cast("long") % 10) == 9)).select(
        F.lit('{"error":"rate limited"}').alias("payload"),
        F.format_string("markets-%08d-error.json", F.col("chunk")).alias("source_file"))
    return payloads.select(
        listing.alias("payload"),
        F.format_string("markets-%08d.json", F.col("chunk")).alias("source_file"),
    ).unionByName(errors)


@register("struct_flatten", """
SELECT CAST(c_custkey AS VARCHAR) AS id, lower(substr(c_mktsegment, 1, 3)) AS symbol, c_name AS name,
  CAST(CAST(c_acctbal AS DECIMAL(20,4)) * 0.125 AS DECIMAL(38,18)) AS current_price,
  CAST(CAST(c_acctbal AS DECIMAL(20,4)) * 1000 AS DECIMAL(38,18)) AS market_cap,
  CASE WHEN c_custkey % 17 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(20,4)) + 1 AS DECIMAL(38,18)) END AS high_24h,
  CASE WHEN c_custkey % 19 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(20,4)) - 1 AS DECIMAL(38,18)) END AS low_24h,
  DATE '2021-11-10' + c_nationkey AS ath_date,
  CASE WHEN c_custkey % 23 <> 0 THEN TIMESTAMP '2024-01-31 00:00:00' + to_seconds(c_custkey) END AS last_updated,
  concat_ws(',', CASE WHEN c_custkey % 17 = 0 THEN 'high_24h' END, CASE WHEN c_custkey % 19 = 0 THEN 'low_24h' END,
            CASE WHEN c_custkey % 23 = 0 THEN 'last_updated' END) AS rejected,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(CAST(c_acctbal AS DECIMAL(20,4)) * 0.0125 AS DECIMAL(38,18)) END AS roi_times,
  CASE WHEN c_custkey % 3 = 0 THEN 'usd' END AS roi_currency,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(CAST(c_acctbal AS DECIMAL(20,4)) * 1.25 AS DECIMAL(38,18)) END AS roi_percentage,
  TIMESTAMP '2024-01-31 06:00:00' AS _ingested_at
FROM customer""")
def struct_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1 / PRJ-1 / FLT-1 / TOP-4: payload lists -> raw rows; numbers and dates that
    do not fit are NULL and named."""
    rows = snapshot_rows(snapshot_payloads(table(spark, sf, "customer")), BATCH_TS)
    return rows.select("id", "symbol", "name", "current_price", "market_cap", "high_24h", "low_24h", "ath_date", "last_updated",
                       F.array_join(F.coalesce("rejected_fields", F.array().cast("array<string>")), ",").alias("rejected"),
                       "roi_times", "roi_currency", "roi_percentage", "_ingested_at")


# --- SRC-2 with payloads as they come ----------------------------------------------------

def chart_payloads(events: DataFrame) -> DataFrame:
    """events -> one chart payload an asset: all its points, beside them a point out of
    range (assets ``% 3 == 0``, at the end) or a market cap that is no number (``% 3 == 1``,
    in front); and an error object for assets ``% 4 == 0``."""
    price = F.col("value").cast(PRICE_IN)
    cap = market_cap_of(F.col("props"))
    asset = F.col("user_id")
    points = events.select(asset, F.struct(
        "ts", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), price.cast(RAW_NUM).alias("price"),
        cap.cast(RAW_NUM).alias("cap"), (price * cap).cast(RAW_NUM).alias("vol")).alias("pt"))
    packed = points.groupBy("user_id").agg(F.array_sort(F.collect_list("pt")).alias("pts"))

    def series(field: str) -> Column:
        pairs = F.transform("pts", lambda x: F.concat(F.lit("["), x["ms"].cast("string"), F.lit(","), x[field].cast("string"), F.lit("]")))
        late = F.when(asset % 3 == 0, F.array(F.lit("[1893456000000,1e21]" if field == "price" else "[1893456000000,1]")))
        early = F.when(asset % 3 == 1, F.array(F.lit('[0,"n/a"]' if field == "cap" else "[0,1]")))
        none = F.array().cast("array<string>")
        listed = F.concat(F.coalesce(early, none), pairs, F.coalesce(late, none))
        return F.concat(F.lit("["), F.array_join(listed, ",\n  "), F.lit("]"))

    body = F.concat(F.lit('{\n "id": "'), asset.cast("string"), F.lit('",\n "chart_days": 90,\n "prices": '), series("price"),
                    F.lit(',\n "market_caps": '), series("cap"), F.lit(',\n "total_volumes": '), series("vol"), F.lit("\n}\n"))
    pretty = packed.where(asset % 5 == 0).select(body.alias("value"), F.lit("files").alias("landed_as"), asset)
    lines = packed.where(asset % 5 != 0).select(F.regexp_replace(body, "\n *", "").alias("value"), F.lit("lines").alias("landed_as"), asset)
    errors = packed.where(asset % 4 == 0).select(F.concat(F.lit('{"error":"rate limited","id":"'), asset.cast("string"), F.lit('"}')).alias("value"),
                                                 F.lit("lines").alias("landed_as"), asset)
    return pretty.unionByName(lines).unionByName(errors)


@register("chart_payloads", """
WITH p AS (
  SELECT user_id, CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS ms,
    CAST(CAST(value AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS price,
    CAST(CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS market_cap,
    CAST(CAST(value AS DECIMAL(20,4)) * CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS total_volume,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place,
    count(*) OVER (PARTITION BY user_id) AS n
  FROM events WHERE user_id IS NOT NULL
), assets AS (SELECT user_id, any_value(id) AS id, any_value(n) AS n FROM p GROUP BY user_id)
SELECT 'point' AS kind, id, place AS ordinality, ms, price, market_cap, total_volume,
       CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS VARCHAR) AS reason FROM p
UNION ALL
SELECT 'reject', id, 0, 0, NULL, NULL, NULL, 'prices[' || n || '][1]', '1.0E21', 'out of range' FROM assets WHERE user_id % 3 = 0
UNION ALL
SELECT 'reject', id, 0, 0, NULL, NULL, NULL, 'market_caps[0][1]', 'n/a', 'not a number' FROM assets WHERE user_id % 3 = 1
UNION ALL
SELECT 'reject', NULL, 0, 0, NULL, NULL, NULL, 'payload', '{"error":"rate limited","id":"' || id || '"}', 'no series'
FROM assets WHERE user_id % 4 = 0""")
def chart_payloads_q(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-2: pretty-printed response files, JSON lines and error objects, read from files:
    every real point comes out, every value that does not fit is a reject row."""
    payloads = chart_payloads(table(spark, sf, "events").where(F.col("user_id").isNotNull()))
    root = scratch_dir(spark, "chart_payloads")
    lines = payloads.where(F.col("landed_as") == "lines").select("value")
    lines.write.text(f"{root}/lines")
    # A file a payload, as fetched.
    payloads.where(F.col("landed_as") == "files").select("value", "user_id").repartition("user_id").write.partitionBy(
        "user_id").option("lineSep", "\n").text(f"{root}/files")
    read = read_payloads(spark, f"{root}/lines", whole_files=False).unionByName(read_payloads(spark, f"{root}/files"))
    parsed = stage(parse_charts(read, BATCH_TS, 90), "parsed-charts")
    points = unnest_series(sliced(accepted_charts(parsed))).select(
        F.lit("point").alias("kind"), F.col("coin_id").alias("id"), F.col("ordinality").cast("long").alias("ordinality"),
        F.col("price_ms").alias("ms"), "price", "market_cap", "total_volume")
    none = F.lit(0).cast("long")
    bad = rejects(parsed).select(F.lit("reject").alias("kind"), "id", none.alias("ordinality"), none.alias("ms"), "field", "raw", "reason")
    return points.unionByName(bad, allowMissingColumns=True)


# --- SRC-3 ------------------------------------------------------------------

@register("bridge_explode", f"""
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS coin_id, o_orderpriority AS category,
       TIMESTAMP '{BATCH_TS}' AS _ingested_at
FROM orders
WHERE o_orderpriority IS NOT NULL AND o_custkey IS NOT NULL""")
def bridge_explode(spark: SparkSession, sf: str) -> DataFrame:
    """orders -> ``{id, categories}`` payload per customer (priorities; ids
    ``% 9 == 0`` have a second payload with a NULL list) -> one row per (asset, category)."""
    orders = table(spark, sf, "orders").where(F.col("o_custkey").isNotNull())
    per_cust = (orders.select("o_custkey", "o_orderpriority").distinct()
                .groupBy("o_custkey")
                .agg(F.array_sort(F.collect_list("o_orderpriority")).alias("cats")))
    none = per_cust.where(_mod("o_custkey", 9) == 0).withColumn("cats", F.lit(None).cast("array<string>"))
    payload = per_cust.unionByName(none).select(F.to_json(F.struct(
        F.col("o_custkey").cast("string").alias("id"), F.col("cats").alias("categories"))).alias("payload"))
    return category_rows(payload, BATCH_TS)


# --- SRC-6 / SET-1 ------------------------------------------------------------

def universe_lines(customer: DataFrame) -> DataFrame:
    """customer -> comma lists of <= 16 ids per line; ids ``% 7 == 0`` follow a
    blank entry, ``% 5 == 0`` padded with spaces, ``% 11 == 0`` listed twice."""
    entry = (F.when(_mod("c_custkey", 7) == 0, F.concat(F.lit(" ,"), F.col("c_custkey").cast("string")))
             .when(_mod("c_custkey", 5) == 0, F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" ")))
             .when(_mod("c_custkey", 11) == 0, F.concat_ws(",", F.col("c_custkey").cast("string"),
                                                           F.col("c_custkey").cast("string")))
             .otherwise(F.col("c_custkey").cast("string")))
    lines = (customer.select("c_nationkey", (F.col("c_custkey") - F.col("c_custkey") % 16).alias("blk"),
                             "c_custkey", entry.alias("e"))
             .groupBy("c_nationkey", "blk")
             .agg(F.array_sort(F.collect_list(F.struct("c_custkey", "e"))).alias("es")))
    return lines.select(
        F.struct("c_nationkey", "blk").alias("line_no"),
        F.array_join(F.transform("es", lambda x: x["e"]), ",").alias("value"))


def _universe(spark: SparkSession, sf: str) -> DataFrame:
    return parse_universe(universe_lines(table(spark, sf, "customer")), order_col="line_no")


@register("universe_semi", """
SELECT event_id, user_id, ts, value FROM events
WHERE user_id IN (SELECT c_custkey FROM customer)""")
def universe_semi(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return restrict_to_universe(ev, _universe(spark, sf), key="user_id")


@register("missing_assets_anti", """
SELECT CAST(c_custkey AS VARCHAR) AS coin_id FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")
def missing_assets_anti(spark: SparkSession, sf: str) -> DataFrame:
    fetched = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("coin_id"))
    return missing_keys(_universe(spark, sf).select("coin_id"), fetched, "coin_id")


# --- TOP-2 / TOP-4 / TOP-3 ------------------------------------------------------

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@register("distinct_on_key", f"""
SELECT {_LI_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _LI_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def distinct_on_key(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-2: one row per (order, line): the latest ship date, ties by all columns."""
    return keep_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_ORDER)


@register("keep_first", f"""
SELECT {_LI_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _LI_ORDER)}) AS rn
  FROM lineitem WHERE l_orderkey IS NOT NULL) WHERE rn = 1""")
def keep_first_q(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-4 + FLT-1: rows without a key dropped, first row per key kept."""
    li = table(spark, sf, "lineitem").where(F.col("l_orderkey").isNotNull())
    return keep_first(li, ["l_orderkey", "l_linenumber"], _LI_ORDER)


@register("top_n_by_cap", """
SELECT c_custkey, c_name, c_acctbal FROM customer
ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 100""")
def top_n_by_cap(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return top_n(cust, SNAPSHOT_PAGE_SIZE,
                 [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc()])
