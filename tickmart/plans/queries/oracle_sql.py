"""DuckDB building blocks for the oracle SQL (plain SQL over the parquet views).

DuckDB divides and averages decimals in DOUBLE, so every such value is cast
to ``DECIMAL(38,10)`` before rounding; outputs are cast to the same fixed
types the Spark side produces.
"""

POINTS = """
pts AS (
  SELECT user_id AS coin_id, ts, event_id,
         CAST(value AS DECIMAL(20,4)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4)) AS market_cap,
         CAST(value AS DECIMAL(20,4))
           * CAST(json_extract_string(props, '$.k') AS DECIMAL(20,4)) AS total_volume,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS _ingested_at
  FROM events
)"""

BARS = """
bars AS (
  SELECT coin_id, CAST(ts AS DATE) AS coin_date,
    CAST(ROUND((array_agg(price ORDER BY ts, event_id))[1], 2) AS DECIMAL(20,2)) AS open_price,
    CAST(ROUND((array_agg(price ORDER BY ts DESC, event_id DESC))[1], 2) AS DECIMAL(20,2)) AS close_price,
    CAST(ROUND(MAX(price), 2) AS DECIMAL(20,2)) AS high_price,
    CAST(ROUND(MIN(price), 2) AS DECIMAL(20,2)) AS low_price,
    CAST(ROUND((array_agg(market_cap ORDER BY ts DESC, event_id DESC))[1], 2) AS DECIMAL(20,2)) AS close_market_cap,
    CAST(ROUND((array_agg(total_volume ORDER BY ts DESC, event_id DESC))[1], 2) AS DECIMAL(20,2)) AS close_total_volume,
    MAX(_ingested_at) AS _ingested_at
  FROM pts
  GROUP BY coin_id, CAST(ts AS DATE)
)"""

ASSETS = """
assets AS (
  SELECT c_custkey AS name_id, TRIM(COALESCE(c_name, 'Unknown')) AS name_of_coin
  FROM customer
)"""

# Days are numbered per coin; the day before and the last seven are joined by number.
METRICS = """
day_no AS (
  SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY coin_date) AS day FROM bars
),
week AS (
  SELECT x.coin_id, x.day, AVG(y.close_price) AS mean
  FROM day_no x JOIN day_no y
    ON y.coin_id IS NOT DISTINCT FROM x.coin_id AND y.day BETWEEN x.day - 6 AND x.day
  GROUP BY x.coin_id, x.day
),
metrics AS (
  SELECT d.coin_id, assets.name_of_coin, d.coin_date AS date_stamp, d.open_price, d.high_price,
    d.low_price, d.close_price, d.close_market_cap, d.close_total_volume,
    y.close_price AS prev_day_price,
    CAST(CASE WHEN y.close_price <> 0
      THEN ROUND(CAST((d.close_price - y.close_price) / y.close_price * 100 AS DECIMAL(38,10)), 2)
      ELSE 0 END AS DECIMAL(20,2)) AS daily_price_change_pcg,
    CAST(ROUND(CAST(week.mean AS DECIMAL(38,10)), 2) AS DECIMAL(20,2)) AS moving_avg_7d
  FROM day_no d
  JOIN week ON week.coin_id IS NOT DISTINCT FROM d.coin_id AND week.day = d.day
  LEFT JOIN day_no y ON y.coin_id IS NOT DISTINCT FROM d.coin_id AND y.day = d.day - 1
  LEFT JOIN assets ON assets.name_id = d.coin_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)

CATEGORY_BATCH_TS = "2024-01-31 06:00:00"

SUMMARY = """
summary AS (
  SELECT date_stamp,
    CAST(SUM(close_market_cap) AS DECIMAL(38,2)) AS total_market_cap,
    first(coin_id ORDER BY daily_price_change_pcg DESC, coin_id)
      FILTER (WHERE daily_price_change_pcg IS NOT NULL) AS top_gainer,
    first(coin_id ORDER BY daily_price_change_pcg, coin_id)
      FILTER (WHERE daily_price_change_pcg IS NOT NULL) AS top_loser,
    CAST(CAST(AVG(close_total_volume) AS DECIMAL(38,10)) AS DECIMAL(38,6)) AS average_volume
  FROM metrics GROUP BY ALL
)"""

CATEGORIES = f"""
categories AS (
  SELECT c_custkey AS coin_id, TRIM(c_mktsegment) AS category,
         TIMESTAMP '{CATEGORY_BATCH_TS}' AS _ingested_at
  FROM customer WHERE c_mktsegment IS NOT NULL
),
category_metrics AS (
  SELECT c.coin_id, c.category, m.name_of_coin, m.prev_day_price, m.daily_price_change_pcg,
         m.moving_avg_7d, c._ingested_at AS category_ingested_at, m.date_stamp
  FROM categories c LEFT JOIN metrics m ON c.coin_id = m.coin_id
)"""

# Distinct pairs with look-ups; a coin without bars has no name and no first day.
DIMENSION = """
dim AS (
  SELECT pair.coin_id, CASE WHEN seen.coin_id IS NOT NULL THEN assets.name_of_coin END AS coin_name,
    TRIM(COALESCE(nation.n_name, 'Unknown')) AS symbol, pair.category, seen.first_seen_date
  FROM (SELECT DISTINCT coin_id, category FROM categories) AS pair
  JOIN customer ON customer.c_custkey = pair.coin_id
  LEFT JOIN nation ON nation.n_nationkey = customer.c_nationkey
  LEFT JOIN assets ON assets.name_id = pair.coin_id
  LEFT JOIN (SELECT coin_id, MIN(coin_date) AS first_seen_date FROM bars GROUP BY coin_id) AS seen
    ON seen.coin_id = pair.coin_id
)"""

FACT = """
fact AS (
  SELECT coin_id, name_of_coin, date_stamp AS trade_date, open_price AS open_price_usd,
         high_price AS high_price_usd, low_price AS low_price_usd, close_price AS close_price_usd,
         close_total_volume AS volume, close_market_cap AS market_cap,
         daily_price_change_pcg AS daily_price_change_pct, moving_avg_7d AS moving_avg_7d_price
  FROM metrics
)"""
