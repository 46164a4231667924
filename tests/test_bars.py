"""A-1, A-2, A-3, TOP-1, PRJ-6: daily bars from price points."""

from conftest import D, d, rows, ts

from pyspark.sql import functions as F

from tickmart.functions import epoch_ms_to_seconds, epoch_ms_to_utc_date, epoch_ms_to_utc_ts
from tickmart.functions import event_order
from tickmart.operators.bars import close_of_day, daily_bars, first_seen, high_water

SCHEMA = "coin_id string, price_ts timestamp_ntz, seq long, price decimal(38,18), " \
         "market_cap decimal(38,18), total_volume decimal(38,18), _ingested_at timestamp_ntz"


def points(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumn("point_order", event_order(F.col("price_ts"), F.col("seq")))


def test_open_close_high_low_and_day_boundaries(spark):
    i1, i2 = ts("2024-01-02 01:00:00"), ts("2024-01-02 02:00:00")
    data = [
        ("btc", ts("2024-01-01 00:00:00"), 1, D("10.004"), D(100), D(1), i1),
        ("btc", ts("2024-01-01 12:00:00"), 2, D("12.5"), D(120), D(2), i1),
        ("btc", ts("2024-01-01 23:59:59.999"), 3, D("11.005"), D(110), D(3), i2),
        ("btc", ts("2024-01-02 00:00:00"), 4, D("9"), D(90), D(4), i2),   # next UTC day
        ("eth", ts("2024-01-01 05:00:00"), 5, D("1"), D(7), D(8), i1),   # single point
    ]
    out = daily_bars(points(spark, data))
    got = {(r.coin_id, r.coin_date): r for r in out.collect()}
    b = got[("btc", d("2024-01-01"))]
    assert (b.open_price, b.close_price, b.high_price, b.low_price) == (
        D("10.00"), D("11.01"), D("12.50"), D("10.00"))
    assert (b.close_market_cap, b.close_total_volume) == (D("110.00"), D("3.00"))
    assert b._ingested_at == i2
    b2 = got[("btc", d("2024-01-02"))]
    assert b2.open_price == b2.close_price == D("9.00")
    e = got[("eth", d("2024-01-01"))]
    assert e.open_price == e.close_price == e.high_price == e.low_price == D("1.00")
    assert out.count() == 3


def test_same_second_tie_and_null_first_point(spark):
    t = ts("2024-01-01 10:00:00")
    data = [
        ("a", t, 2, D(5), D(1), D(1), t),
        ("a", t, 1, None, D(2), D(2), t),      # NULL price at the earliest point
        ("a", ts("2024-01-01 09:00:00"), 0, None, D(3), D(3), t),
        ("a", t, 3, D(7), D(4), D(4), t),      # same ts, later tie-break -> close
    ]
    b = daily_bars(points(spark, data)).collect()[0]
    assert b.open_price is None                # NULL at the extreme is kept
    assert b.close_price == D("7.00") and b.close_market_cap == D("4.00")
    assert (b.high_price, b.low_price) == (D("7.00"), D("5.00"))  # NULLs ignored


def test_rounding_half_away_from_zero_and_scale(spark):
    data = [("a", ts("2024-01-01 00:00:00"), 1, D("-0.005"), D("0.005"), D("2.675"), ts("2024-01-01 01:00:00"))]
    b = daily_bars(points(spark, data)).collect()[0]
    assert b.open_price == D("-0.01") and b.close_market_cap == D("0.01")
    assert b.close_total_volume == D("2.68")
    b4 = daily_bars(points(spark, data), price_scale=4).collect()[0]
    assert b4.open_price == D("-0.0050")


def test_close_of_day_first_seen_high_water(spark):
    i1, i2 = ts("2024-01-03 00:00:00"), ts("2024-01-04 00:00:00")
    data = [("a", ts("2024-01-01 01:00:00"), 1, D(1), D(10), D(5), i1),
            ("a", ts("2024-01-02 01:00:00"), 2, D(2), D(20), D(6), i2)]
    pts = points(spark, data)
    c = rows(close_of_day(pts), "coin_date", "close_market_cap", "close_total_volume")
    assert c == [(d("2024-01-01"), D("10.00"), D("5.00")), (d("2024-01-02"), D("20.00"), D("6.00"))]
    bars = daily_bars(pts)
    assert rows(first_seen(bars)) == [("a", d("2024-01-01"))]
    assert rows(high_water(bars)) == [("a", i2)]


def test_epoch_ms_to_utc(spark):
    df = spark.createDataFrame([(1704153599999,), (1704153600000,), (-1500,)], "ms long")
    out = df.select("ms", epoch_ms_to_seconds(F.col("ms")).alias("s"),
                    epoch_ms_to_utc_ts(F.col("ms")).alias("t"),
                    epoch_ms_to_utc_date(F.col("ms")).alias("d")).collect()
    got = {r.ms: (r.s, r.t, r.d) for r in out}
    assert got[1704153599999] == (1704153599, ts("2024-01-01 23:59:59"), d("2024-01-01"))
    assert got[1704153600000] == (1704153600, ts("2024-01-02 00:00:00"), d("2024-01-02"))
    assert got[-1500][0] == -1                  # truncates toward zero like bigint / 1000


def test_bars_plan_is_hash_aggregate_with_partial_combine(spark):
    from tickmart.sources.driver_tables import price_points, table
    from conftest import SF
    plan = daily_bars(price_points(table(spark, SF, "events")))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SortAggregate" not in plan
    assert plan.count("HashAggregate") >= 2     # partial + final


def test_sub_cent_price_rounds_to_zero(spark):
    data = [("a", ts("2024-01-01 00:00:00"), 1, D("0.004"), D("0.004"), D("0.004"), ts("2024-01-01 01:00:00"))]
    b = daily_bars(points(spark, data)).collect()[0]
    assert b.open_price == D("0.00") and b.close_price == D("0.00")


def test_hot_asset_matches_brute_force(spark):
    """One asset holds a third of all points; bars equal a pandas brute force."""
    import pandas as pd

    n = 30_000
    pts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("coin"),
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 7919) % (5 * 86400)).alias("t"),
        ((F.col("id") * 31) % 1000 / 8).cast("decimal(38,18)").alias("p"))
    df = pts.select(F.col("coin").cast("string").alias("coin_id"),
                    F.col("t").cast("timestamp_ntz").alias("price_ts"), "seq",
                    F.col("p").alias("price"), F.col("p").alias("market_cap"),
                    F.col("p").alias("total_volume"),
                    F.col("t").cast("timestamp_ntz").alias("_ingested_at"))
    got = daily_bars(df.withColumn("point_order", event_order(F.col("price_ts"), F.col("seq"))))
    pdf = df.toPandas()
    pdf["day"] = pdf.price_ts.dt.date
    pdf = pdf.sort_values(["price_ts", "seq"])
    g = pdf.groupby(["coin_id", "day"])
    want = pd.DataFrame({"open": g.price.first(), "close": g.price.last(),
                         "high": g.price.max(), "low": g.price.min()}).reset_index()
    q = D("0.01")
    expect = sorted((r.coin_id, r.day, *(x.quantize(q, rounding="ROUND_HALF_UP")
                                         for x in (r.open, r.close, r.high, r.low)))
                    for r in want.itertuples())
    assert rows(got, "coin_id", "coin_date", "open_price", "close_price", "high_price",
                "low_price") == expect
    assert len(expect) == got.count()


def test_a_position_beyond_the_order_key_raises(spark):
    import pytest
    from pyspark.sql import functions as F

    from tickmart.functions import payload_order

    def orders(position):
        return spark.range(1).select(payload_order(
            F.lit(5), F.lit("2024-01-01").cast("timestamp_ntz"), F.lit(position)).alias("o")).collect()

    assert orders(10**7 - 1)[0].o is not None and orders(None)[0].o is None
    with pytest.raises(Exception, match="order key"):
        orders(10**7)
