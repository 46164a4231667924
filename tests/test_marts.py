"""J-3..J-5, A-5, A-6, A-9, W-4..W-6: category metrics, dimension, summary."""

from conftest import D, d, rows, ts
from hypothesis import given, settings, strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickmart.operators.ranking import daily_ranks
from tickmart.plans import models as M

MET = ("coin_id string, name_of_coin string, date_stamp date, close_market_cap decimal(20,2), "
       "close_total_volume decimal(20,2), daily_price_change_pcg decimal(20,2), "
       "prev_day_price decimal(20,2), moving_avg_7d decimal(20,2)")


def metrics(spark, data):
    return spark.createDataFrame(
        [(c, c.upper(), d(day), D(cap), D(vol), None if p is None else D(p), None, None)
         for c, day, cap, vol, p in data], MET)


def test_summary_ties_single_asset_and_null_day(spark):
    m = metrics(spark, [
        ("b", "2024-01-01", 10, 1, "5"), ("a", "2024-01-01", 20, 2, "5"),   # gainer tie -> a
        ("c", "2024-01-01", 30, 4, "-1"), ("d", "2024-01-01", 40, 8, "-1"),  # loser tie -> c
        ("a", "2024-01-02", 7, 3, "2"),                                      # one asset
        ("a", "2024-01-03", 5, 5, None), ("b", "2024-01-03", 6, 6, None),   # only NULL change
    ])
    got = {r.date_stamp: r for r in M.market_summary(m).collect()}
    r1 = got[d("2024-01-01")]
    assert (r1.total_market_cap, r1.top_gainer, r1.top_loser) == (D(100), "a", "c")
    assert r1.average_volume == D("3.750000")
    assert (got[d("2024-01-02")].top_gainer, got[d("2024-01-02")].top_loser) == ("a", "a")
    assert (got[d("2024-01-03")].top_gainer, got[d("2024-01-03")].top_loser) == (None, None)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(1, 3), st.integers(-3, 3)),
                min_size=1, max_size=25))
def test_summary_fold_equals_ranked_form(spark, data):
    dedup = {(c, day): p for c, day, p in data}
    m = metrics(spark, [(c, f"2024-01-0{day}", 1, 1, str(p)) for (c, day), p in dedup.items()])
    fold = {r.date_stamp: (r.top_gainer, r.top_loser) for r in M.market_summary(m).collect()}
    g = daily_ranks(m, True, "rg").where("rg = 1")
    lo = daily_ranks(m, False, "rl").where("rl = 1")
    ranked = {r.date_stamp: (r.g, r.l) for r in g.select("date_stamp", F.col("coin_id").alias("g"))
              .join(lo.select("date_stamp", F.col("coin_id").alias("l")), "date_stamp").collect()}
    assert fold == ranked


def test_category_metrics_fan_out_and_missing_history(spark):
    m = metrics(spark, [("a", "2024-01-01", 1, 1, "0"), ("a", "2024-01-02", 1, 1, "1")])
    cats = spark.createDataFrame([("a", "L1", ts("2024-01-05 00:00:00")), ("a", "DeFi", ts("2024-01-05 00:00:00")),
                                  ("z", "Meme", ts("2024-01-05 00:00:00"))],
                                 "coin_id string, category string, _ingested_at timestamp_ntz")
    out = M.category_metrics(cats, m)
    assert out.count() == 5                               # 2 categories x 2 days + 1 NULL row
    z = out.where("coin_id = 'z'").collect()[0]
    assert z.date_stamp is None and z.name_of_coin is None and z.category == "Meme"


def test_asset_dimension_matches_fan_out_form(spark):
    cats = spark.createDataFrame([("a", "L1"), ("a", "DeFi"), ("a", "L1"), ("z", "Meme"), ("q", "X")],
                                 "coin_id string, category string")
    assets = spark.createDataFrame([("a", "Alpha", "AA"), ("z", "Zed", "ZZ")],
                                   "name_id string, name_of_coin string, symbol_name string")
    bars = spark.createDataFrame([("a", d("2024-01-03")), ("a", d("2024-01-01"))],
                                 "coin_id string, coin_date date")
    out = rows(M.asset_dimension(cats, assets, bars))
    assert out == [("a", "Alpha", "AA", "DeFi", d("2024-01-01")),
                   ("a", "Alpha", "AA", "L1", d("2024-01-01")),
                   ("q", None, None, "X", None),
                   ("z", None, "ZZ", "Meme", None)]       # no history -> no name, as in the source
    # the source's form: fan out x days, then row_number = 1
    fan = (cats.join(bars, "coin_id", "left")
           .join(assets.withColumnRenamed("name_id", "coin_id"), "coin_id", "left")
           .withColumn("name", F.when(F.col("coin_date").isNotNull(), F.col("name_of_coin")))
           .withColumn("first", F.min("coin_date").over(Window.partitionBy("coin_id")))
           .withColumn("rn", F.row_number().over(Window.partitionBy("coin_id", "category")
                                                 .orderBy("symbol_name", "coin_date")))
           .where("rn = 1").select("coin_id", "name", "symbol_name", "category", "first"))
    assert rows(fan) == out


def test_daily_fact_renames(spark):
    m = metrics(spark, [("a", "2024-01-01", 1, 1, "0")])
    m = m.select("*", *[F.lit(None).cast("decimal(20,2)").alias(c) for c in
                        ("open_price", "high_price", "low_price", "close_price")])
    assert M.daily_fact(m).columns == list(M.FACT_COLUMNS.values())


def test_ranks_over_range_parts_equal_one_window(spark):
    m = spark.sql("""SELECT id AS coin_id, CASE WHEN id % 7 < 5 THEN DATE '2024-01-01' WHEN id % 7 = 5
                     THEN DATE '2024-01-02' END AS date_stamp,
                     CASE WHEN id % 11 > 0 THEN id % 13 END AS daily_price_change_pcg FROM range(2000)""")
    for descending, order in ((True, "DESC"), (False, "ASC")):
        m.createOrReplaceTempView("m_ranks")
        want = spark.sql(f"""SELECT coin_id, date_stamp, daily_price_change_pcg, row_number() OVER (
            PARTITION BY date_stamp ORDER BY daily_price_change_pcg {order}, coin_id) AS r
            FROM m_ranks WHERE daily_price_change_pcg IS NOT NULL""")
        got = daily_ranks(m.repartition(4), descending, "r").select(want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
