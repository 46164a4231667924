"""W-1, W-2, W-3, J-3: lag, 7-row average, change %."""

from conftest import D, d, rows

from tickmart.operators.metrics import daily_metrics

BARS = ("coin_id string, coin_date date, open_price decimal(20,2), close_price decimal(20,2), "
        "high_price decimal(20,2), low_price decimal(20,2), close_market_cap decimal(20,2), "
        "close_total_volume decimal(20,2)")


def bars(spark, coin, series):
    data = [(coin, d(day), D(c), D(c), D(c), D(c), D(1), D(1)) for day, c in series]
    return spark.createDataFrame(data, BARS)


def assets(spark, pairs):
    return spark.createDataFrame(pairs, "name_id string, name_of_coin string")


def test_lag_is_previous_row_and_change_rules(spark):
    b = bars(spark, "a", [("2024-01-01", "0"), ("2024-01-02", "5"), ("2024-01-06", "6"),
                          ("2024-01-07", "6.03")])
    m = daily_metrics(b, assets(spark, [("a", "Alpha")]))
    got = rows(m, "date_stamp", "prev_day_price", "daily_price_change_pcg")
    assert got == [
        (d("2024-01-01"), None, D("0.00")),          # first day: 0
        (d("2024-01-02"), D("0.00"), D("0.00")),     # previous 0 -> NULL -> 0
        (d("2024-01-06"), D("5.00"), D("20.00")),    # gap: previous row, not day
        (d("2024-01-07"), D("6.00"), D("0.50")),
    ]
    assert {r.name_of_coin for r in m.collect()} == {"Alpha"}


def test_moving_average_short_start_and_rounding(spark):
    closes = ["1", "2", "2", "2", "2", "2", "2", "0.01", "0.01"]
    b = bars(spark, "a", [(f"2024-01-{i + 1:02d}", c) for i, c in enumerate(closes)])
    got = [r.moving_avg_7d for r in daily_metrics(b, assets(spark, [])).orderBy("date_stamp").collect()]
    assert got[0] == D("1.00") and got[1] == D("1.50")      # shorter window at the start
    assert got[6] == D("1.86")                               # 13/7 = 1.857..
    assert got[7] == D("1.72")                               # (12 + 0.01)/7 = 1.7157..
    assert got[8] == D("1.43")                               # (10.02)/7 = 1.4314..


def test_change_half_up_both_signs_and_missing_master(spark):
    # +0.125 % and -0.125 % round away from zero; sub-cent prices round to 0.00
    b = bars(spark, "x", [("2024-01-01", "80"), ("2024-01-02", "80.10"), ("2024-01-03", "80")])
    m = daily_metrics(b, assets(spark, [("other", "Other")]))
    got = [(r.daily_price_change_pcg, r.name_of_coin) for r in m.orderBy("date_stamp").collect()]
    assert got == [(D("0.00"), None), (D("0.13"), None), (D("-0.12"), None)]


def test_one_window_exchange(spark):
    b = bars(spark, "a", [("2024-01-01", "1"), ("2024-01-02", "2")])
    plan = daily_metrics(b, assets(spark, [("a", "A")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 or plan.count("Window") >= 1
    assert "CartesianProduct" not in plan


def test_sub_cent_prices_round_to_zero_then_change_is_zero(spark):
    # a sub-cent asset: bars round 0.004 to 0.00, so the next change divides
    # by 0 -> NULL -> 0 (the source's documented behaviour, D-9)
    b = bars(spark, "s", [("2024-01-01", "0.00"), ("2024-01-02", "0.01"), ("2024-01-03", "0.02")])
    got = [(r.prev_day_price, r.daily_price_change_pcg)
           for r in daily_metrics(b, assets(spark, [])).orderBy("date_stamp").collect()]
    assert got == [(None, D("0.00")), (D("0.00"), D("0.00")), (D("0.01"), D("100.00"))]
