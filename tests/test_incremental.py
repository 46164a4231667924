"""INC-1..3, FLT-2, FLT-3, J-1, A-4, A-7: incremental refresh == full refresh."""

from datetime import datetime, timezone
from decimal import Decimal

from conftest import rows
from hypothesis import given, settings, strategies as st

from tickmart.plans.incremental import new_raw_rows, refresh_bars, refresh_metrics
from tickmart.schemas import RAW_SERIES
from tickmart.sinks.upsert import upsert

KEYS = ["coin_id", "chart_days"]


def ms(day: int, hour: int = 12) -> int:
    return int(datetime(2024, 1, day, hour, tzinfo=timezone.utc).timestamp() * 1000)


def raw_rows(spark, stamp, series):
    """series: {(coin, window): [(day, hour, price), ...]}"""
    data = []
    for (coin, window), pts in series.items():
        pts = sorted(pts)
        prices = [[Decimal(ms(dd, h)), Decimal(str(p))] for dd, h, p in pts]
        caps = [[Decimal(ms(dd, h)), Decimal(str(p)) * 10] for dd, h, p in pts]
        data.append((coin, window, prices, caps, caps, datetime.fromisoformat(stamp)))
    return spark.createDataFrame(data, RAW_SERIES)


def materialise(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def assets(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "name_id string, name_of_coin string")


def run(spark, loads):
    raw = bars = metrics = None
    for stamp, series in loads:
        batch = raw_rows(spark, stamp, series)
        raw = materialise(spark, batch if raw is None else upsert(raw, batch, KEYS))
        new_bars, changed = refresh_bars(raw, bars)
        bars, changed = materialise(spark, new_bars), materialise(spark, changed)
        new_metrics, _ = refresh_metrics(bars, changed, metrics, assets(spark))
        metrics = materialise(spark, new_metrics)
    full_bars, _ = refresh_bars(raw, None)
    full_metrics, _ = refresh_metrics(full_bars, None, None, assets(spark))
    return bars, metrics, full_bars, full_metrics


def days(coin_days, price=lambda dd: 10 + dd):
    return [(dd, h, price(dd)) for dd in coin_days for h in (1, 20)]


def test_late_lagging_corrected_and_repeated(spark):
    l1 = {("a", 1): days(range(1, 11)), ("b", 1): days(range(1, 6))}
    l2 = {("a", 1): days(range(1, 13), lambda dd: 99 if dd == 3 else 10 + dd),   # corrects day 3
          ("c", 1): days(range(1, 13))}                                          # late asset
    l3 = {("b", 1): days(range(1, 13))}                                          # lagging asset
    loads = [("2024-01-10 06:00:00", l1), ("2024-01-12 06:00:00", l2),
             ("2024-01-13 06:00:00", l3), ("2024-01-13 06:00:00", l3)]
    bars, metrics, fb, fm = run(spark, loads)
    assert rows(bars) == rows(fb)
    assert rows(metrics) == rows(fm)
    assert metrics.count() == 36


def test_only_new_rows_are_reprocessed(spark):
    raw1 = raw_rows(spark, "2024-01-10 06:00:00", {("a", 1): days([1, 2]), ("b", 1): days([1])})
    bars, _ = refresh_bars(raw1, None)
    bars = materialise(spark, bars)
    raw2 = upsert(raw1, raw_rows(spark, "2024-01-11 06:00:00", {("a", 1): days([1, 2, 3])}), KEYS)
    assert [r.coin_id for r in new_raw_rows(raw2, bars).collect()] == ["a"]
    _, changed = refresh_bars(raw2, bars)
    assert sorted(r.coin_id for r in changed.collect()) == ["a", "a", "a"]
    _, again = refresh_bars(raw1, bars)            # same batch again: nothing to do
    assert again.count() == 0


def test_trailing_mode_is_the_source_bound(spark):
    l1 = {("a", 1): days(range(1, 20))}
    l2 = {("a", 1): days(range(1, 21), lambda dd: 5 if dd == 19 else 10 + dd)}
    raw = materialise(spark, raw_rows(spark, "2024-01-20 06:00:00", l1))
    bars, _ = refresh_bars(raw, None)
    bars = materialise(spark, bars)
    metrics, _ = refresh_metrics(bars, None, None, assets(spark))
    metrics = materialise(spark, metrics)
    raw = materialise(spark, upsert(raw, raw_rows(spark, "2024-01-21 06:00:00", l2), KEYS))
    nb, changed = refresh_bars(raw, bars)
    nb = materialise(spark, nb)
    nm, recomputed = refresh_metrics(nb, changed, metrics, assets(spark), mode="trailing")
    full, _ = refresh_metrics(nb, None, None, assets(spark))
    assert rows(nm) == rows(full)
    assert min(r.date_stamp for r in recomputed.collect()).day == 13   # max(19) - 6 days


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 14), st.integers(0, 23),
                          st.integers(0, 50)), min_size=1, max_size=30),
       st.integers(2, 13), st.integers(2, 13))
def test_random_slicing_equals_full_refresh(spark, points, cut1, cut2):
    cuts = sorted({cut1, cut2, 15})
    pts = {}
    for coin, dd, h, p in points:
        pts[(coin, dd, h)] = p
    loads, prev = [], None
    for i, cut in enumerate(cuts):
        series = {}
        for (coin, dd, h), p in pts.items():
            if dd < cut:
                series.setdefault((coin, dd // 5), []).append((dd, h, p))
        changed = {k: v for k, v in series.items()
                   if prev is None or any(dd >= prev for dd, _, _ in v)}
        if changed:
            loads.append((f"2024-02-0{i + 1} 06:00:00", changed))
        prev = cut
    bars, metrics, fb, fm = run(spark, loads)
    assert rows(bars) == rows(fb)
    assert rows(metrics) == rows(fm)


def test_protect_boundary_keeps_stored_first_day(spark):
    # day 3 stored complete; the re-sent window starts at 20:00 on day 3
    l1 = {("a", 90): [(3, 1, 10), (3, 20, 12), (4, 1, 13)]}
    l2 = {("a", 90): [(3, 20, 99), (4, 1, 14), (5, 1, 15)]}
    raw = materialise(spark, raw_rows(spark, "2024-01-05 06:00:00", l1))
    bars, _ = refresh_bars(raw, None)
    bars = materialise(spark, bars)
    raw2 = materialise(spark, upsert(raw, raw_rows(spark, "2024-01-06 06:00:00", l2), KEYS))
    plain, _ = refresh_bars(raw2, bars)
    kept, changed = refresh_bars(raw2, bars, protect_boundary=True)
    day3 = lambda df: [r for r in df.collect() if r.coin_date.day == 3][0]
    assert day3(plain).open_price == Decimal("99.00")        # last writer wins by default
    assert day3(kept).open_price == Decimal("10.00")         # stored full day kept
    assert sorted(r.coin_date.day for r in changed.collect()) == [4, 5]


def test_raw_arrays_are_not_shuffled_to_the_high_water_marks(spark):
    raw = spark.sql("""SELECT CAST(id % 50 AS STRING) AS coin_id, array(array(id, id)) AS prices,
                       TIMESTAMP_NTZ '2024-01-02 00:00:00' AS _ingested_at FROM range(1000)""")
    bars = spark.sql("SELECT CAST(id AS STRING) AS coin_id, TIMESTAMP_NTZ '2024-01-03 00:00:00' AS _ingested_at "
                     "FROM range(40)")
    fresh = new_raw_rows(raw, bars)
    assert "Exchange hashpartitioning" not in fresh._jdf.queryExecution().executedPlan().toString()
    assert fresh.count() == 200
