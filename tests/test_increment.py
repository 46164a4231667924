"""INC-1..3 over stored tables: ingest log, asset state, months."""

import datetime as dt
import random
from decimal import Decimal

from conftest import rows

from tickmart.operators.bars import daily_bars
from tickmart.operators.metrics import daily_metrics
from tickmart.operators.unnest import unnest_series
from tickmart.plans import asset_state as S
from tickmart.plans.incremental import SeriesTables, run_increment
from tickmart.schemas import RAW_SERIES
from tickmart.session import scratch_dir
from tickmart.sinks.ingest_log import batch_name
from tickmart.sinks.partitioned import read_partitioned


def ms(day, hour=12):
    at = dt.datetime(2024, 1, 1, hour, tzinfo=dt.timezone.utc) + dt.timedelta(days=day)
    return int(at.timestamp() * 1000)


def batch(spark, stamp, series):
    """series: {(coin, window): {day: price}}"""
    data = []
    for (coin, window), days in series.items():
        points = [[Decimal(ms(d, h)), Decimal(str(p)) + h] for d, p in sorted(days.items()) for h in (1, 20)]
        data.append((coin, window, points, points, points, dt.datetime.fromisoformat(stamp)))
    return spark.createDataFrame(data, RAW_SERIES)


def tables(spark):
    return SeriesTables(*(scratch_dir(spark, f"t_{n}") for n in ("raw", "bars", "metrics", "state", "merged", "pending")))


def assets(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B")], "name_id string, name_of_coin string")


def check(spark, t):
    bars = daily_bars(unnest_series(t.log(spark).read()))
    assert rows(read_partitioned(spark, t.bars)) == rows(bars)
    assert rows(read_partitioned(spark, t.metrics)) == rows(daily_metrics(bars, assets(spark)))
    key = ["coin_id", "max_ingested_at", "n_bars", "tail"]
    assert rows(S.read_state(spark, t.state), *key) == rows(S.state_of(bars), *key)


def test_increments_equal_the_full_refresh(spark):
    rnd = random.Random(7)
    t, a = tables(spark), assets(spark)

    def days(lo, hi, step=1):
        return {d: rnd.randint(1, 99) for d in range(lo, hi, step)}

    loads = [
        {("a", 1): days(0, 40), ("b", 1): days(0, 40, 3)},
        {("a", 2): days(40, 43), ("c", 1): days(0, 3)},              # appended days, a new asset
        {("a", 2): days(40, 44), ("b", 2): days(5, 8)},              # a window sent again; far back in time
        {("b", 3): days(39, 50), ("c", 2): days(30, 45)},            # gaps
        {("a", 1): days(0, 41), ("b", 1): days(0, 41, 3)},           # whole windows sent again
    ]
    for k, load in enumerate(loads):
        stamp = f"2024-03-{k + 1:02d} 06:00:00"
        t.log(spark).append(batch(spark, stamp, load), stamp)
        run_increment(spark, t, a)
        if k in (0, 2, 4):
            check(spark, t)
    before = rows(read_partitioned(spark, t.metrics))
    run_increment(spark, t, a)                                       # nothing new
    assert rows(read_partitioned(spark, t.metrics)) == before
    # Batch 2's only key of "a" came again: batches without a current row are gone.
    assert batch_name("2024-03-01 06:00:00") not in t.log(spark).batches()


def test_old_batches_and_months_are_not_opened(spark, monkeypatch):
    t, a = tables(spark), assets(spark)
    for k, stamp in enumerate(("2024-02-01 06:00:00", "2024-03-01 06:00:00", "2024-04-01 06:00:00")):
        t.log(spark).append(batch(spark, stamp, {("a", k): {30 * k + d: d + 1 for d in range(28)}}), stamp)
        if k < 2:
            run_increment(spark, t, a)
    log = t.log(spark)
    newest = batch_name("2024-04-01 06:00:00")
    assert log.overlapping(ms(60), ms(87)) == [newest] and log.overlapping(ms(29), ms(31))[0] == batch_name("2024-03-01 06:00:00")
    files = log.read([newest]).inputFiles()
    assert files and all(f"batch={newest}" in f for f in files)
    opened = []
    read = S.Months.read

    def watched(self, spark_, months=None):
        opened.append((self.path, sorted(months) if months is not None else None))
        return read(self, spark_, months)

    monkeypatch.setattr(S.Months, "read", watched)
    run_increment(spark, t, a)
    monkeypatch.undo()
    bars = [m for path, m in opened if path == t.bars]
    assert bars and all(m is not None and min(m) >= "2024-03" for m in bars)
    raw = [m for path, m in opened if path == t.raw]
    assert raw and all(m == [newest] for m in raw)
    check(spark, t)


def test_a_run_that_dies_between_bars_and_metrics_is_finished(spark, monkeypatch):
    import pytest

    t, a = tables(spark), assets(spark)
    for k, stamp in enumerate(("2024-02-01 06:00:00", "2024-03-01 06:00:00")):
        t.log(spark).append(batch(spark, stamp, {("a", k): {10 * k + d: d + 1 for d in range(12)}}), stamp)
        if k == 0:
            run_increment(spark, t, a)

    def boom(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(S, "recompute", boom)
    with pytest.raises(RuntimeError):
        run_increment(spark, t, a)
    monkeypatch.undo()
    run_increment(spark, t, a)
    check(spark, t)
