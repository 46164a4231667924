"""JOB-1: the daily job on hand-written landed payloads."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows

from tickmart.operators.quality import QualityGateError
from tickmart.plans.daily_job import JobConfig, run_daily_job, table_path
from tickmart.sinks.history import read_history
from tickmart.sinks.partitioned import read_partitioned
from tickmart.sinks.tables import read_table


def ms(day, hour):
    """Hour of a day counted from 2024-01-01 (day 1)."""
    return int((datetime(2024, 1, 1, hour, tzinfo=timezone.utc) + timedelta(days=day - 1)).timestamp() * 1000)


def land(root, days, cap_sign=1):
    (root / "universe").mkdir(parents=True)
    (root / "universe" / "ids.txt").write_text(" BTC, eth ,sol,\n")
    (root / "markets").mkdir()
    coins = [{"id": c, "symbol": c, "name": c.title(), "current_price": 1,
              "last_updated": "2024-01-10T00:00:00.000Z"} for c in ("btc", "eth", "sol")]
    (root / "markets" / "page1.json").write_text(json.dumps(coins, indent=1))
    (root / "charts").mkdir()
    lines = []
    for i, c in enumerate(("btc", "eth", "sol")):
        pts = [(d, h) for d in days for h in (2, 14)]
        lines.append(json.dumps({
            "id": c, "chart_days": 90,
            "prices": [[ms(d, h), 10 * (i + 1) + d + h / 100] for d, h in pts],
            "market_caps": [[ms(d, h), cap_sign * 1000 * (i + 1)] for d, h in pts],
            "total_volumes": [[ms(d, h), 50 + d] for d, h in pts]}))
    (root / "charts" / "part-0.jsonl").write_text("\n".join(lines) + "\n")
    (root / "categories").mkdir()
    (root / "categories" / "part-0.jsonl").write_text(
        '{"id":"btc","categories":["L1"]}\n{"id":"eth","categories":["L1","Smart Contract"]}\n'
        '{"id":"sol","categories":null}\n{"id":"doge","categories":["Meme"]}\n')


def test_two_daily_runs_and_gate(spark, tmp_path):
    wh = str(tmp_path / "warehouse")
    land(tmp_path / "d1", [1, 2, 3])
    land(tmp_path / "d2", [1, 2, 3, 4, 5])
    r1 = run_daily_job(spark, JobConfig(str(tmp_path / "d1"), wh, "2024-01-04 06:00:00", "2024-01-04 08:00:00"))
    assert r1.loads["coins_categories"].batch_rows == 3        # doge is outside the universe
    cfg = JobConfig(str(tmp_path / "d2"), wh, "2024-01-06 06:00:00", "2024-01-06 08:00:00")
    run_daily_job(spark, cfg)
    fact = read_partitioned(spark, table_path(cfg, "fct_daily_coin_performance"))
    assert fact.count() == 15
    bars = read_partitioned(spark, table_path(cfg, "stg_coin_price_history"))
    btc = rows(bars.where("coin_id = 'btc'"), "coin_date", "open_price", "close_price")
    assert [b[0].day for b in btc] == [1, 2, 3, 4, 5]
    assert (str(btc[0][1]), str(btc[0][2])) == ("11.02", "11.14")
    report = read_table(spark, table_path(cfg, "quality_report"))
    assert {r.status for r in report.collect()} <= {"pass", "warn"}
    dim = rows(read_table(spark, table_path(cfg, "dim_coins")), "coin_id", "category", "coin_name")
    assert dim == [("btc", "L1", "Btc"), ("eth", "L1", "Eth"), ("eth", "Smart Contract", "Eth")]
    fresh = {r.source_name: r.status for r in read_table(spark, table_path(cfg, "source_freshness")).collect()}
    assert fresh == {"coin_markets": "pass", "coin_price_history": "pass", "coins_categories": "pass"}
    hist = read_history(spark, table_path(cfg, "dim_coins_snapshot"))
    assert hist.count() == 3 and {r.is_current for r in hist.collect()} == {True}
    summary = read_table(spark, table_path(cfg, "fct_market_summary"))
    assert summary.count() == 5
    audit = rows(read_table(spark, table_path(cfg, "load_audit")), "batch_ts", "table_name",
                 "batch_rows", "skipped")
    assert len(audit) == 6 and audit[0][1:] == ("coin_markets", 3, False)

    land(tmp_path / "bad", [6], cap_sign=-1)
    with pytest.raises(QualityGateError, match="non_negative"):
        run_daily_job(spark, JobConfig(str(tmp_path / "bad"), wh, "2024-01-07 06:00:00", "2024-01-07 08:00:00"))
    failed = read_table(spark, table_path(cfg, "quality_report")).where("status = 'fail'")
    assert failed.count() > 0                                   # the report is written first


def test_run_that_dies_before_metrics_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    import tickmart.plans.incremental as job
    from tickmart.operators.metrics import daily_metrics

    wh = str(tmp_path / "warehouse")
    land(tmp_path / "d1", [1, 2, 3])
    land(tmp_path / "d2", [1, 2, 3, 4, 5])
    run_daily_job(spark, JobConfig(str(tmp_path / "d1"), wh, "2024-01-04 06:00:00", "2024-01-04 08:00:00"))

    def boom(*a, **k):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(job.S, "recompute", boom)
    cfg2 = JobConfig(str(tmp_path / "d2"), wh, "2024-01-06 06:00:00", "2024-01-06 08:00:00")
    with pytest.raises(RuntimeError):
        run_daily_job(spark, cfg2)
    monkeypatch.undo()
    run_daily_job(spark, cfg2)                      # same landing, rerun
    bars = read_partitioned(spark, table_path(cfg2, "stg_coin_price_history"))
    markets = read_table(spark, table_path(cfg2, "stg_coin_markets"))
    metrics = read_partitioned(spark, table_path(cfg2, "int_coin_daily_metrics"))
    assert rows(metrics) == rows(daily_metrics(bars, markets))
    assert read_table(spark, table_path(cfg2, "pending_bar_changes")).count() == 0


def test_fact_and_category_metrics_follow_the_metrics(spark, tmp_path, monkeypatch):
    """Only months of another metrics write are rewritten, those of a run that died too."""
    import tickmart.plans.daily_job as job
    from tickmart.plans import models as M

    wh = str(tmp_path / "warehouse")
    land(tmp_path / "d1", [1, 2, 3])
    land(tmp_path / "d2", [3, 4, 33])                       # day 33: the month after
    land(tmp_path / "d3", [34])
    for day in ("d2", "d3"):
        (tmp_path / day / "categories" / "part-0.jsonl").write_text("")
    charts = tmp_path / "d3" / "charts" / "part-0.jsonl"
    charts.write_text(charts.read_text().replace('"chart_days": 90', '"chart_days": 1'))
    with (tmp_path / "d1" / "charts" / "part-0.jsonl").open() as f:
        left = [line for line in f if '"sol"' not in line]   # sol has no history yet
    (tmp_path / "d1" / "charts" / "part-0.jsonl").write_text("".join(left))
    cats = tmp_path / "d1" / "categories" / "part-0.jsonl"
    cats.write_text(cats.read_text().replace("null", '["L1"]'))

    def cfg(day, ts):
        return JobConfig(str(tmp_path / day), wh, ts, ts, allow_empty=True, fail_on_error=False)

    def check():
        read = {n: read_partitioned(spark, table_path(cfg("d1", ""), n))
                for n in ("fct_daily_coin_performance", "int_coin_categories", "int_coin_daily_metrics")}
        fact, cat, metrics = read.values()
        stored = read_table(spark, table_path(cfg("d1", ""), "stg_coin_categories"))
        assert sorted(fact.collect()) == sorted(M.daily_fact(metrics).collect())
        assert sorted(map(str, cat.collect())) == sorted(map(str, M.category_metrics(stored, metrics).select(*cat.columns).collect()))
        return [dict(job.live_months(spark, table_path(cfg("d1", ""), n)).writes)
                for n in ("fct_daily_coin_performance", "int_coin_categories")]

    run_daily_job(spark, cfg("d1", "2024-01-04 06:00:00"))
    first = check()
    assert set(first[0]) == {"2024-01"} and set(first[1]) == {"2024-01", "none"}

    def boom(*a, **k):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(job, "follow_months", boom)          # dies after the metrics moved
    with pytest.raises(RuntimeError):
        run_daily_job(spark, cfg("d2", "2024-02-03 06:00:00"))
    monkeypatch.undo()
    run_daily_job(spark, cfg("d2", "2024-02-03 06:00:00"))   # nothing new for the metrics
    second = check()
    assert set(second[0]) == {"2024-01", "2024-02"} == set(second[1])
    run_daily_job(spark, cfg("d3", "2024-02-04 06:00:00"))
    third = check()
    assert all(new["2024-01"] == old["2024-01"] and new["2024-02"] != old["2024-02"] for new, old in zip(third, second))


def test_command_line_entry(spark, tmp_path, capsys):
    from tickmart.__main__ import main

    land(tmp_path / "d1", [1, 2])
    code = main(["--landing", str(tmp_path / "d1"), "--warehouse", str(tmp_path / "wh"),
                 "--batch-ts", "2024-01-03 06:00:00"])
    assert code == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["loads"]["coin_price_history"]["batch_rows"] == 3
    assert "fct_daily_coin_performance" in out["tables"]


def test_old_versions_are_vacuumed(spark, tmp_path):
    from tickmart.sinks.tables import committed_versions

    wh = str(tmp_path / "warehouse")
    land(tmp_path / "d1", [1, 2])
    land(tmp_path / "d2", [1, 2, 3])
    for day, ts in (("d1", "2024-01-03 06:00:00"), ("d2", "2024-01-04 06:00:00")):
        cfg = JobConfig(str(tmp_path / day), wh, ts, ts, keep_versions=1)
        run_daily_job(spark, cfg)
    for name in ("coin_markets/live", "dim_coins", "quality_report", "dim_coins_snapshot/live"):
        root, _, rest = name.partition("/")
        assert len(committed_versions(spark, "/".join([table_path(cfg, root), *([rest] if rest else [])]))) == 1
    assert read_history(spark, table_path(cfg, "dim_coins_snapshot")).count() == 3


def test_run_scratch_is_removed_after_success(spark, tmp_path):
    import os

    from tickmart.session import current_run, scratch_root

    land(tmp_path / "d1", [1])
    root = scratch_root(spark).replace("file:", "") + "/tickmart"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    run_daily_job(spark, JobConfig(str(tmp_path / "d1"), str(tmp_path / "wh"),
                                   "2024-01-02 06:00:00", "2024-01-02 06:00:00"))
    after = set(os.listdir(root))
    assert not [d for d in after - before if d.startswith("daily-job-")]
    assert current_run() is None


def test_empty_load_fails_and_what_is_missing_is_reported(spark, tmp_path):
    from tickmart.plans.daily_job import EmptyLoadError

    wh = str(tmp_path / "wh")
    land(tmp_path / "d1", [1, 2])
    charts = tmp_path / "d1" / "charts" / "part-0.jsonl"
    (tmp_path / "d1" / "universe" / "ids.txt").write_text("btc,eth,sol,xrp\n")
    charts.write_text(charts.read_text() + '{"error":"rate limit","id":"xrp"}\n<html>\n')
    cfg = JobConfig(str(tmp_path / "d1"), wh, "2024-01-03 06:00:00", "2024-01-03 08:00:00")
    run_daily_job(spark, cfg)
    assert rows(read_table(spark, table_path(cfg, "missing_assets")), "coin_id") == [("xrp",)]
    assert rows(read_table(spark, table_path(cfg, "rejected_input")), "table_name", "raw", "reason") == [
        ("coin_price_history", "<html>", "not JSON"),
        ("coin_price_history", '{"error":"rate limit","id":"xrp"}', "no series")]
    charts.write_text('{"error":"rate limit"}\n')
    late = JobConfig(str(tmp_path / "d1"), wh, "2024-01-04 06:00:00", "2024-01-04 08:00:00")
    with pytest.raises(EmptyLoadError, match="coin_price_history"):
        run_daily_job(spark, late)
    old = JobConfig(str(tmp_path / "d1"), wh, "2024-01-04 06:00:00", "2024-03-04 08:00:00", allow_empty=True)
    with pytest.raises(QualityGateError, match="too old"):
        run_daily_job(spark, old)
