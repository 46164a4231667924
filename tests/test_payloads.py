"""SRC-1..3, SRC-6, J-2, PRJ-1, FLT-1, TOP-4, SET-1."""

import json

from conftest import D, rows, ts

from pyspark.sql import functions as F

from tickmart.operators.dedupe import missing_keys, top_n
from tickmart.operators.unnest import unnest_series
from tickmart.operators.standardise import standardise_snapshot
from tickmart.sources.payloads import (
    accepted_charts, category_rows, chart_rows, file_stem, parse_charts, parse_snapshots, read_keyed_payloads, read_payloads,
    read_snapshot_payloads, rejects, snapshot_rows,
)
from tickmart.sources.universe import parse_universe, restrict_to_universe

BATCH = "2024-01-31 06:00:00"


def payloads(spark, texts, files=None):
    files = files or [f"f{i}.json" for i in range(len(texts))]
    return spark.createDataFrame(list(zip(texts, files)), "payload string, source_file string")


def test_snapshot_list_edge_rows(spark):
    coins = [
        {"id": None, "symbol": "x"},
        {"id": "", "symbol": "y"},
        {"id": "btc", "symbol": "btc", "current_price": 5.5e-08, "roi": None},
        {"id": "eth", "symbol": "eth", "roi": {"times": 1.5, "currency": "usd", "percentage": 150}},
        {"id": "btc", "symbol": "BTC2", "current_price": 2},          # repeat: first wins
        {"id": "sol", "roi": "n/a", "ath_date": "2021-11-06T21:54:35.825Z",
         "last_updated": "2024-01-31T10:00:00.000Z"},
    ]
    df = payloads(spark, [json.dumps(coins), json.dumps({"error": "rate limited"}), "not json"])
    out = {r.id: r for r in snapshot_rows(df, BATCH).collect()}
    assert set(out) == {"btc", "eth", "sol"}
    assert out["btc"].symbol == "btc" and out["btc"].current_price == D("5.5E-8")
    assert (out["eth"].roi_times, out["eth"].roi_currency, out["eth"].roi_percentage) == (
        D("1.5"), "usd", D("150"))
    assert out["sol"].roi_times is None and out["sol"].roi_currency is None
    assert str(out["sol"].ath_date) == "2021-11-06"
    assert out["sol"].last_updated == ts("2024-01-31 10:00:00")
    assert out["sol"]._ingested_at == ts(BATCH)


def test_keep_first_across_files(spark):
    df = payloads(spark, [json.dumps([{"id": "a", "symbol": "second"}]),
                          json.dumps([{"id": "a", "symbol": "first"}])], ["p2.json", "p1.json"])
    assert [r.symbol for r in snapshot_rows(df, BATCH).collect()] == ["first"]


def test_read_payloads_from_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "page1.json").write_text(json.dumps([{"id": "a"}, {"id": "b"}], indent=2))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.jsonl").write_text('{"id":"a","categories":["L1","DeFi"]}\n{"id":"b"}\n')
    snap = snapshot_rows(read_payloads(spark, str(tmp_path / "m")), BATCH)
    assert rows(snap, "id") == [("a",), ("b",)]
    cats = category_rows(read_payloads(spark, str(tmp_path / "c"), whole_files=False), BATCH)
    assert rows(cats, "coin_id", "category") == [("a", "DeFi"), ("a", "L1")]


def test_chart_rows_and_positional_unnest(spark):
    p = [[1704067200000, 10], [1704067260500, None], [1704067320000, "5.5e-08"]]
    charts = [
        {"id": "a", "prices": p, "market_caps": [[1, 100], [2, 200]], "total_volumes": p},  # shortest 2
        {"id": "b", "prices": p, "market_caps": [], "total_volumes": p},                   # empty -> none
        {"id": "c", "prices": p},                                                           # missing -> []
        {"id": "d", "prices": [[1704067200000]], "market_caps": [[1]], "total_volumes": [[1, 2]]},
        {"id": "e", "prices": [None, [1704067200000, 3]], "market_caps": [[1, 1], [2, 2]],
         "total_volumes": [[1, 1], [2, 2]]},
    ]
    texts = [json.dumps(c).replace('"5.5e-08"', "5.5e-08") for c in charts]
    raw = chart_rows(payloads(spark, texts), BATCH, 90)
    assert {r.coin_id: r.chart_days for r in raw.collect()} == dict.fromkeys("abcde", 90)
    pts = unnest_series(raw)
    got = {(r.coin_id, r.ordinality): r for r in pts.collect()}
    assert set(got) == {("a", 1), ("a", 2), ("d", 1), ("e", 1), ("e", 2)}
    assert got[("a", 1)].price == D(10) and got[("a", 1)].market_cap == D(100)
    assert got[("a", 2)].price is None and str(got[("a", 2)].price_ts) == "2024-01-01 00:01:00"
    assert got[("d", 1)].price is None                       # pair with one element
    assert got[("e", 1)].price_ms is None                    # null element
    assert got[("e", 2)].price == D(3)


def test_category_rows_null_list_and_blank_id(spark):
    texts = [json.dumps({"id": "a", "categories": ["x", "x", None]}),
             json.dumps({"id": "b", "categories": None}), json.dumps({"id": "", "categories": ["y"]})]
    assert rows(category_rows(payloads(spark, texts), BATCH), "coin_id", "category") == [("a", "x")]


def test_universe_trim_lower_blank_dedupe_and_anti(spark):
    lines = spark.createDataFrame([(0, " BTC, eth,,btc ,  "), (1, "sol,ETH")], "n int, value string")
    u = parse_universe(lines, order_col="n")
    assert rows(u, "coin_id") == [("btc",), ("eth",), ("sol",)]
    first = {r.coin_id: (r.list_order._line, r.list_order._pos) for r in u.collect()}
    assert first["eth"] == (0, 1)
    fetched = spark.createDataFrame([("btc",), ("doge",)], "coin_id string")
    assert rows(missing_keys(u.select("coin_id"), fetched, "coin_id")) == [("eth",), ("sol",)]
    assert rows(restrict_to_universe(fetched, u)) == [("btc",)]


def test_top_n_plan_and_ties(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(10)], "id long, cap double")
    out = top_n(df, 3, [F.col("cap").desc_nulls_last(), F.col("id").asc()])
    assert [r.id for r in out.collect()] == [2, 5, 8]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_default_universe_when_none_landed(spark, tmp_path):
    from tickmart.fixed import DEFAULT_UNIVERSE
    from tickmart.plans.daily_job import JobConfig, _universe_lines

    cfg = JobConfig(landing=str(tmp_path), warehouse=str(tmp_path / "w"), batch_ts="", as_of="")
    u = parse_universe(_universe_lines(spark, cfg))
    assert u.count() == len(DEFAULT_UNIVERSE) == 100
    first = min(u.collect(), key=lambda r: (r.list_order._line, r.list_order._pos))
    assert first.coin_id == "bitcoin"


def test_snapshot_values_that_do_not_fit_are_rejected_not_zero(spark):
    text = ('[{"id":"a","current_price":1e21,"market_cap":"n/a","total_volume":"12.5","ath_date":"soon","high_24h":null},'
            '{"id":"b","current_price":123456789012345678901,"low_24h":{"usd":1}},{"symbol":"x"},'
            '{"id":"c","ath":99999999999999999999.5,"ath":7}]')
    parsed = parse_snapshots(payloads(spark, [text, '{"error":"rate limit"}', "<html>"]), BATCH)
    got = {(r.id, r.field): (r.raw, r.reason) for r in rejects(parsed).collect() if r.field != "payload"}
    assert got == {("a", "current_price"): ("1.0E21", "out of range"), ("a", "market_cap"): ("n/a", "not a number"),
                   ("a", "ath_date"): ("soon", "not a date"), ("b", "current_price"): ("123456789012345678901", "out of range"),
                   ("b", "low_24h"): ('{"usd":1}', "not a number"), (None, "id"): ('{"symbol":"x"}', "no id")}
    assert sorted(r.raw for r in rejects(parsed).collect() if r.field == "payload") == ["<html>", '{"error":"rate limit"}']
    raw = {r.id: r for r in snapshot_rows(payloads(spark, [text]), BATCH).collect()}
    assert set(raw) == {"a", "b", "c"} and raw["a"].rejected_fields == ["current_price", "market_cap", "ath_date"]
    assert raw["a"].total_volume == D("12.5") and raw["c"].ath == 7 and raw["c"].rejected_fields is None
    staged = {r.name_id: r for r in standardise_snapshot(snapshot_rows(payloads(spark, [text]), BATCH), "2024-02-01",
                                                         "2024-02-01 06:00:00").collect()}
    assert staged["a"].current_price is None and staged["a"].market_cap is None and staged["a"].all_time_high_date is None
    assert staged["a"].high_24h == 0 and staged["b"].current_price is None and staged["c"].current_price == 0
    assert str(staged["c"].all_time_high_date) == "2024-02-01"


def test_chart_points_that_do_not_fit_are_set_aside(spark):
    day = 1704067200000
    text = json.dumps({"id": "a", "prices": [[day, 1.5], [day + 1, 2.5], [day + 2, "BIG"]],
                       "market_caps": [[day, 10], [day + 1, "n/a"], [day + 2, 30], [day + 3, 40]],
                       "total_volumes": [[day, None], [day + 1, 2], [day + 2, 3]]}).replace('"BIG"', "1e21")
    parsed = parse_charts(payloads(spark, [text, '{"id":"b","prices":{}}', '{"prices":[]}']), BATCH, 90)
    bad = {(r.id, r.field, r.raw, r.reason) for r in rejects(parsed).collect()}
    assert bad == {("a", "prices[2][1]", "1.0E21", "out of range"), ("a", "market_caps[1][1]", "n/a", "not a number"),
                   (None, "payload", '{"id":"b","prices":{}}', "no series"), (None, "payload", '{"prices":[]}', "no id")}
    (pt,) = unnest_series(accepted_charts(parsed)).collect()
    assert (pt.price, pt.market_cap, pt.total_volume) == (D("1.5"), D(10), None)


def test_pretty_printed_files_lines_and_folders(spark, tmp_path):
    for folder in ("p=1", "p=2"):
        (tmp_path / "m" / folder).mkdir(parents=True)
    (tmp_path / "m" / "p=2" / "page.json").write_text('[{"id":"a","symbol":"second"}]')
    (tmp_path / "m" / "p=1" / "page.json").write_text('[{"id":"a","symbol":"first"}]')
    assert rows(snapshot_rows(read_payloads(spark, str(tmp_path / "m")), BATCH), "symbol") == [("first",)]
    charts = tmp_path / "c"
    charts.mkdir()
    chart = {"prices": [[1, 2]], "market_caps": [[1, 3]], "total_volumes": [[1, 4]]}
    (charts / "btc.json").write_text(json.dumps(chart, indent=2))
    (charts / "two.json").write_text("\n".join(json.dumps({"id": i, **chart}) for i in "xy") + "\n")
    (charts / "part-0.jsonl").write_text(json.dumps({"id": "z", **chart}) + "\n")
    read = read_keyed_payloads(spark, str(charts)).withColumn("_id", F.regexp_extract("source_file", r"([^/]+)\.json$", 1))
    assert rows(chart_rows(read, BATCH, 90, id_col="_id"), "coin_id") == [("btc",), ("x",), ("y",), ("z",)]


def test_a_long_series_is_many_tasks_work(spark):
    from tickmart.operators.unnest import sliced
    from tickmart.schemas import RAW_SERIES

    def series(n):
        return [[D(1704067200000 + i), D(i)] for i in range(n)]

    def row(coin, n, m):
        return (coin, 90, series(n), series(m), series(n), ts(BATCH))

    raw = spark.createDataFrame([row("hot", 3000, 2990), *[row(f"c{i}", 30, 30) for i in range(100)], row("none", 0, 5)], RAW_SERIES)
    cut = sliced(raw.coalesce(1), points=100)
    key = ["coin_id", "ordinality", "price_ms", "price", "market_cap", "point_order"]
    assert rows(unnest_series(cut), *key) == rows(unnest_series(raw), *key)
    spread = cut.where("coin_id = 'hot'").groupBy(F.spark_partition_id()).agg(F.max(F.size("prices"))).collect()
    assert len(spread) > 1 and max(r[1] for r in spread) <= 100


def test_snapshot_lists_landed_as_lines(spark, tmp_path):
    """One response a line: the first coin by line, then position, wins; whole files beside them count too."""
    (tmp_path / "market_lines").mkdir()
    (tmp_path / "market_lines" / "a.txt").write_text(
        '[{"id":"z","symbol":"z1"},{"id":"y","symbol":"first"}]\n[{"id":"y","symbol":"second"},{"id":"x","symbol":"x1"}]\n{"error":"no"}\n')
    read = read_snapshot_payloads(spark, str(tmp_path))
    assert rows(snapshot_rows(read, BATCH), "id", "symbol") == [("x", "x1"), ("y", "first"), ("z", "z1")]
    assert [r.reason for r in rejects(parse_snapshots(read, BATCH)).collect()] == ["not a list"]
    (tmp_path / "markets").mkdir()
    (tmp_path / "markets" / "p.json").write_text('[\n{"id":"w",\n"symbol":"w1"}]')
    assert rows(snapshot_rows(read_snapshot_payloads(spark, str(tmp_path)), BATCH), "id") == [("w",), ("x",), ("y",), ("z",)]


def test_landed_files_do_not_grow_with_the_payloads(spark, tmp_path):
    """Some hundred market payloads are a few files, not a file and a folder each."""
    from tickmart.plans.queries.job import land_day

    sf = tmp_path / "sf"
    spark.sql("SELECT id AS c_custkey, concat('C', id) AS c_name, CAST(id % 25 AS INT) AS c_nationkey, 1.5D AS c_acctbal, "
              "'AUTO' AS c_mktsegment FROM range(15000)").write.parquet(f"{sf}/customer.parquet")
    spark.sql("SELECT id AS event_id, TIMESTAMP_NTZ '2024-01-05 00:00:00' AS ts, id AS user_id, 'view' AS event_type, 2.5D AS value, "
              "'{\"k\": 3}' AS props FROM range(40)").write.parquet(f"{sf}/events.parquet")
    spark.sql("SELECT id AS o_custkey, 'LOW' AS o_orderpriority FROM range(40)").write.parquet(f"{sf}/orders.parquet")
    land_day(spark, str(sf), str(tmp_path / "landing"), 0)
    assert len([f for f in (tmp_path / "landing").rglob("*.txt")]) < 60
    parsed = parse_snapshots(read_snapshot_payloads(spark, str(tmp_path / "landing")), BATCH)
    assert parsed.count() == 15000 and rejects(parsed).count() == 0


def test_numbers_that_do_not_fit_in_one_series_only(spark):
    """Text is read for series with gaps only; the places taken out and the rejects stay those of all series."""
    text = ('{"id":"a","prices":[[1,2],[2,"x"],[3,4]],"market_caps":[[1,1],[2,2],[3,null]],"total_volumes":[[1,5],[2,6],[3,7]]}')
    row, = parse_charts(payloads(spark, [text]), BATCH, 90).collect()
    assert [int(p[0]) for p in row.prices] == [int(p[0]) for p in row.total_volumes] == [1, 3] and row.market_caps[1][1] is None
    assert [(r.field, r.raw) for r in row.rejects] == [("prices[1][1]", "x")]


def test_file_stem(spark):
    df = spark.createDataFrame([("file:/a/b.c/btc.json",), ("file:/a/.json",), ("file:/a/part-0.txt",), (None,)], "p string")
    assert [r[0] for r in df.select(file_stem("p")).collect()] == ["btc", "", None, None]
