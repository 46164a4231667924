"""STR-1..3 at sf0.001: streams equal the batch results they stand for."""

from conftest import SF, rows

from pyspark.sql import functions as F

from __spark_entry__ import queries
from tickmart.operators.bars import daily_bars
from tickmart.plans.queries.registry import comparable
from tickmart.sources.driver_tables import price_points, table


def test_stream_bars_equal_batch_on_closed_days(spark):
    got = queries()["stream_bars"](spark, SF)
    events = table(spark, SF, "events")
    last = events.agg(F.max("ts")).collect()[0][0]
    batch = daily_bars(price_points(events)).where(
        F.expr("date_add(coin_date, 1)") <= F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"))
    assert rows(got) == rows(comparable(batch).select(*got.columns))
    assert got.count() > 0


def test_stream_dedupe_and_upsert(spark):
    q = queries()
    dedup = q["stream_dedupe"](spark, SF)
    assert rows(dedup, "event_id") == rows(table(spark, SF, "events"), "event_id")
    up = q["stream_upsert"](spark, SF)
    orders = table(spark, SF, "orders")
    assert up.count() == orders.count()
    st = {r.o_orderkey: r.o_orderstatus for r in up.collect()}
    assert all(st[k] == "V" for k in st if k % 5 == 0)
    assert all(st[k] == "U" for k in st if k % 3 == 0 and k % 5 != 0)


def test_state_is_in_rocksdb_and_a_restart_continues(spark):
    from tickmart.session import scratch_dir
    from tickmart.streaming.dedupe import dedupe_within_watermark
    from tickmart.streaming.state import PROVIDER, STATE_CONF, start

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    root = scratch_dir(spark, "t_state")
    schema = "k long, ts timestamp_ntz"
    for wave in ([1, 2, 2], [2, 3]):
        spark.createDataFrame([(k, None) for k in wave], schema).withColumn(
            "ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"{root}/in")
        out = dedupe_within_watermark(spark.readStream.schema(schema).parquet(f"{root}/in"), ["k"], "ts", "1 day")
        q = start(spark, out.writeStream.format("parquet").option("checkpointLocation", f"{root}/cp")
                  .option("path", f"{root}/out").trigger(availableNow=True))
        q.awaitTermination()
        metrics = [op.customMetrics for p in q.recentProgress for op in p.stateOperators]
        assert metrics and all(any(m.startswith("rocksdb") for m in x) for x in metrics)
        assert spark.conf.get(name, None) == before and STATE_CONF[name] == PROVIDER
    assert rows(spark.read.parquet(f"{root}/out"), "k") == [(1,), (2,), (3,)]
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/cp/state/0")
    fs = files.getFileSystem(spark._jsc.hadoopConfiguration())
    it, found = fs.listFiles(files, True), []
    while it.hasNext():
        found.append(it.next().getPath().getName())
    assert any(f.endswith(".changelog") for f in found)


def test_a_stream_rewrites_touched_buckets_and_keeps_few_pointers(spark):
    from tickmart.session import scratch_dir
    from tickmart.sinks.partitioned import live_months, read_partitioned
    from tickmart.sinks.tables import committed_versions
    from tickmart.streaming.upsert import upsert_batch_writer

    path = scratch_dir(spark, "t_stream_upsert")
    write = upsert_batch_writer(path, ["k"], "v", buckets=8)
    schema = "k long, v int, s string"
    write(spark.createDataFrame([(k, 1, "a") for k in range(100)], schema), 0)
    first = live_months(spark, path)
    for n in range(1, 5):
        write(spark.createDataFrame([(7, n, f"b{n}"), (8, 0, "old")], schema), n)
    last = live_months(spark, path)
    assert sum(last.writes[b] != w for b, w in first.writes.items()) <= 2
    assert len(committed_versions(spark, f"{path}/live")) == 2
    got = {r.k: r.s for r in read_partitioned(spark, path).collect()}
    assert got[7] == "b4" and got[8] == "a" and len(got) == 100
    write(spark.createDataFrame([(7, 99, "again")], schema), 4)      # applied already
    assert {r.k: r.s for r in read_partitioned(spark, path).collect()} == got
