"""SNK-1..11, J-8: versioned tables, upserts, insert-only, schema evolution, audit."""

from conftest import rows
from hypothesis import given, settings, strategies as st

from tickmart.session import scratch_dir
from tickmart.sinks.tables import (
    committed_versions, layer_path, publish, read_table, schema_name, vacuum, version_path,
)
from tickmart.sinks.load import COLLIDED, REFUSED, load
from tickmart.sinks.partitioned import live_months, read_partitioned, vacuum_partitioned
from tickmart.sinks.upsert import ensure_columns, insert_only, upsert

S = "k long, v string, seq int"


def df(spark, data, schema=S):
    return spark.createDataFrame(data, schema)


def test_upsert_cases(spark):
    t = df(spark, [(1, "a", 0), (2, "b", 0)])
    assert rows(upsert(t, df(spark, [(3, "c", 1)]), ["k"])) == [(1, "a", 0), (2, "b", 0), (3, "c", 1)]
    assert rows(upsert(t, df(spark, [(2, "B", 1)]), ["k"])) == [(1, "a", 0), (2, "B", 1)]
    repeated = df(spark, [(2, "old", 1), (2, "new", 2), (4, "d", 1)])
    assert rows(upsert(t, repeated, ["k"], order=["seq"])) == [(1, "a", 0), (2, "new", 2), (4, "d", 1)]
    assert rows(upsert(t, df(spark, [], S), ["k"])) == [(1, "a", 0), (2, "b", 0)]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from("xyz")), max_size=12))
def test_upsert_idempotent(spark, batch):
    t = df(spark, [(i, "t", 0) for i in range(4)])
    b = df(spark, [(k, v, i) for i, (k, v) in enumerate(batch)])
    once = upsert(t, b, ["k"], order=["seq"])
    assert rows(upsert(once, b, ["k"], order=["seq"])) == rows(once)
    assert len({r.k for r in once.collect()}) == once.count()


def test_insert_only_and_schema_evolution(spark):
    t = df(spark, [(1, "a", 0)])
    out, coll = insert_only(t, df(spark, [(1, "X", 1), (2, "b", 1)]), ["k"])
    assert rows(out) == [(1, "a", 0), (2, "b", 1)] and rows(coll) == [(1, "X", 1)]
    old = df(spark, [(1, "a")], "k long, v string")
    evolved = ensure_columns(old, df(spark, [], S).schema)
    assert rows(upsert(evolved, df(spark, [(2, "b", 5)]), ["k"])) == [(1, "a", None), (2, "b", 5)]


def test_versions_publish_failure_and_vacuum(spark):
    path = scratch_dir(spark, "t_versions")
    publish(df(spark, [(1, "a", 0)]), path)
    # a failed attempt: folder without _SUCCESS is never read, and never reused
    spark.createDataFrame([(9, "junk", 9)], S).write.parquet(version_path(path, 2))
    fs = spark._jvm.org.apache.hadoop.fs.Path(version_path(path, 2) + "/_SUCCESS")
    fs.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs, False)
    assert committed_versions(spark, path) == [1]
    assert rows(read_table(spark, path)) == [(1, "a", 0)]
    assert publish(df(spark, [(1, "b", 1)]), path).endswith("v0000000003")
    publish(upsert(read_table(spark, path), df(spark, [(2, "c", 2)]), ["k"]), path)
    assert rows(read_table(spark, path)) == [(1, "b", 1), (2, "c", 2)]
    assert rows(read_table(spark, path, version=1)) == [(1, "a", 0)]
    assert vacuum(spark, path, keep=2) == [1, 2]
    assert committed_versions(spark, path) == [3, 4]


def test_load_report_and_empty_guard(spark):
    path = scratch_dir(spark, "t_load")
    r1 = load(df(spark, [(1, "a", 0), (2, "b", 0)]), path, ["k"])
    r2 = load(df(spark, [], S), path, ["k"])
    r3 = load(df(spark, [(2, "B", 1), (3, "c", 1)]), path, ["k"])
    assert (r1.batch_rows, r1.table_rows, r1.skipped) == (2, 2, False)
    assert (r2.batch_rows, r2.table_rows, r2.skipped, r2.version_path) == (0, 2, True, None)
    assert (r3.batch_rows, r3.table_rows) == (2, 3)
    assert len(committed_versions(spark, path + "/live")) == 2
    assert rows(read_partitioned(spark, path)) == [(1, "a", 0), (2, "B", 1), (3, "c", 1)]


def test_a_load_rewrites_the_buckets_of_its_keys_only(spark):
    path = scratch_dir(spark, "t_buckets")
    load(df(spark, [(i, "t", 0) for i in range(200)]), path, ["k"], buckets=8)
    before = live_months(spark, path)
    assert before.layout == "bucket:8:k" and before.table_rows == 200 and len(before.writes) == 8
    load(df(spark, [(5, "u", 1), (5, "v", 2), (777, "n", 1)]), path, ["k"], order=["seq"])
    after = live_months(spark, path)
    changed = {b for b in after.writes if after.writes[b] != before.writes.get(b)}
    touched = {r[0] for r in before.with_part(df(spark, [(5, "", 0), (777, "", 0)])).select("bucket").collect()}
    assert changed == touched and 1 <= len(changed) <= 2 and after.table_rows == 201
    got = {r.k: r.v for r in read_partitioned(spark, path).collect()}
    assert got[5] == "v" and got[777] == "n" and len(got) == 201
    vacuum_partitioned(spark, path, keep=1)
    assert read_partitioned(spark, path).count() == 201


def test_outcomes_of_a_load_are_kept(spark):
    path = scratch_dir(spark, "t_outcomes")
    load(df(spark, [(1, "a", 0)]), path, ["k"])
    r = load(df(spark, [(1, "X", 1), (2, "b", 1), (2, "c", 2), (None, "n", 1), (3, None, 1)]), path, ["k"],
             order=["seq"], mode="insert_only", not_null=["v"], refuse="keep")
    assert (r.batch_rows, r.collided_rows, r.refused_rows, r.table_rows) == (5, 1, 2, 2)
    assert rows(r.rows_of(spark, COLLIDED), "k", "v") == [(1, "X")]
    assert sorted(x._refusal for x in r.rows_of(spark, REFUSED).collect()) == ["null in k", "null in v"]
    assert rows(read_partitioned(spark, path)) == [(1, "a", 0), (2, "c", 2)]


def test_replace_by_and_added_columns(spark):
    import pytest

    path = scratch_dir(spark, "t_replace")
    keys = ["a", "c"]
    first = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "1")], "a string, c string")
    load(first, path, keys, bucket_by=["a"])
    load(spark.createDataFrame([("x", "3", 5)], "a string, c string, n int"), path, keys, replace_by=["a"])
    assert rows(read_partitioned(spark, path)) == [("x", "3", 5), ("y", "1", None)]
    other = scratch_dir(spark, "t_replace_keys")
    load(first, other, keys)
    with pytest.raises(ValueError, match="several buckets"):
        load(first, other, keys, replace_by=["a"])


def test_layer_placement():
    assert schema_name(" marts ", "public") == "marts" and schema_name(None, "public") == "public"
    assert layer_path("/w/", "dim", " marts ") == "/w/marts/dim"
    assert layer_path("/w", "dim") == "/w/public/dim"


def test_anti_join_needs_only_batch_keys(spark):
    t = df(spark, [(i, "t", 0) for i in range(100)])
    plan = upsert(t, df(spark, [(1, "u", 1)]), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "CartesianProduct" not in plan


def test_partition_scoped_upsert_touches_only_batch_months(spark):
    import datetime as dt
    import os

    from tickmart.sinks.partitioned import read_partitioned, replace_partitioned, upsert_partitions

    S2 = "k long, d date, v string"
    path = scratch_dir(spark, "t_parts")
    replace_partitioned(spark.createDataFrame(
        [(1, dt.date(2024, 1, 5), "a"), (2, dt.date(2024, 2, 5), "b"), (4, dt.date(2024, 1, 6), "keep")], S2),
        path, "d")
    data = path.replace("file:", "") + "/data"
    (first,) = os.listdir(data)
    months = upsert_partitions(spark.createDataFrame(
        [(1, dt.date(2024, 1, 5), "A"), (3, dt.date(2024, 1, 9), "c")], S2), path, ["k", "d"], "d")
    assert months == ["2024-01"]
    (second,) = set(os.listdir(data)) - {first}
    assert [f for f in os.listdir(f"{data}/{second}") if f.startswith("month")] == ["month=2024-01"]
    assert rows(read_partitioned(spark, path), "k", "v") == [(1, "A"), (2, "b"), (3, "c"), (4, "keep")]
    assert upsert_partitions(spark.createDataFrame([], S2), path, ["k", "d"], "d") == []


def test_a_failing_refresh_leaves_the_months_readable(spark):
    import datetime as dt
    import os

    import pytest
    from pyspark.sql import functions as F

    from tickmart.sinks.partitioned import (read_partitioned, replace_partitioned, upsert_partitions,
                                            vacuum_partitioned)

    path = scratch_dir(spark, "t_refresh")
    old = spark.createDataFrame([(1, dt.date(2024, 1, 5), "a"), (2, None, "b")], "k long, d date, v string")
    replace_partitioned(old, path, "d")
    bad = old.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    for fails in (lambda: replace_partitioned(bad, path, "d"),
                  lambda: upsert_partitions(bad, path, ["k"], "d", stored=True)):
        with pytest.raises(Exception, match="lost"):
            fails()
        assert rows(read_partitioned(spark, path), "k", "v") == [(1, "a"), (2, "b")]
    replace_partitioned(old.limit(0), path, "d")
    assert read_partitioned(spark, path).columns == ["k", "d", "v"] and read_partitioned(spark, path).count() == 0
    replace_partitioned(old, path, "d")
    vacuum_partitioned(spark, path, keep=1)
    assert len(os.listdir(path.replace("file:", "") + "/data")) == 1
    assert rows(read_partitioned(spark, path), "k", "v") == [(1, "a"), (2, "b")]


def test_upsert_newer_is_order_insensitive(spark):
    from tickmart.sinks.upsert import upsert_newer

    t = df(spark, [(1, "a", 5), (2, "b", 1)])
    late_old = df(spark, [(1, "older", 3), (2, "newer", 2), (3, "new", 0)])
    assert rows(upsert_newer(t, late_old, ["k"], "seq")) == [(1, "a", 5), (2, "newer", 2), (3, "new", 0)]
    b1, b2 = df(spark, [(1, "x", 7)]), df(spark, [(1, "y", 6)])
    one = upsert_newer(upsert_newer(t, b1, ["k"], "seq"), b2, ["k"], "seq")
    two = upsert_newer(upsert_newer(t, b2, ["k"], "seq"), b1, ["k"], "seq")
    assert rows(one) == rows(two) == [(1, "x", 7), (2, "b", 1)]


def test_replace_per_asset_drops_vanished_categories(spark):
    S3 = "coin_id string, category string, seq int"
    t = spark.createDataFrame([("a", "L1", 0), ("a", "DeFi", 0), ("b", "Meme", 0)], S3)
    batch = spark.createDataFrame([("a", "L2", 1)], S3)
    assert rows(upsert(t, batch, ["coin_id", "category"])) == [
        ("a", "DeFi", 0), ("a", "L1", 0), ("a", "L2", 1), ("b", "Meme", 0)]   # source behaviour
    assert rows(upsert(t, batch, ["coin_id"])) == [("a", "L2", 1), ("b", "Meme", 0)]


def test_small_side_broadcasts_only_under_the_limit(spark):
    from tickmart.operators.joins import MAX_BYTES_CONF, broadcast_bytes, small_side

    big = spark.range(1000).withColumnRenamed("id", "k")
    keys = spark.range(5).withColumnRenamed("id", "k")

    def plan(limit):
        spark.conf.set(MAX_BYTES_CONF, str(limit))
        try:
            j = big.join(small_side(keys), "k", "left_semi")
            return j._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset(MAX_BYTES_CONF)

    texts = spark.createDataFrame([("x" * 1000,), (None,)], "k string")
    assert broadcast_bytes(texts) == 1000 + broadcast_bytes(texts.where("k IS NULL")) * 2
    assert broadcast_bytes(texts.limit(0)) == 0
    assert "BroadcastHashJoin" in plan(1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(20)       # over the limit: shuffle join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
