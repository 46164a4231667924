"""Driver queries: streaming bars, streaming upsert, streaming dedupe.

Each source folder gets its files in two waves, the first half of the days and
the second, each written by one scan of the table; the stream runs with
``availableNow`` after each wave and goes on from its checkpoint and state.  The
sink is a folder of files or a versioned table, and the query returns what was
written, read back.  A 1-day watermark never marks a point of the second wave
late, whatever the order of the files inside a wave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.plans.queries.oracle_sql import BARS, POINTS, with_ctes
from tickmart.plans.queries.registry import register
from tickmart.session import scratch_dir
from tickmart.sinks.partitioned import read_partitioned
from tickmart.sources.driver_tables import price_points, table
from tickmart.streaming.bars import stream_daily_bars
from tickmart.streaming.dedupe import dedupe_within_watermark
from tickmart.streaming.state import start
from tickmart.streaming.upsert import upsert_batch_writer


def _two_waves(deliveries: DataFrame, folder: str, run) -> None:
    """Land what is ``delivered`` in the first half of the days, run the stream,
    land the rest and run it again."""
    lo, hi = deliveries.agg(F.min("delivered"), F.max("delivered")).first()
    half = lo + (hi - lo) // 2 if lo is not None else None
    early = F.coalesce(F.col("delivered") <= F.lit(half).cast("date"), F.lit(False))
    for wave in (early, ~early):
        deliveries.where(wave).drop("delivered").write.mode("append").parquet(folder)
        run()


def _run(spark: SparkSession, stream_writer) -> None:
    q = start(spark, stream_writer.trigger(availableNow=True))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@register("stream_bars", with_ctes(POINTS, BARS) + """
SELECT * FROM bars
WHERE coin_date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def stream_bars(spark: SparkSession, sf: str) -> DataFrame:
    """STR-1: equals the batch bars on every day closed by the watermark."""
    events = table(spark, sf, "events")
    root = scratch_dir(spark, "stream_bars")

    def run() -> None:
        src = spark.readStream.schema(events.schema).parquet(f"{root}/source")
        bars = stream_daily_bars(price_points(src), lateness="1 day")
        _run(spark, bars.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/sink"))

    _two_waves(events.withColumn("delivered", F.to_date("ts")), f"{root}/source", run)
    return spark.read.parquet(f"{root}/sink")


_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("stream_upsert", f"""
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 5 = 0 THEN 'V' WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice * 3 WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2
       ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority,
  CASE WHEN o_orderkey % 5 = 0 THEN 3 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS _seq
FROM orders""")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """STR-2: all orders and the revised ones (``% 3``) from one stream, those
    revised again (``% 5``, plus older copies) from a second stream with its own
    checkpoint into the same table, upserted by ``o_orderkey``; the newest ``_seq``
    wins whatever order the files are picked up in."""
    orders = table(spark, sf, "orders").select(*_ORDER_COLS.split(", "))
    k = F.col("o_orderkey")
    b1 = orders.withColumn("_seq", F.lit(1))
    b2 = (orders.where(k % 3 == 0).withColumn("o_orderstatus", F.lit("U"))
          .withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("_seq", F.lit(2)))
    b3_new = (orders.where(k % 5 == 0).withColumn("o_orderstatus", F.lit("V"))
              .withColumn("o_totalprice", F.col("o_totalprice") * 3).withColumn("_seq", F.lit(3)))
    b3 = b3_new.unionByName(b2.where(k % 5 == 0))
    root = scratch_dir(spark, "stream_upsert")
    target = f"{root}/orders"
    for name, batches in (("first", [b1, b2]), ("second", [b3])):
        for b in batches:
            b.write.mode("append").parquet(f"{root}/{name}")
        src = spark.readStream.schema(b1.schema).parquet(f"{root}/{name}")
        _run(spark, src.writeStream.foreachBatch(upsert_batch_writer(target, ["o_orderkey"], "_seq"))
             .option("checkpointLocation", f"{root}/checkpoint-{name}"))
    return read_partitioned(spark, target)


@register("stream_dedupe", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """STR-3: every tenth event is delivered again the next day and every
    twentieth twice on its own; each event comes out once."""
    events = table(spark, sf, "events")
    day, none, k = F.to_date("ts"), F.array().cast("array<date>"), F.col("event_id")
    days = F.concat(F.array(day), F.when(k % 20 == 0, F.array(day)).otherwise(none),
                    F.when(k % 10 == 0, F.array(F.date_add(day, 1))).otherwise(none))
    root = scratch_dir(spark, "stream_dedupe")

    def run() -> None:
        src = spark.readStream.schema(events.schema).parquet(f"{root}/source")
        out = dedupe_within_watermark(src, ["event_id"], "ts", "1 day")
        _run(spark, out.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/sink"))

    _two_waves(events.withColumn("delivered", F.explode(days)), f"{root}/source", run)
    return spark.read.parquet(f"{root}/sink")
