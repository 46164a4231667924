"""Keyed loads into bucketed tables (SNK-1..4, SNK-9..11).

A batch is written once, each row tagged with its outcome:

* ``accepted``: goes into the table (an upsert, or an insert of a new key; of rows that
  repeat a key the last one);
* ``collided``: insert-only, and the key is stored already;
* ``refused``: breaks a constraint of the load (a NULL in a NOT NULL column or key).

The staged batch is partitioned by that tag, so the table takes the accepted rows
and the others stay readable without a second pass over the source.  The table is
bucketed by a hash of its key (``sinks.partitioned``): a load rewrites the buckets
its keys fall in and no others, through one pointer swap.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.session import scratch_dir
from tickmart.sinks.partitioned import create_buckets, live_months, merge_buckets, partitioned_exists
from tickmart.sinks.upsert import _batch_order, ensure_columns, latest_per_key, upsert

ACCEPTED, COLLIDED, REFUSED = "accepted", "collided", "refused"
OUTCOME = "_outcome"


@dataclass
class LoadReport:
    table_path: str
    batch_rows: int
    table_rows: int
    skipped: bool
    version_path: str | None
    collided_rows: int = 0
    refused_rows: int = 0
    rejected_rows: int = 0          # reject rows of the parse that the batch came from
    outcomes_path: str | None = None

    def rows_of(self, spark: SparkSession, outcome: str) -> DataFrame:
        """The batch's rows of one outcome (with the reason of refused ones)."""
        return spark.read.parquet(self.outcomes_path).where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def tagged(batch: DataFrame, keys: Sequence[str], stored_keys: DataFrame | None,
           not_null: Sequence[str] = ()) -> DataFrame:
    """``batch`` with its outcome and the reason of a refusal; with ``stored_keys`` a
    stored key collides."""
    checked = list(dict.fromkeys([*keys, *not_null]))
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in checked])
    held = F.lit(False)
    if stored_keys is not None:
        batch = batch.join(stored_keys.withColumn("_held", F.lit(True)), list(keys), "left").select(*batch.columns, "_held")
        held = F.coalesce(F.col("_held"), F.lit(False))
    outcome = F.when(missing != "", REFUSED).when(held, COLLIDED).otherwise(ACCEPTED)
    return batch.select(*[c for c in batch.columns if c != "_held"],
                        F.when(missing != "", F.concat(F.lit("null in "), missing)).alias("_refusal"), outcome.alias(OUTCOME))


def load(updates: DataFrame, table_path: str, keys: Sequence[str],
         order: Sequence[str | Column] | None = None, mode: str = "upsert",
         transient: Sequence[str] = (), not_null: Sequence[str] = (), refuse: str = "fail",
         buckets: int | None = None, bucket_by: Sequence[str] | None = None,
         replace_by: Sequence[str] | None = None) -> LoadReport:
    """Load a batch into the table at ``table_path``.

    ``mode``: ``upsert``, or ``insert_only`` (stored keys stay as they are; the batch's
    rows with such keys are kept as collisions).  Keys that repeat within the batch give
    their last row by ``order`` (or by the other columns); ``transient`` columns serve the
    order and are not stored.  Rows with a NULL in a key or ``not_null`` column stop the
    load (``refuse="fail"``) or are set aside (``"keep"``).  ``replace_by``: all stored
    rows with the batch's values of these columns go, not only those of its keys.
    An empty batch writes nothing.  A new table gets ``buckets`` buckets of ``bucket_by``
    (its keys).
    """
    spark = updates.sparkSession
    columns = [c for c in updates.columns if c not in transient]
    exists = partitioned_exists(spark, table_path)
    live = live_months(spark, table_path) if exists else None
    if live and replace_by and not set(live.layout.split(":", 2)[2].split(",")) <= set(replace_by):
        raise ValueError(f"{table_path} is bucketed by {live.layout}: rows of one {list(replace_by)} are in several buckets")
    stored_keys = live.read(spark).select(*keys) if live and mode == "insert_only" else None
    outcomes = scratch_dir(spark, "load-batch")
    tagged(updates, keys, stored_keys, not_null).write.partitionBy(OUTCOME).parquet(outcomes)
    written = T.StructType([*updates.schema.fields, T.StructField("_refusal", T.StringType()), T.StructField(OUTCOME, T.StringType())])
    batch = spark.read.schema(written).parquet(outcomes)
    # From the files' footers: three numbers.
    counts = {r[0]: r[1] for r in batch.groupBy(OUTCOME).count().collect()}
    refused, total = counts.get(REFUSED, 0), sum(counts.values())
    if refused and refuse == "fail":
        example = batch.where(F.col(OUTCOME) == REFUSED).select("_refusal").first()[0]
        raise ValueError(f"{refused} rows of the batch for {table_path} refused: {example}")
    report = LoadReport(table_path, total, live.table_rows if live else 0, True, None, counts.get(COLLIDED, 0), refused,
                        outcomes_path=outcomes)
    if not counts.get(ACCEPTED):
        return report
    taken = batch.where(F.col(OUTCOME) == ACCEPTED)
    rows = latest_per_key(taken, keys, order or _batch_order(updates, keys)).select(*columns)
    if not live:
        new = create_buckets(rows, table_path, list(bucket_by or keys), buckets)
    else:
        def merge(current: DataFrame) -> DataFrame:
            current = ensure_columns(current, rows.schema)
            if mode == "insert_only":
                return current.unionByName(rows, allowMissingColumns=True)
            if replace_by:
                gone = taken.select(*replace_by).distinct()
                current = current.join(gone, list(replace_by), "left_anti").select(*current.columns)
                return current.unionByName(rows, allowMissingColumns=True)
            return upsert(current, rows, keys, stored=True)

        new = merge_buckets(taken.select(*columns), table_path, merge)
    report.skipped, report.table_rows, report.version_path = False, new.table_rows, f"{table_path}/live"
    return report
