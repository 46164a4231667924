"""SCD2 history as an append-only log of closed versions (SCD-1, SCD-2, SCD-3).

Parts of one pointer (``sinks.partitioned``): ``open`` holds the open version of each
key, with a digest of its check columns; ``closed-<stamp>`` holds what the run of that
stamp closed.  A run reads the open part, compares digests, writes the new open part and
its own closed part, and swaps the pointer; a closed part is never read or written
again.  Its name is the end of its versions, so an as-of read opens the parts closed
later and no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.operators.scd2 import as_of, row_digest, scd2_step
from tickmart.sinks.ingest_log import batch_name
from tickmart.sinks.partitioned import Months, _write, commit, live_months, partitioned_exists

PART, OPEN, CLOSED, DIGEST = "part", "open", "closed-", "_digest"


def merge_history(path: str, source: DataFrame, keys: Sequence[str], check_cols: Sequence[str], batch_ts: str,
                  invalidate_hard_deletes: bool = True) -> Months:
    spark = source.sparkSession
    live = live_months(spark, path) if partitioned_exists(spark, path) else None
    source = source.withColumn(DIGEST, row_digest(list(check_cols)))
    current = live.read(spark, [OPEN]) if live else None
    versions = scd2_step(current, source, keys, [DIGEST], batch_ts, invalidate_hard_deletes)
    parted = versions.withColumn(PART, F.when(F.col("is_current"), OPEN).otherwise(CLOSED + batch_name(batch_ts)))
    new = _write(parted, path, f"{PART}:{','.join(keys)}")
    if live:
        # The open part is replaced even if nothing is open any more.
        kept = {p: w for p, w in live.writes.items() if p != OPEN}
        new = Months(path, new.schema, {**kept, **new.writes}, {**{p: live.rows[p] for p in kept}, **new.rows}, new.layout)
    commit(spark, new)
    return new


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return live_months(spark, path).read(spark).drop(DIGEST)


def read_as_of(spark: SparkSession, path: str, t: str) -> DataFrame:
    """The dimension as it was at ``t``."""
    live = live_months(spark, path)
    parts = [p for p in live.writes if p == OPEN or p > CLOSED + batch_name(t)]
    return as_of(live.read(spark, parts).drop(DIGEST), t)
