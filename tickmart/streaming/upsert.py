"""STR-2: micro-batches upserted into a bucketed table.

Each micro-batch is reduced to the newest row per key and upserted; a row
only replaces a stored row that is not newer by the version column, so the
table does not depend on the order in which files become micro-batches.  Only the
buckets that the batch's keys fall in are read and rewritten, and swapped by one
pointer; older pointers and the files only they name are removed as the stream goes.
A batch that the same stream has already applied (its marker exists) is skipped, and
re-applying a batch gives the same table anyway, so restarts after a failure are
exactly-once in effect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickmart.sinks.partitioned import create_buckets, merge_buckets, partitioned_exists, vacuum_partitioned
from tickmart.sinks.tables import _fs, stage
from tickmart.sinks.upsert import ensure_columns, latest_per_key, upsert_newer


def _marker(table_path: str, query_id: str, batch_id: int) -> str:
    return f"{table_path.rstrip('/')}/_batches/{query_id}-{batch_id:012d}"


def upsert_batch_writer(table_path: str, keys: Sequence[str], version: str, keep: int = 2, buckets: int | None = None):
    """A ``foreachBatch`` function applying each micro-batch as a keyed upsert
    ordered by the ``version`` column; ``keep`` pointers stay readable."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The id that the stream's checkpoint holds: another stream counts its own batches.
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        fs, marker = _fs(spark, _marker(table_path, query_id, batch_id))
        if fs.exists(marker):
            return
        rows = stage(latest_per_key(batch, keys, [version]), "micro-batch")
        if not rows.isEmpty():
            if partitioned_exists(spark, table_path):
                merge_buckets(rows, table_path, lambda current: upsert_newer(
                    ensure_columns(current, rows.schema), rows, keys, version, stored=True))
                vacuum_partitioned(spark, table_path, keep)
            else:
                create_buckets(rows, table_path, keys, buckets)
        fs.create(marker, True).close()

    return write
