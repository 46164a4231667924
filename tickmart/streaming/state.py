"""State outside the executors' heap (STR-1, STR-3).

A stream's state is a row an (asset, day) or a key of the watermark's span: at scale more
than a heap should hold.  :func:`start` starts a query with the RocksDB state store and
changelog checkpoints (a micro-batch uploads its changes, not whole snapshots).  The
options are taken by the query as it starts and put back on the caller's session.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    with rocksdb_state(spark):
        return writer.start()
