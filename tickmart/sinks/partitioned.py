"""Tables split into parts that are written and swapped one by one.

Two layouts share one mechanism: ``month`` of a date (bars, metrics, facts: an
increment touches the newest days only) and ``bucket`` of a key hash (keyed tables:
a load touches the buckets its keys fall in).  An upsert rewrites just the touched
parts:

* ``<path>/data/<write>/month=YYYY-MM/`` or ``.../bucket=N/``: what one write put
  there; never changed or deleted while any kept pointer names it.
* ``<path>/live``: a small versioned document (``sinks.tables.publish_document``):
  the write that holds each part, its rows, and the table's layout (with the bucket
  count).  Publishing it is the only step that changes what readers see, so a write
  that fails leaves the table as it was.

Each touched part is read once, merged with the batch by key (``upsert``) and
written once; other parts are neither read nor written.  A rerun of the same
batch gives the same rows.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.sinks.tables import _fs, committed_versions, publish_document, read_document, stage, table_exists, vacuum
from tickmart.sinks.upsert import upsert

PARTITION_COL = "month"
NO_DATE = "none"
BUCKET_COL = "bucket"
BUCKETS_CONF = "tickmart.buckets"
DEFAULT_BUCKETS = 16


@dataclass
class Months:
    """Which write holds each part of the table at ``path``.

    ``layout`` is ``month`` or ``bucket:<count>:<keys>``."""

    path: str
    schema: T.StructType
    writes: dict[str, str]
    rows: dict[str, int] = field(default_factory=dict)
    layout: str = PARTITION_COL

    @property
    def column(self) -> str:
        return self.layout.split(":", 1)[0]

    @property
    def table_rows(self) -> int:
        return sum(self.rows.values())

    def with_part(self, df: DataFrame) -> DataFrame:
        """``df`` with the bucket of each row."""
        _, count, keys = self.layout.split(":", 2)
        return with_bucket(df, keys.split(","), int(count))

    def read(self, spark: SparkSession, months: Sequence[str] | None = None) -> DataFrame:
        wanted = None if months is None else set(months)
        folders = [f"{self.path}/data/{w}/{self.column}={m}" for m, w in sorted(self.writes.items())
                   if wanted is None or m in wanted]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    """Rows without a date keep a partition of their own."""
    return df.withColumn(PARTITION_COL, F.coalesce(F.date_format(F.col(date_col), "yyyy-MM"), F.lit(NO_DATE)))


def bucket_of(keys: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("string")


def with_bucket(df: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    return df.withColumn(BUCKET_COL, bucket_of(keys, count))


def partitioned_exists(spark: SparkSession, path: str) -> bool:
    """True once a write has been committed."""
    return table_exists(spark, f"{path}/live")


def live_months(spark: SparkSession, path: str, version: int | None = None) -> Months:
    """The live parts (a name and two values each)."""
    doc = read_document(spark, f"{path}/live", version)
    if doc is None:
        raise FileNotFoundError(f"no committed version under {path}")
    return Months(path, T.StructType.fromJson(doc["schema"]), doc["writes"], doc["rows"], doc["layout"])


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return live_months(spark, path).read(spark)


def commit(spark: SparkSession, live: Months) -> None:
    """Make ``live`` what readers see."""
    publish_document(spark, f"{live.path}/live", {"schema": live.schema.jsonValue(), "writes": live.writes,
                                                  "rows": live.rows, "layout": live.layout})


def _write(df: DataFrame, path: str, layout: str = PARTITION_COL) -> Months:
    """Write rows that have their part; nobody sees them before ``commit``."""
    spark, column = df.sparkSession, layout.split(":", 1)[0]
    write = f"w{uuid.uuid4().hex}"
    folder = f"{path}/data/{write}"
    df.write.partitionBy(column).parquet(folder)
    schema = df.drop(column).schema
    fs, root = _fs(spark, folder)
    parts = [st.getPath().getName().split("=", 1)[1] for st in fs.listStatus(root)
             if st.isDirectory() and st.getPath().getName().startswith(f"{column}=")]
    # Counted from the files' footers, one row a part.
    counts = {}
    if parts:
        seen = spark.read.schema(T.StructType([*schema.fields, T.StructField(column, T.StringType())])).parquet(folder)
        counts = {r[0]: r[1] for r in seen.groupBy(column).count().collect()}
    return Months(path, schema, dict.fromkeys(parts, write), counts, layout)


def write_months(df: DataFrame, path: str, date_col: str) -> Months:
    """Write ``df`` as the next contents of the whole table, not yet committed."""
    return _write(with_month(df, date_col), path)


def replace_partitioned(df: DataFrame, path: str, date_col: str) -> None:
    """Full refresh: the table becomes exactly ``df`` (every month replaced)."""
    commit(df.sparkSession, write_months(df, path, date_col))


def merged(live: Months, new: Months) -> Months:
    """``live`` with the parts of ``new`` in place of its own."""
    return Months(live.path, new.schema, {**live.writes, **new.writes}, {**live.rows, **new.rows}, live.layout)


def replace_months(df: DataFrame, path: str, date_col: str, months: Sequence[str]) -> None:
    """The given months become exactly the rows of ``df`` (which are theirs); others stay.
    A month without rows leaves the table."""
    spark = df.sparkSession
    new = write_months(df, path, date_col)
    if partitioned_exists(spark, path):
        live = live_months(spark, path)
        kept = {m: w for m, w in live.writes.items() if m not in months}
        new = Months(path, new.schema, {**kept, **new.writes}, {**{m: live.rows[m] for m in kept}, **new.rows}, new.layout)
    commit(spark, new)


def follow_months(source: Months, path: str, date_col: str, rows: Callable[[Sequence[str] | None], DataFrame],
                  spark: SparkSession, other: str = "", always: Sequence[str] = ()) -> DataFrame:
    """Bring the table at ``path`` up to date with ``source`` month by month.

    ``rows(months)`` gives the rows of some months (None: of all).  ``<path>/followed``
    says which write of the source each month was made from: months made from another
    write are rewritten, also those that an earlier run left behind, and months that the
    source lost go.  ``other`` names the state of the model's other inputs: if it changed,
    all months are rewritten.  ``always`` are rewritten each time."""
    seen = read_document(spark, f"{path}/followed") if partitioned_exists(spark, path) else None
    if seen is None or seen["other"] != other:
        replace_partitioned(rows(None), path, date_col)
    else:
        made = seen["writes"]
        stale = sorted({m for m in {*made, *source.writes} if made.get(m) != source.writes.get(m)} | set(always))
        if stale:
            replace_months(rows(stale), path, date_col, stale)
    publish_document(spark, f"{path}/followed", {"writes": source.writes, "other": other})
    return read_partitioned(spark, path)


# --- buckets of a key hash ----------------------------------------------------------

def bucket_count(spark: SparkSession) -> int:
    """Buckets of a new table: ``tickmart.buckets``; a few hundred MB each is a good size."""
    return int(spark.conf.get(BUCKETS_CONF, str(DEFAULT_BUCKETS)))


def create_buckets(df: DataFrame, path: str, keys: Sequence[str], count: int | None = None) -> Months:
    """Write the whole table bucketed by ``keys``; one row a key is the caller's part."""
    spark = df.sparkSession
    layout = f"{BUCKET_COL}:{count or bucket_count(spark)}:{','.join(keys)}"
    bucketed = Months(path, df.schema, {}, {}, layout).with_part(df)
    new = _write(bucketed.repartition(BUCKET_COL), path, layout)
    commit(spark, new)
    return new


def merge_buckets(batch: DataFrame, path: str, merge) -> Months:
    """Rewrite the buckets that the stored ``batch`` touches as ``merge(current rows of
    those buckets)``; the other buckets keep their files."""
    spark = batch.sparkSession
    live = live_months(spark, path)
    # Bucket numbers only: at most as many as the table has.
    touched = sorted(r[0] for r in live.with_part(batch).select(BUCKET_COL).distinct().collect())
    if not touched:
        return live
    rows = live.with_part(merge(live.read(spark, touched)))
    new = merged(live, _write(rows.repartition(BUCKET_COL), path, live.layout))
    commit(spark, new)
    return new


def upsert_partitions(updates: DataFrame, path: str, keys: Sequence[str], date_col: str,
                      stored: bool = False) -> list[str]:
    """Upsert ``updates`` into the month-partitioned table at ``path``;
    returns the rewritten month values.  A computed batch is staged first (it
    is read twice); ``stored=True`` says it already is a written table."""
    spark = updates.sparkSession
    if not partitioned_exists(spark, path):
        new = write_months(updates, path, date_col)
        commit(spark, new)
        return sorted(new.writes)
    batch = with_month(updates, date_col)
    if not stored:
        batch = stage(batch, "batch")
    # Partition values only (bounded by the months a batch spans), not rows.
    months = sorted(r[0] for r in batch.select(PARTITION_COL).distinct().collect())
    if months:
        live = live_months(spark, path)
        current = with_month(live.read(spark, months), date_col)
        commit(spark, merged(live, _write(upsert(current, batch, list(keys)), path)))
    return months


def vacuum_partitioned(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Keep the newest ``keep`` pointers and the parts that they name."""
    vacuum(spark, f"{path}/live", keep)
    named = set()
    for version in committed_versions(spark, f"{path}/live"):
        live = live_months(spark, path, version)
        named |= {(w, f"{live.column}={m}") for m, w in live.writes.items()}
    used = {w for w, _ in named}
    fs, data = _fs(spark, f"{path}/data")
    for write in fs.listStatus(data):
        if write.getPath().getName() not in used:
            fs.delete(write.getPath(), True)
            continue
        for month in fs.listStatus(write.getPath()):
            if month.isDirectory() and (write.getPath().getName(), month.getPath().getName()) not in named:
                fs.delete(month.getPath(), True)
