"""Slowly changing dimension, type 2, check strategy (SCD-1, SCD-2, SCD-3).

History = dimension columns + ``valid_from, valid_to, is_current``.  A run
compares the open version of each key with the current source row on the
check columns (NULL-safe: NULL -> value is a change):

* unchanged            -> open version kept as is
* changed              -> open version closed at ``batch_ts``, new one opened
* gone from the source -> open version closed (hard-delete invalidation)
* new or returning key -> new version opened

Closed versions never change.  One full outer join of open versions with the
source on the key; a key's history holds one open row, so no group grows with
the number of versions.  Running the same input twice adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = ["valid_from", "valid_to", "is_current"]


def _open(df: DataFrame, batch_ts: str) -> DataFrame:
    return df.select("*", F.lit(batch_ts).cast("timestamp_ntz").alias("valid_from"),
                     F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                     F.lit(True).alias("is_current"))


def row_digest(columns: Sequence[str]) -> Column:
    """One short value that changes if any of ``columns`` does (a NULL is a value)."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def scd2_merge(history: DataFrame | None, source: DataFrame, keys: Sequence[str],
               check_cols: Sequence[str], batch_ts: str,
               invalidate_hard_deletes: bool = True) -> DataFrame:
    """The whole history after a run."""
    if history is None:
        return _open(source, batch_ts)
    return history.where(~F.col("is_current")).unionByName(
        scd2_step(history.where(F.col("is_current")), source, keys, check_cols, batch_ts, invalidate_hard_deletes))


def scd2_step(current: DataFrame | None, source: DataFrame, keys: Sequence[str], check_cols: Sequence[str],
              batch_ts: str, invalidate_hard_deletes: bool = True) -> DataFrame:
    """The versions that a run leaves of the open ones (``current``): open again, or
    closed now.  Versions closed before are not needed."""
    cols = source.columns
    if current is None:
        return _open(source, batch_ts)
    # NULL-safe: a NULL key is a key like any other, not one that returns on every run.
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    j = (current.select(F.struct(*cols, *META).alias("o"))
         .join(source.select(F.struct(*cols).alias("s")), on, "full_outer"))
    ts, never = F.lit(batch_ts).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz")

    def version(side: str, *meta: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols],
                        *[m.alias(name) for name, m in zip(META, meta, strict=True)])

    as_is = version("o", *[F.col(f"o.{m}") for m in META])
    ended = version("o", F.col("o.valid_from"), ts, F.lit(False))
    opened = version("s", ts, never, F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}")) for c in check_cols])
    # One join; each matched pair gives the versions that it leaves behind.
    versions = (F.when(F.col("o").isNull(), F.array(opened))
                .when(F.col("s").isNull(), F.array(ended if invalidate_hard_deletes else as_is))
                .when(same, F.array(as_is))
                .otherwise(F.array(ended, opened)))
    return j.select(F.explode(versions).alias("v")).select("v.*")


def as_of(history: DataFrame, t: str) -> DataFrame:
    """SCD-3: the dimension as it was at time ``t``."""
    ts = F.lit(t).cast("timestamp_ntz")
    return history.where((F.col("valid_from") <= ts)
                         & (F.col("valid_to").isNull() | (F.col("valid_to") > ts)))
