"""Keyed merges of a batch into a table (SNK-1..4, SNK-8, J-8).

``upsert`` = reduce the batch to one row per key (the last one wins, as with
row-by-row ``ON CONFLICT DO UPDATE``), drop the target rows whose key is in
the batch (``left_anti``), append the batch.  The anti-join needs only the
batch's keys: those of a stored batch are broadcast when under the
size limit (``operators.joins.small_side``), so the table streams through
without a shuffle; above it the join is a shuffle join.  Keys are never NULL
(FLT-1 / DQ-2 guard that).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.operators.dedupe import keep_latest
from tickmart.operators.joins import small_side


def latest_per_key(updates: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return keep_latest(updates, list(keys), list(order))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] | None = None, stored: bool = False) -> DataFrame:
    """Insert new keys, overwrite every non-key column of existing ones.

    The keys of a ``stored`` batch are measured and, under the broadcast limit,
    broadcast: the target is then filtered without being shuffled.
    """
    if order:
        updates = latest_per_key(updates, keys, order)
    batch_keys = updates.select(*keys)
    if stored:
        batch_keys = small_side(batch_keys)
    # A USING join lists the keys first; keep the table's own column order.
    kept = target.join(batch_keys, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(updates, allowMissingColumns=True)


def upsert_newer(target: DataFrame, updates: DataFrame, keys: Sequence[str], version: str,
                 stored: bool = False) -> DataFrame:
    """Upsert where a row replaces the stored one only if its ``version`` is
    not older: applying batches in any order (or twice) gives the same table.

    The stored versions are first narrowed to the batch's keys (broadcast,
    size checked), so the comparison join never shuffles the table.
    """
    newest = latest_per_key(updates, keys, [version])
    batch_keys = newest.select(*keys)
    batch_keys = small_side(batch_keys)
    stored = (target.select(*keys, F.col(version).alias("_stored"))
              .join(batch_keys, list(keys), "left_semi"))
    incoming = (newest.join(stored, list(keys), "left")
                .where(F.col("_stored").isNull() | (F.col(version) >= F.col("_stored")))
                .select(*newest.columns))
    return upsert(target, incoming, keys, stored=stored)


def _batch_order(batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """Without a given order, the row of the largest other columns wins."""
    return [f.name for f in batch.schema.fields
            if f.name not in keys and not isinstance(f.dataType, T.MapType)] or list(keys)


def insert_only(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                order: Sequence[str | Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """SNK-4: append rows whose key is new, one a key (the last by ``order``);
    return (result, colliding batch rows).

    Here the batch is the preserved side; the target's keys are joined as is
    (Catalyst sizes them)."""
    fresh = batch.join(target.select(*keys), list(keys), "left_anti").select(*batch.columns)
    fresh = latest_per_key(fresh, keys, order or _batch_order(batch, keys))
    collisions = batch.join(target.select(*keys), list(keys), "left_semi").select(*batch.columns)
    return target.unionByName(fresh, allowMissingColumns=True), collisions


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SNK-8: add every column of ``schema`` missing from ``df`` as typed NULL."""
    have = set(df.columns)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have]
    return df.select("*", *extra) if extra else df
