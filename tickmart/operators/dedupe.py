"""Keep-one-per-key, top-N and set difference (TOP-2, TOP-3, TOP-4, SET-1).

``keep_first``/``keep_latest`` are ``row_number() = 1`` per key: Catalyst
plans a partial ``WindowGroupLimit`` before the shuffle, so each map task
ships at most one row per key and a hot key is reduced before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _keep_one(df: DataFrame, keys, order: list[Column], key_names=None) -> DataFrame:
    key_cols = _cols(keys)
    if key_names:
        df = df.select("*", *[k.alias(n) for k, n in zip(key_cols, key_names)])
        key_cols = _cols(key_names)
    w = Window.partitionBy(*key_cols).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return out.drop(*key_names) if key_names else out


def keep_first(df: DataFrame, keys: Sequence, order: Sequence, key_names=None) -> DataFrame:
    """TOP-4: the smallest row by ``order`` per key (e.g. first in payload order)."""
    return _keep_one(df, keys, [c.asc_nulls_first() for c in _cols(order)], key_names)


def keep_latest(df: DataFrame, keys: Sequence, order: Sequence, key_names=None) -> DataFrame:
    """TOP-2: ``DISTINCT ON (key)`` made deterministic: the largest row by ``order``."""
    return _keep_one(df, keys, [c.desc_nulls_last() for c in _cols(order)], key_names)


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """TOP-3: first ``n`` rows by ``order`` (plans as ``TakeOrderedAndProject``:
    each task keeps its own top ``n``, the driver merges ``n x tasks`` rows)."""
    return df.orderBy(*order).limit(n)


def missing_keys(requested: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    """SET-1: requested keys with no fetched row."""
    return requested.join(fetched.select(key).distinct(), key, "left_anti")
