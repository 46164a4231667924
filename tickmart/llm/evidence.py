"""Small helpers for posteriors from grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def level_sums(rows: DataFrame, keys: list[str], values: list[str], prefix: str) -> DataFrame:
    """Rows and sums of ``values`` by ``keys``, named ``<prefix>n``, ``<prefix><value>``.
    Sums combine on the map side, so a hot key costs a row a task."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}n"),
                                   *(F.sum(v).alias(f"{prefix}{v}") for v in values))


def shrunk(total: Column, n: Column, own: Column, prior: Column, strength) -> Column:
    """Mean of the others of a group (own value left out), shrunk to ``prior`` as
    if ``strength`` rows of the prior had been seen."""
    return (total - own + strength * prior) / (n - 1 + strength)


def logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))
