"""Staging projections: snapshot standardisation (PRJ-3), bridge cleanup (PRJ-4).

Missing text becomes ``'Unknown'`` (then trimmed; spaces only), missing
numbers 0, and missing dates/timestamps the run's ``as_of`` (a parameter, not
the wall clock, so reruns are reproducible).  A value that was there but did not
fit its column (``rejected_fields``) is not missing: it stays NULL.
``market_cap_rank`` and ``total_volume`` are cast but not rounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.functions import number_or_zero, text_or_unknown
from tickmart.operators.dedupe import keep_latest
from tickmart.fixed import SNAPSHOT_RULES
from tickmart.schemas import RAW_NUM, TOTAL



def _rule(raw: str, rule: str, as_of_date: str, as_of_ts: str):
    c = F.col(raw)
    if rule == "text":
        return text_or_unknown(c)
    if rule == "round":
        return F.round(number_or_zero(c.cast(RAW_NUM)), 2).cast(TOTAL)
    if rule == "number":
        return number_or_zero(c.cast(RAW_NUM)).cast(RAW_NUM)
    if rule == "date":
        return F.coalesce(c.cast("date"), F.lit(as_of_date).cast("date"))
    return F.coalesce(c.cast("timestamp_ntz"), F.lit(as_of_ts).cast("timestamp_ntz"))


def standardise_snapshot(raw: DataFrame, as_of_date: str, as_of_ts: str) -> DataFrame:
    """PRJ-3 + TOP-2: one staged row per raw id (newest ingest wins)."""
    one = keep_latest(raw, ["id"], [F.col("_ingested_at"), F.col("last_updated")])

    def staged(src: str, rule: str):
        value = _rule(src, rule, as_of_date, as_of_ts)
        if rule == "text" or "rejected_fields" not in raw.columns:
            return value
        return F.when(~F.coalesce(F.array_contains("rejected_fields", src), F.lit(False)), value)

    return one.select(*[staged(src, rule).alias(dst) for dst, src, rule in SNAPSHOT_RULES])


def standardise_categories(raw: DataFrame) -> DataFrame:
    """PRJ-4: trimmed ids/categories, naive ingest timestamp."""
    return raw.select(
        F.trim(F.col("coin_id").cast("string")).alias("coin_id"),
        F.trim(F.col("category").cast("string")).alias("category"),
        F.col("_ingested_at").cast("timestamp_ntz").alias("_ingested_at"),
    )
