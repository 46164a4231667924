"""STR-3: drop repeats of an id while the watermark still covers it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str,
                            lateness: str) -> DataFrame:
    timed = stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
    return (timed.withWatermark("_event_time", lateness)
            .dropDuplicatesWithinWatermark(list(keys)).drop("_event_time"))
