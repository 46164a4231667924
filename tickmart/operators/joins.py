"""Broadcast only behind a size check.

Key sets derived at run time (a load batch's keys, the assets an increment
touches) are usually small, but Catalyst cannot know: their statistics are
those of the large tables they come from, so it would shuffle the large side.
``small_side`` measures the bytes of the key set (an action over the small
derived set, staged by its callers, not the large table) and hints a broadcast
only when they are under the limit; above it the join stays a shuffle join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BYTES_CONF = "tickmart.broadcast.maxBytes"
DEFAULT_MAX_BYTES = 64 << 20
# A row of a broadcast hash relation beside its text: pointer, header and null
# bits, and a word for each column.
ROW_BYTES, COLUMN_BYTES = 32, 16


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES)))


def broadcast_bytes(keys: DataFrame) -> int:
    """Bytes that ``keys`` takes when it is broadcast."""
    fixed = F.lit(ROW_BYTES + COLUMN_BYTES * len(keys.columns))
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in keys.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return keys.agg(F.sum(reduce(lambda a, b: a + b, text, fixed).cast("long"))).first()[0] or 0


def small_side(keys: DataFrame) -> DataFrame:
    """``keys`` with a broadcast hint if it takes at most the limit's bytes."""
    return F.broadcast(keys) if broadcast_bytes(keys) <= broadcast_limit(keys) else keys
