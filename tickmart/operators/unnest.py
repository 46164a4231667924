"""Lateral positional unnest of packed series (J-2).

``prices``, ``market_caps`` and ``total_volumes`` are arrays of
``[unix_ms, value]`` pairs joined on ordinality: the result has as many
points as the shortest array, and a row with an empty array yields nothing.
``arrays_zip`` pads to the longest, so it is cut to the shortest first.
This is a narrow (per-row) operation; no shuffle.  A row is one task's work, so
:func:`sliced` first cuts the long ones and spreads their slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.functions import epoch_ms_to_utc_ts, payload_order

SLICE_POINTS = 4096
_NAMES = ("prices", "market_caps", "total_volumes")


def sliced(raw: DataFrame, points: int = SLICE_POINTS) -> DataFrame:
    """``raw`` with rows of at most ``points`` points and their ``offset`` in the row they
    come from.  Rows that are short already stay where they are; the slices of longer
    ones are dealt by (asset, offset), so one asset's points are many tasks' work."""
    length = F.least(*[F.size(c) for c in _NAMES])
    long = (raw.where(length > points)
            .withColumn("offset", F.explode(F.sequence(F.lit(0), length - 1, F.lit(points))))
            .repartition("coin_id", "offset"))
    cut = long.select(*[F.slice(c, F.col("offset") + 1, points).alias(c) if c in _NAMES else F.col(c) for c in raw.columns],
                      "offset")
    return raw.where(length <= points).withColumn("offset", F.lit(0)).unionByName(cut)


def unnest_series(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """raw series rows -> price points (canonical columns of ``operators.bars``).

    Extra columns named in ``keep`` are carried through.  ``ordinality`` is
    1-based within the whole row (``offset`` of a slice counted in); ``price_ms`` is the
    pair's first element, whole-second truncation happens in ``price_ts``.
    """
    shortest = F.least(*[F.size(c) for c in _NAMES])
    zipped = F.slice(F.arrays_zip(F.col("prices").alias("p"), F.col("market_caps").alias("m"),
                                  F.col("total_volumes").alias("t")), 1, shortest)
    offset = F.col("offset") if "offset" in raw.columns else F.lit(0)
    exploded = raw.select("coin_id", "_ingested_at", *keep,
                          offset.alias("_from"), F.posexplode(zipped).alias("pos", "z"))
    place = F.col("pos") + F.col("_from")
    ms = F.get(F.col("z.p"), 0).cast("long")
    return exploded.select(
        "coin_id", *keep,
        (place + 1).alias("ordinality"),
        ms.alias("price_ms"),
        epoch_ms_to_utc_ts(ms).alias("price_ts"),
        payload_order(ms, F.col("_ingested_at"), place)
        .alias("point_order"),
        F.get(F.col("z.p"), 1).alias("price"),
        F.get(F.col("z.m"), 1).alias("market_cap"),
        F.get(F.col("z.t"), 1).alias("total_volume"),
        "_ingested_at",
    )
