"""Reusable column expressions.

Ordering keys: "first/last point of the day" needs a total order over
(timestamp, tie-break).  A struct ordering key would force Spark onto a
sort-based aggregate, so the parts are packed into one ``decimal(38,0)``
that keeps ``min_by``/``max_by`` hash-aggregated and mergeable map-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickmart.fixed import UNKNOWN_TEXT
from tickmart.schemas import money

_D0 = "decimal(38,0)"


def _dec(c: Column) -> Column:
    return c.cast(_D0)


def _pow10(n: int) -> Column:
    return F.expr(f"CAST(1{'0' * n} AS DECIMAL(38,0))")


def event_order(ts: Column, tiebreak: Column) -> Column:
    """Total order by (ts, tiebreak): micros * 1e20 + (tiebreak + 2^63).

    ``tiebreak`` is any long; realistic timestamps (|micros| < 1e17) fit.
    """
    micros = F.unix_micros(ts.cast("timestamp"))
    shifted = _dec(tiebreak) + F.expr("CAST(9223372036854775808 AS DECIMAL(38,0))")
    return _dec(micros) * _pow10(20) + shifted


def payload_order(ms: Column, ingested_at: Column, position: Column) -> Column:
    """Total order of unpacked payload points: (epoch ms, ingest time, position).

    The source orders by whole seconds and leaves points inside one second
    in arbitrary order; ordering by the untruncated millis refines that, the
    later ingest then the later array position break the remaining ties.
    Digits: ms < 1e14 (beyond, the decimal overflows), ingest micros < 1e17,
    position < 1e7; a point outside raises, as its order would be wrong.
    """
    ingest_us = F.unix_micros(ingested_at.cast("timestamp"))
    outside = (ingest_us < 0) | (ingest_us >= 10**17) | (position < 0) | (position >= 10**7)
    order = _dec(ms) * _pow10(24) + _dec(ingest_us) * _pow10(7) + _dec(position)
    error = F.raise_error(F.lit("a point's ingest time or array position does not fit its order key"))
    return F.when(outside, error.cast(_D0)).otherwise(order)


def epoch_ms_to_seconds(ms: Column) -> Column:
    """``ms::bigint / 1000``: long division truncating toward zero."""
    return _long_div(ms.cast("long"), 1000)


def _long_div(a: Column, b: int) -> Column:
    # (a - a % b) is an exact multiple of b; % keeps the sign of a (Java),
    # so the quotient truncates toward zero.
    return ((a - a % F.lit(b)) / F.lit(b)).cast("long")


def epoch_ms_to_utc_ts(ms: Column) -> Column:
    """``to_timestamp(ms::bigint / 1000)`` as a UTC wall-clock ``timestamp_ntz``."""
    return F.timestamp_seconds(epoch_ms_to_seconds(ms)).cast("timestamp_ntz")


def epoch_ms_to_utc_date(ms: Column) -> Column:
    return F.to_date(epoch_ms_to_utc_ts(ms))


def round_to(c: Column, scale: int = 2) -> Column:
    """Half-away-from-zero rounding in decimal, cast to the fixed money type."""
    return F.round(c, scale).cast(money(scale))


def text_or_unknown(c: Column) -> Column:
    """``trim(coalesce(text, 'Unknown'))`` (trims spaces only)."""
    return F.trim(F.coalesce(c.cast("string"), F.lit(UNKNOWN_TEXT)))


def number_or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def non_blank(c: Column) -> Column:
    """Predicate: value present and not the empty string (falsy ids dropped)."""
    return c.isNotNull() & (c.cast("string") != F.lit(""))
