"""Asset universe (SRC-6): comma-separated id lists -> distinct ids.

Each entry is trimmed (and lower-cased unless told not to); blanks are
dropped; a repeated id keeps its first occurrence (line order, then position).
The universe is applied with a ``left_semi`` join; stored, it has a known size and
Catalyst broadcasts it when that is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.operators.dedupe import keep_first


def parse_universe(lines: DataFrame, text_col: str = "value", order_col: str | None = None,
                   lower: bool = True) -> DataFrame:
    """-> ``coin_id`` (string) plus ``list_order`` (order of first occurrence)."""
    line_order = F.col(order_col) if order_col else F.lit(0)
    entries = lines.select(line_order.alias("_line"),
                           F.posexplode(F.split(F.col(text_col), ",")).alias("_pos", "_raw"))
    cleaned = F.trim(F.col("_raw"))
    if lower:
        cleaned = F.lower(cleaned)
    ids = entries.select("_line", "_pos", cleaned.alias("coin_id")).where(F.col("coin_id") != "")
    first = keep_first(ids, ["coin_id"], ["_line", "_pos"])
    return first.select("coin_id", F.struct("_line", "_pos").alias("list_order"))


def restrict_to_universe(df: DataFrame, universe: DataFrame, key: str = "coin_id",
                         any_case: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` (compared as text) is in the universe; with
    ``any_case``, a lower-cased universe also takes ids written in upper case."""
    ids = universe.select(F.col("coin_id").alias("_uid"))
    text = F.col(key).cast("string")
    return df.join(ids, (F.lower(text) if any_case else text) == F.col("_uid"), "left_semi")
