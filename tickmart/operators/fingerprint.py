"""Order-free table fingerprints (JOB-1).

A row's hash is the first 15 hex digits of the MD5 of its values as text; a table's
fingerprint is the count, the sum and the xor of them.  It does not depend on row order
or partitions, merges part by part, needs one scan and no shuffle of rows, and plain SQL
gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TEXT = "~"


def _text(df: DataFrame, name: str) -> Column:
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(c.cast("string"), F.lit(NULL_TEXT))


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    text = F.concat_ws("|", *[_text(df, c) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def fingerprint(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """table_name, n_rows, hash_sum (digits), hash_xor."""
    h = df.select(row_hash(df, columns or df.columns).alias("h"))
    return h.agg(F.count("h").alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x")).select(
        F.lit(name).alias("table_name"), "n_rows", F.coalesce(F.col("s").cast("string"), F.lit("0")).alias("hash_sum"),
        F.coalesce("x", F.lit(0)).cast("long").alias("hash_xor"))


def fingerprint_sql(name: str, source: str, columns: Sequence[str]) -> str:
    """The same numbers in ANSI SQL with ``md5`` (DuckDB)."""
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_TEXT}')" for c in columns)
    return (f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(coalesce(sum(h), 0) AS VARCHAR) AS hash_sum, "
            f"coalesce(bit_xor(h), 0) AS hash_xor FROM (SELECT CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT) AS h "
            f"FROM {source})")
