"""Registry of driver queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Driver-facing results use comparison-friendly types on both sides: decimals
are returned as DOUBLE (both engines round a decimal to the nearest double)
and dates as timestamps at midnight, because pandas conversions of decimals
and dates differ between Spark and DuckDB.  The library functions themselves
keep their decimal and date types.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.session import configure

SAMPLE_DIR = "/root/testdata/sf0.001"
_VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is DuckDB SQL over the same parquet views."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(configure(spark), sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run

    return deco


@functools.cache
def comparable_oracles(sample_dir: str = SAMPLE_DIR) -> dict[str, str]:
    """Oracle SQL with DECIMAL columns cast to DOUBLE and DATE to TIMESTAMP.

    The column types come from DuckDB's ``DESCRIBE`` of each query over the
    small sample tables (binding only); without them the SQL is unchanged.
    """
    try:
        import duckdb

        con = duckdb.connect()
        for t in _VIEWS:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sample_dir}/{t}.parquet')")
    except Exception:  # noqa: BLE001 - no sample data: plain SQL
        return dict(ORACLES)
    out = {}
    for name, sql in ORACLES.items():
        try:
            desc = con.execute(f"DESCRIBE {sql}").fetchall()
        except Exception:  # noqa: BLE001
            out[name] = sql
            continue
        casts = [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c, t, *_ in desc if t.startswith("DECIMAL")]
        casts += [f'CAST("{c}" AS TIMESTAMP) AS "{c}"' for c, t, *_ in desc if t == "DATE"]
        out[name] = (f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql}\n) AS oracle"
                     if casts else sql)
    return out
