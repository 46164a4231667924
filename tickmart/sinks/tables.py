"""Versioned parquet tables (SNK-5, SNK-7, SNK-9).

A table is a folder of versions ``v0000000001/``, ``v0000000002/``...; a
version counts once Spark's job commit wrote its ``_SUCCESS`` marker, and
readers take the highest committed one.  A failed or half-written run leaves
an uncommitted folder that nobody reads, so every publish is all-or-nothing,
and a job may read version n while writing n+1 (reading and overwriting one
path is not possible in Spark).  Paths go through the Hadoop FileSystem API,
so the same code works on local disk, HDFS or object stores.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"^v(\d{10})$")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, table_path: str, committed_only: bool) -> list[int]:
    fs, root = _fs(spark, table_path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        m = _VERSION.match(st.getPath().getName())
        if not (st.isDirectory() and m):
            continue
        if committed_only:
            marker = spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if not fs.exists(marker):
                continue
        out.append(int(m.group(1)))
    return sorted(out)


def committed_versions(spark: SparkSession, table_path: str) -> list[int]:
    return _versions(spark, table_path, committed_only=True)


def version_path(table_path: str, version: int) -> str:
    return f"{table_path.rstrip('/')}/v{version:010d}"


def table_exists(spark: SparkSession, table_path: str) -> bool:
    return bool(committed_versions(spark, table_path))


def publish(df: DataFrame, table_path: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version of the table; returns its path.

    The version number skips past every folder present, committed or not, so
    a retried publish never writes into a failed attempt's folder.
    """
    spark = df.sparkSession
    existing = _versions(spark, table_path, committed_only=False)
    out = version_path(table_path, (existing[-1] if existing else 0) + 1)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)
    return out


def read_table(spark: SparkSession, table_path: str, version: int | None = None) -> DataFrame:
    """Read the latest (or a given) committed version."""
    versions = committed_versions(spark, table_path)
    if not versions:
        raise FileNotFoundError(f"no committed version under {table_path}")
    v = versions[-1] if version is None else version
    if v not in versions:
        raise FileNotFoundError(f"version {v} of {table_path} is not committed")
    return spark.read.parquet(version_path(table_path, v))


def publish_document(spark: SparkSession, path: str, document: dict) -> None:
    """Write a small JSON document (a pointer, an index) as the next version of ``path``,
    by the same rule: it counts once its ``_SUCCESS`` is there."""
    existing = _versions(spark, path, committed_only=False)
    out = version_path(path, (existing[-1] if existing else 0) + 1)
    for name, text in (("document.json", json.dumps(document, sort_keys=True)), ("_SUCCESS", "")):
        fs, p = _fs(spark, f"{out}/{name}")
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def read_document(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The latest (or a given) committed document; None without one."""
    versions = committed_versions(spark, path)
    if not versions:
        return None
    fs, p = _fs(spark, f"{version_path(path, versions[-1] if version is None else version)}/document.json")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def vacuum(spark: SparkSession, table_path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` committed versions and any failed
    attempt older than them; returns the removed version numbers."""
    committed = committed_versions(spark, table_path)
    if len(committed) <= keep:
        return []
    floor = committed[-keep]
    removed = []
    fs, _ = _fs(spark, table_path)
    for v in _versions(spark, table_path, committed_only=False):
        if v < floor:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(version_path(table_path, v)), True)
            removed.append(v)
    return removed


def schema_name(custom_schema: str | None, default_schema: str) -> str:
    """SNK-7: the custom schema trimmed, else the target's default."""
    return default_schema if custom_schema is None else custom_schema.strip()


def layer_path(root: str, table: str, custom_schema: str | None = None,
               default_schema: str = "public") -> str:
    return f"{root.rstrip('/')}/{schema_name(custom_schema, default_schema)}/{table}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared scratch root and read it
    back: cuts lineage (recovery restarts from the files) and freezes a result
    whose inputs are about to be overwritten."""
    from tickmart.session import scratch_dir

    spark = df.sparkSession
    path = scratch_dir(spark, f"stage-{name}")
    df.write.parquet(path)
    return spark.read.parquet(path)
