"""Quality ledger (DQ-1..DQ-6, DQ-8): check results kept part by part.

A table in parts (months of bars, metrics and fact) is checked part by part, and the
counts are kept with the write that the part came from.  The next report opens only the
parts whose write has changed: row checks and key checks run on these, the other counts
come from the ledger.  A key can only meet its like within a part, because the part (the
month) follows from a column of the key; a key check whose columns don't fix the part
goes over the whole table.  Parents of a relationship only gain keys (loads never
delete), so a child part without violations stays so; one with violations is looked at
again.  A table in one piece is one part.

The ledger is a small document: one number for each table, part and check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.operators.quality import REPORT_SCHEMA, WARN, Check, relationship_violations
from tickmart.sinks.partitioned import Months
from tickmart.sinks.tables import publish_document, read_document

WHOLE = "all"


@dataclass
class LedgerTable:
    """A table as the ledger sees it: the write of each part, and how to read some parts
    (with their name in ``_part``).  ``part_by``: the column that fixes the part."""

    writes: dict[str, str]
    read: Callable[[Sequence[str]], DataFrame]
    part_by: str | None = None

    @classmethod
    def of_months(cls, spark: SparkSession, live: Months, date_col: str) -> LedgerTable:
        def read(parts: Sequence[str]) -> DataFrame:
            return live.read(spark, parts).withColumn(
                "_part", F.coalesce(F.date_format(date_col, "yyyy-MM"), F.lit("none")))

        return cls(dict(live.writes), read, date_col)

    @classmethod
    def whole(cls, df: DataFrame, write: str) -> LedgerTable:
        """``write`` names the contents: other contents, another name."""
        return cls({WHOLE: write}, lambda _: df.withColumn("_part", F.lit(WHOLE)))


def _label(c: Check) -> str:
    return f"{c.kind}({c.column_label})"


def _row_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(part, check, violations) of row checks: one pass for all of them."""
    aggs = []
    for k, c in enumerate(checks):
        col = F.col(c.columns[0])
        aggs.append(F.count_if(col.isNull() if c.kind == "not_null" else col < 0).alias(f"_c{k}"))
    pairs = ", ".join(f"'{_label(c)}', _c{k}" for k, c in enumerate(checks))
    return df.groupBy("_part").agg(*aggs).selectExpr("_part", f"stack({len(checks)}, {pairs}) AS (check_id, violations)")


def _key_counts(df: DataFrame, c: Check) -> DataFrame:
    """Keys that stand more than once, by part."""
    cols = list(c.columns)
    keyed = df.where(F.col(cols[0]).isNotNull()) if c.kind == "unique" else df
    repeated = keyed.groupBy("_part", *cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.groupBy("_part").agg(F.count(F.lit(1)).alias("violations")).select(
        "_part", F.lit(_label(c)).alias("check_id"), "violations")


def _orphan_counts(df: DataFrame, c: Check, parent: DataFrame) -> DataFrame:
    """Child rows without a parent, by part."""
    bad = relationship_violations(df, c.columns[0], parent, c.parent_column).select(c.columns[0])
    hits = df.where(F.col(c.columns[0]).isNotNull()).groupBy("_part", c.columns[0]).agg(F.count(F.lit(1)).alias("n"))
    return hits.join(bad, c.columns[0], "left_semi").groupBy("_part").agg(F.sum("n").alias("violations")).select(
        "_part", F.lit(_label(c)).alias("check_id"), "violations")


@dataclass
class QualityLedger:
    spark: SparkSession
    path: str

    def refresh(self, tables: dict[str, LedgerTable], checks: Sequence[Check],
                parents: dict[str, DataFrame] | None = None) -> DataFrame:
        """Check what changed, keep the counts, return the report of all tables.

        ``parents``: smaller tables that hold the keys of a parent (the asset state for the
        bars); else the parent table itself is read."""
        held = read_document(self.spark, self.path) or {}
        by_table: dict[str, list[Check]] = {}
        for c in checks:
            by_table.setdefault(c.table, []).append(c)
        parts, fresh = [], {}
        for name, own in by_table.items():
            table, known = tables[name], held.get(name, {})
            stale = [p for p, w in table.writes.items()
                     if known.get(p, {}).get("write") != w or known[p]["labels"] != sorted(map(_label, own))
                     or any(c.kind == "relationships" and known[p]["counts"].get(_label(c)) for c in own)]
            fresh[name] = stale
            if not stale:
                continue
            df = table.read(stale)
            rows = [c for c in own if c.kind in ("not_null", "non_negative")]
            found = [_row_counts(df, rows)] if rows else []
            for c in own:
                if c.kind == "relationships":
                    parent = (parents or {}).get(c.parent)
                    found.append(_orphan_counts(df, c, tables[c.parent].read(list(tables[c.parent].writes)) if parent is None else parent))
                elif c.kind in ("unique", "unique_combination"):
                    if table.part_by is None or table.part_by in c.columns:
                        found.append(_key_counts(df, c))
                    else:       # its keys meet across parts
                        every = table.read(list(table.writes)).withColumn("_part", F.lit(WHOLE))
                        found.append(_key_counts(every, c))
            parts += [f.select(F.lit(name).alias("table_name"), "_part", "check_id", F.col("violations").cast("long").alias("violations"))
                      for f in found]
        # One number for each stale part and check that has violations.
        counts: dict[tuple[str, str], dict[str, int]] = {}
        if parts:
            for r in reduce(DataFrame.unionByName, parts).where("violations > 0").collect():
                counts.setdefault((r["table_name"], r["_part"]), {})[r["check_id"]] = r["violations"]
        ledger = {}
        for name, own in by_table.items():
            known = held.get(name, {})
            ledger[name] = {p: {"write": w, "labels": sorted(map(_label, own)), "counts": counts.get((name, p), {})}
                            if p in fresh[name] else known[p] for p, w in tables[name].writes.items()}
            # Key checks over the whole table have their count beside those of the parts.
            across = counts.get((name, WHOLE)) if fresh[name] else known.get(WHOLE, {}).get("counts")
            if across and WHOLE not in ledger[name]:
                ledger[name][WHOLE] = {"write": "", "labels": [], "counts": across}
        publish_document(self.spark, self.path, ledger)
        self.opened = fresh
        rows = []
        for c in checks:
            n = sum(p["counts"].get(_label(c), 0) for p in ledger[c.table].values())
            status = "pass" if n == 0 else "warn" if c.severity == WARN else "fail"
            rows.append((c.table, c.kind, c.column_label, c.severity, n, status))
        return self.spark.createDataFrame(rows, REPORT_SCHEMA)
