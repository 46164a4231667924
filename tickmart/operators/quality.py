"""Declarative data-quality checks (DQ-1..DQ-8, J-7, FLT-6).

A check is a query returning violating rows; the report reduces each check
to ``(table_name, check_name, column_name, severity, violations, status)``.
Row-level checks of one table (not-null, non-negative) are evaluated together
in a single aggregation pass; unique / unique-combination / relationship
checks each need one shuffle on their key, and pre-aggregate per key before
it, so a hot value crosses the network as one partial count per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"
REPORT_SCHEMA = ("table_name string, check_name string, column_name string, severity string, "
                 "violations long, status string")


# --- checks returning violating rows --------------------------------------------

def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """DQ-1: non-NULL values seen more than once, with their row count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def unique_combination_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-3: combinations (NULLs included) seen more than once."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def relationship_violations(child: DataFrame, column: str, parent: DataFrame,
                            parent_column: str) -> DataFrame:
    """DQ-4 / J-7: non-NULL child values without a parent, with their row count.

    The child is counted per value before the anti-join, so the join sees one
    row per distinct value.
    """
    values = (child.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")))
    # Parent keys are compared in the child key's type (e.g. text ids vs numbers).
    key_type = child.schema[column].dataType
    parents = (parent.select(F.col(parent_column).try_cast(key_type).alias(column))
               .where(F.col(column).isNotNull())
               .distinct())  # combined map-side: one row per key and task is shuffled
    return values.join(parents, column, "left_anti")


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """DQ-2 as rows."""
    return df.where(F.col(column).isNull())


def non_negative_violations(df: DataFrame, column: str) -> DataFrame:
    """DQ-5 / FLT-6: rows with ``column < 0``; zero and NULL pass."""
    return df.where(F.col(column) < 0)


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """DQ-2 for many columns in one pass: ``(column_name, violations)``."""
    cols = list(columns) if columns is not None else df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, violations)")


# --- report ------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    table: str
    kind: str  # not_null | non_negative | unique | unique_combination | relationships
    columns: tuple[str, ...]
    severity: str = ERROR
    parent: str | None = None  # relationships: parent table name
    parent_column: str | None = None

    @property
    def column_label(self) -> str:
        return ",".join(self.columns)


@dataclass
class QualitySuite:
    """Checks over named tables; ``report`` evaluates them all lazily."""

    tables: dict[str, DataFrame]
    checks: list[Check] = field(default_factory=list)

    def add(self, *checks: Check) -> "QualitySuite":
        self.checks.extend(checks)
        return self

    def report(self) -> DataFrame:
        parts: list[DataFrame] = []
        row_checks: dict[str, list[Check]] = {}
        for c in self.checks:
            if c.kind in ("not_null", "non_negative"):
                row_checks.setdefault(c.table, []).append(c)
            else:
                parts.append(self._keyed(c))
        for table, checks in row_checks.items():
            parts.append(self._row_level(table, checks))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        status = (F.when(F.col("violations") == 0, F.lit("pass"))
                  .when(F.col("severity") == WARN, F.lit("warn")).otherwise(F.lit("fail")))
        return out.withColumn("status", status)

    def _row_level(self, table: str, checks: list[Check]) -> DataFrame:
        df = self.tables[table]
        aggs = []
        for i, c in enumerate(checks):
            col = F.col(c.columns[0])
            cond = col.isNull() if c.kind == "not_null" else col < 0
            aggs.append(F.count_if(cond).alias(f"_c{i}"))
        counts = df.agg(*aggs)
        rows = ", ".join(
            f"'{c.kind}', '{c.column_label}', '{c.severity}', _c{i}" for i, c in enumerate(checks))
        return counts.selectExpr(
            f"'{table}' AS table_name",
            f"stack({len(checks)}, {rows}) AS (check_name, column_name, severity, violations)")

    def _keyed(self, c: Check) -> DataFrame:
        df = self.tables[c.table]
        if c.kind == "unique":
            bad = unique_violations(df, c.columns[0])
        elif c.kind == "unique_combination":
            bad = unique_combination_violations(df, c.columns)
        elif c.kind == "relationships":
            bad = relationship_violations(df, c.columns[0], self.tables[c.parent], c.parent_column)
        else:
            raise ValueError(f"unknown check kind {c.kind}")
        # Failing rows are counted like a test's result set: one per returned row.
        # A relationship test returns every child row without a parent.
        n = bad.agg((F.coalesce(F.sum("n_records"), F.lit(0)) if c.kind == "relationships"
                     else F.count(F.lit(1))).cast("long").alias("violations"))
        return n.select(F.lit(c.table).alias("table_name"), F.lit(c.kind).alias("check_name"),
                        F.lit(c.column_label).alias("column_name"), F.lit(c.severity).alias("severity"),
                        F.col("violations"))


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """DQ-8: raise when any error-severity check failed; returns the report.

    Only the failing rows (at most one per check) reach the driver.
    """
    failed = report.where(F.col("status") == "fail").select(
        "table_name", "check_name", "column_name", "violations").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in failed]
        raise QualityGateError("quality gate failed:\n" + "\n".join(lines))
    return report


def freshness_gate(report: DataFrame) -> DataFrame:
    """Raise when a source is past its error age; returns the report (a row a source)."""
    stale = [r.source_name for r in report.where(F.col("status") == ERROR).select("source_name").collect()]
    if stale:
        raise QualityGateError("sources too old: " + ", ".join(sorted(stale)))
    return report


# --- freshness ------------------------------------------------------------------------

@dataclass(frozen=True)
class Freshness:
    source: str
    loaded_at: str
    warn_after_s: int
    error_after_s: int


def freshness(spark: SparkSession, tables: dict[str, DataFrame], rules: Sequence[Freshness],
              as_of: str) -> DataFrame:
    """DQ-7: age of ``max(loaded_at)`` at ``as_of`` against warn/error limits.

    An age equal to a limit is still within it.  An empty source is 'error'.
    """
    parts = []
    for r in rules:
        m = tables[r.source].agg(F.max(F.col(r.loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
        age = (F.unix_micros(F.lit(as_of).cast("timestamp_ntz").cast("timestamp"))
               - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(1_000_000)
        parts.append(m.select(
            F.lit(r.source).alias("source_name"), "max_loaded_at",
            age.cast("long").alias("age_seconds"),
            F.when(F.col("max_loaded_at").isNull(), F.lit(ERROR))
            .when(age > r.error_after_s, F.lit(ERROR))
            .when(age > r.warn_after_s, F.lit(WARN)).otherwise(F.lit("pass")).alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
