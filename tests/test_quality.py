"""DQ-1..8, J-7, FLT-6."""

import pytest
from conftest import rows, ts

from tickmart.operators import quality as Q


def test_row_checks(spark):
    df = spark.createDataFrame([(1, 0.0, "a"), (1, -1.0, None), (None, None, "c"), (3, 2.0, "d")],
                               "k long, x double, s string")
    assert rows(Q.unique_violations(df, "k")) == [(1, 2)]                 # NULL is not a duplicate
    assert rows(Q.unique_combination_violations(df, ["k"])) == [(1, 2)]
    assert rows(Q.null_counts(df)) == [("k", 1), ("s", 1), ("x", 1)]
    assert [r.x for r in Q.non_negative_violations(df, "x").collect()] == [-1.0]   # 0, NULL pass
    assert Q.not_null_violations(df, "s").count() == 1
    parent = spark.createDataFrame([("1",), ("x",)], "id string")
    assert rows(Q.relationship_violations(df, "k", parent, "id")) == [(3, 1)]  # NULL child skipped


def test_report_severity_and_gate(spark):
    t = spark.createDataFrame([(1, "a"), (1, None)], "k long, s string")
    suite = Q.QualitySuite({"t": t}, [
        Q.Check("t", "unique", ("k",)), Q.Check("t", "not_null", ("s",), Q.WARN),
        Q.Check("t", "not_null", ("k",)), Q.Check("t", "non_negative", ("k",)),
    ])
    rep = {(r.check_name, r.column_name): (r.violations, r.status) for r in suite.report().collect()}
    assert rep == {("unique", "k"): (1, "fail"), ("not_null", "s"): (1, "warn"),
                   ("not_null", "k"): (0, "pass"), ("non_negative", "k"): (0, "pass")}
    with pytest.raises(Q.QualityGateError, match="unique"):
        Q.gate(suite.report())
    ok = Q.QualitySuite({"t": t}, [Q.Check("t", "not_null", ("s",), Q.WARN)])
    assert Q.gate(ok.report()).count() == 1


def test_row_level_checks_share_one_pass(spark):
    t = spark.createDataFrame([(1, 2)], "a long, b long")
    suite = Q.QualitySuite({"t": t}, [Q.Check("t", "not_null", ("a",)), Q.Check("t", "not_null", ("b",)),
                                      Q.Check("t", "non_negative", ("a",))])
    plan = suite.report()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1          # the table is scanned once
    assert plan.count("Aggregate") == 1


def test_freshness_thresholds(spark):
    def src(t):
        return spark.createDataFrame([(ts(t),)], "loaded timestamp_ntz")

    tables = {"at12": src("2024-01-01 00:00:00"), "over12": src("2023-12-31 23:59:59"),
              "old": src("2023-12-30 00:00:00"),
              "empty": spark.createDataFrame([], "loaded timestamp_ntz")}
    rules = [Q.Freshness(n, "loaded", 12 * 3600, 24 * 3600) for n in tables]
    got = {r.source_name: r.status for r in Q.freshness(spark, tables, rules, "2024-01-01 12:00:00").collect()}
    assert got == {"at12": "pass", "over12": "warn", "old": "error", "empty": "error"}
