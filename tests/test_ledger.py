"""Quality ledger: the report after an increment equals the full one; only changed parts are opened."""

import datetime as dt

from conftest import rows

from tickmart.operators.ledger import LedgerTable, QualityLedger
from tickmart.operators.quality import WARN, Check, QualitySuite
from tickmart.session import scratch_dir
from tickmart.sinks.partitioned import live_months, read_partitioned, replace_partitioned, upsert_partitions

S = "k string, d date, v int"
CHECKS = [Check("t", "not_null", ("v",), WARN), Check("t", "non_negative", ("v",)), Check("t", "unique_combination", ("k", "d")),
          Check("t", "unique", ("v",)), Check("t", "relationships", ("k",), parent="p", parent_column="id"),
          Check("p", "unique", ("id",)), Check("p", "not_null", ("id",))]


def row(k, month, day, v):
    return (k, dt.date(2024, month, day), v)


def test_ledger_equals_the_full_report(spark):
    path, ledger = scratch_dir(spark, "t_ledger_table"), QualityLedger(spark, scratch_dir(spark, "t_ledger"))
    start = [row("a", 1, 1, 5), row("a", 1, 1, 6), row("b", 1, 2, None), row("x", 2, 1, -1), row("a", 2, 2, 7), ("a", None, 5)]
    replace_partitioned(spark.createDataFrame(start, S), path, "d")

    def check(parents, version, opened):
        parent = spark.createDataFrame([(p,) for p in parents], "id string")
        months = LedgerTable.of_months(spark, live_months(spark, path), "d")
        got = ledger.refresh({"t": months, "p": LedgerTable.whole(parent, version)}, CHECKS)
        want = QualitySuite({"t": read_partitioned(spark, path), "p": parent}, CHECKS).report()
        assert rows(got) == rows(want.select(*got.columns))
        assert (sorted(ledger.opened["t"]), ledger.opened["p"]) == opened

    check(["a", "b"], "1", (["2024-01", "2024-02", "none"], ["all"]))
    check(["a", "b"], "1", (["2024-02"], []))                       # an orphan is looked at again
    upsert_partitions(spark.createDataFrame([row("b", 3, 1, 7), row("c", 3, 2, None)], S), path, ["k", "d"], "d")
    check(["a", "b", "x", "x"], "2", (["2024-02", "2024-03"], ["all"]))
    check(["a", "b", "c", "x"], "3", (["2024-03"], ["all"]))
    check(["a", "b", "c", "x"], "3", ([], []))
