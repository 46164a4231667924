"""SCD-1..3: history with check columns, hard deletes, returns, reruns."""

from conftest import d, rows
from hypothesis import given, settings, strategies as st

from tickmart.operators.scd2 import as_of, scd2_merge

S = "coin_id string, category string, coin_name string, symbol string, first_seen_date date"
KEYS, CHECK = ["coin_id", "category"], ["coin_name", "symbol", "first_seen_date"]


def run(spark, versions):
    h = None
    for i, v in enumerate(versions):
        src = spark.createDataFrame(v, S)
        h = scd2_merge(h, src, KEYS, CHECK, f"2024-01-0{i + 1} 00:00:00")
        h = spark.createDataFrame(h.collect(), h.schema)   # materialise like a published table
    return h


def test_history_cases(spark):
    v1 = [("a", "L1", "A", "AA", None), ("b", "L1", "B", "BB", d("2024-01-01")),
          ("c", "L1", "C", "CC", d("2024-01-01"))]
    v2 = [("a", "L1", "A", "AA", d("2024-01-01")),       # NULL -> value
          ("b", "L1", "B", "BX", d("2024-01-01"))]       # changed; c removed
    v3 = v2 + [("c", "L1", "C", "CC", d("2024-01-01"))]  # c returns
    h = run(spark, [v1, v2, v3, v3])                     # last load twice
    got = rows(h, "coin_id", "symbol", "valid_from", "valid_to", "is_current")
    t1, t2, t3 = (f"2024-01-0{i} 00:00:00" for i in (1, 2, 3))
    assert [(c, s, str(f), None if to is None else str(to), cur) for c, s, f, to, cur in got] == [
        ("a", "AA", t1, t2, False), ("a", "AA", t2, None, True),
        ("b", "BB", t1, t2, False), ("b", "BX", t2, None, True),
        ("c", "CC", t1, t2, False), ("c", "CC", t3, None, True),
    ]
    mid = as_of(h, "2024-01-02 12:00:00")
    assert rows(mid, "coin_id", "symbol") == [("a", "AA"), ("b", "BX")]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["x", "y", None])),
                min_size=1, max_size=4))
def test_intervals_disjoint_one_open_per_key(spark, versions):
    vs = [[(k, "c", "n", s, None) for k, s in v.items()] for v in versions]
    h = run(spark, vs).collect()
    by_key = {}
    for r in h:
        by_key.setdefault(r.coin_id, []).append(r)
    for k, hist in by_key.items():
        hist.sort(key=lambda r: r.valid_from)
        assert sum(r.is_current for r in hist) <= 1
        for a, b in zip(hist, hist[1:]):
            assert a.valid_to is not None and a.valid_to <= b.valid_from
    current = {r.coin_id for r in h if r.is_current}
    assert current == set(versions[-1])


def test_without_hard_delete_invalidation_gone_keys_stay_open(spark):
    v1 = spark.createDataFrame([("a", "L1", "A", "AA", None), ("b", "L1", "B", "BB", None)], S)
    v2 = spark.createDataFrame([("a", "L1", "A", "AX", None)], S)
    h = scd2_merge(None, v1, KEYS, CHECK, "2024-01-01 00:00:00")
    h = scd2_merge(h, v2, KEYS, CHECK, "2024-01-02 00:00:00", invalidate_hard_deletes=False)
    got = rows(h, "coin_id", "symbol", "is_current")
    assert got == [("a", "AA", False), ("a", "AX", True), ("b", "BB", True)]


def test_closed_parts_are_never_written_again(spark):
    from tickmart.session import scratch_dir
    from tickmart.sinks.history import merge_history, read_as_of, read_history
    from tickmart.sinks.partitioned import live_months, vacuum_partitioned

    path = scratch_dir(spark, "t_history")
    versions = [[("a", "L1", "A", "1", None), ("b", "L1", "B", "1", None)],
                [("a", "L1", "A", "2", None), ("b", "L1", "B", "1", None)],
                [("a", "L1", "A", "2", d("2024-01-01"))], [("a", "L1", "A", "2", d("2024-01-01"))], []]
    seen, whole = {}, None
    for i, v in enumerate(versions):
        ts, src = f"2024-01-0{i + 1} 00:00:00", spark.createDataFrame(v, S)
        live = merge_history(path, src, KEYS, CHECK, ts)
        whole = scd2_merge(whole, src, KEYS, CHECK, ts)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        key = ["coin_id", "valid_from"]
        assert sorted(map(tuple, read_history(spark, path).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str), key
        for part, write in live.writes.items():
            if part != "open":
                assert seen.setdefault(part, write) == write
        vacuum_partitioned(spark, path, keep=1)
    assert len(seen) == 3 and "open" not in live_months(spark, path).writes
    at = read_as_of(spark, path, "2024-01-02 12:00:00")
    assert rows(at, "coin_id", "symbol") == [("a", "2"), ("b", "1")]
    assert not any("closed-20240102" in f for f in at.inputFiles())
