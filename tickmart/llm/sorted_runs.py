"""Runs of equal keys in a range-partitioned, sorted table.

``runs_of`` range-partitions rows by (key, owner) and streams every partition in
that order.  A hot key is therefore cut into several partitions, each of which
sees only a part of its run; what a partition cannot settle alone (its first
and last run) is settled by joining with a summary of those edge runs, at most
two rows a partition.  No task ever holds a run in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.sinks.tables import stage


def _stream(batches: Iterator[pa.RecordBatch], n_keys: int, need: int,
            schema: pa.Schema, skip: int = 1) -> Iterator[pa.RecordBatch]:
    """Rows (kind, key..., owner, payload..., n_owners, first_owner).

    ``kind`` 0: the run has ``need`` owners, and the row is not of the first
    ``skip`` (0 or 1) of them; 1: a row of an edge run, which another partition may go on with; 2: summary
    of an edge run: how many owners it has here, and the first of them.
    """
    open_key = None                     # the run that the last batch ended in
    first_owner = last_owner = None
    seen = 0                            # its owners so far
    first_run = True                    # the partition's first run still goes on
    waiting: list[list[pa.Array]] = []  # rows of the open run that lacks owners yet
    nulls = len(schema) - 1 - n_keys - 1 - 2

    def batch_of(cols: list[pa.Array], kind: int) -> pa.RecordBatch:
        n = len(cols[0])
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *cols, none, none],
                                          schema=schema)

    def summary() -> pa.RecordBatch:
        one = [*open_key, last_owner, *[None] * nulls, seen, first_owner]
        return pa.RecordBatch.from_arrays(
            [pa.array([2], pa.int8()), *(pa.array([None if x is None else int(x)], pa.int64()) for x in one)],
            schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = batch.columns
        key, owner = [np.asarray(c) for c in cols[:n_keys]], np.asarray(cols[n_keys])
        new_key = np.zeros(len(owner), bool)
        for k in key:
            new_key[1:] |= k[1:] != k[:-1]
        new_key[0] = open_key is None or any(k[0] != o for k, o in zip(key, open_key, strict=True))
        new_owner = new_key.copy()
        new_owner[1:] |= owner[1:] != owner[:-1]
        new_owner[0] |= owner[0] != last_owner
        begin = np.flatnonzero(new_key)
        run = np.cumsum(new_key)        # 0: the open run goes on
        steps = np.cumsum(new_owner)
        place = steps - np.concatenate(([1 - seen], steps[begin]))[run]  # of the owner in its run
        most = np.zeros(len(begin) + 1, np.int64)
        np.maximum.at(most, run, place)
        most[0] = max(most[0], seen - 1)
        edge = (run == (open_key is None)) if first_run else np.zeros(len(owner), bool)
        later = ~edge & (place >= skip)
        enough = most[run] >= need - 1

        if waiting and most[0] >= need - 1:
            yield from (batch_of(w, 0) for w in waiting)
            waiting = []
        elif len(begin):
            waiting = []
        for mask, kind in ((later & enough, 0), (edge, 1)):
            if mask.any():
                idx = pa.array(np.flatnonzero(mask))
                yield batch_of([c.take(idx) for c in cols], kind)
        lacking = later & ~enough & (run == run[-1])
        if lacking.any():
            idx = pa.array(np.flatnonzero(lacking))
            waiting.append([c.take(idx) for c in cols])

        stops = begin[1:] if open_key is None else begin
        if first_run and len(stops):    # the first run ended within this batch
            stop = stops[0]
            if open_key is None:
                open_key, first_owner = [k[0] for k in key], owner[0]
            if stop:
                seen, last_owner = int(place[stop - 1]) + 1, owner[stop - 1]
            yield summary()
            first_run = False
        if len(begin):
            open_key, first_owner = [k[begin[-1]] for k in key], owner[begin[-1]]
        seen, last_owner = int(place[-1]) + 1, owner[-1]
    if open_key is not None:
        yield summary()
        yield from (batch_of(w, 1) for w in waiting)


def later_owners(rows: DataFrame, key: list[str], owner: str, payload: list[str], need: int,
                 name: str, descending: bool = False, skip: int = 1) -> DataFrame:
    """Rows (owner, payload...) of the keys that ``need`` owners or more hold,
    without the rows of each key's first owner (the largest if ``descending``;
    with ``skip`` 0, all rows).

    ``key``, ``owner`` and ``payload`` are longs, the first two without nulls.
    Stage the input first: range partitioning reads it twice.
    """
    cols = [*key, owner, *payload]
    schema = pa.schema([("kind", pa.int8()), *((c, pa.int64()) for c in [*cols, "n_owners", "first_owner"])])
    ddl = ", ".join(["kind byte", *(f"`{c}` long" for c in [*cols, "n_owners", "first_owner"])])
    n_keys = len(key)
    order = [*(F.col(c) for c in key), F.col(owner).desc() if descending else F.col(owner)]
    ordered = rows.select(*cols).repartitionByRange(*order).sortWithinPartitions(*order)
    found = stage(ordered.mapInArrow(lambda it: _stream(it, n_keys, need, schema, skip), ddl), name)
    # A run cut between partitions: the owners of its parts add up (equal key and
    # owner are never cut apart), its first owner is the first of any part.
    edges = (found.where("kind = 2").groupBy(*key)
             .agg(F.sum("n_owners").alias("n"),
                  (F.max if descending else F.min)("first_owner").alias("first"))
             .where(F.col("n") >= need).select(*key, "first"))
    late = found.where("kind = 1").join(edges, key)
    late = late.where(F.col(owner) != F.col("first")) if skip else late
    return found.where("kind = 0").select(owner, *payload).unionByName(late.select(owner, *payload))
