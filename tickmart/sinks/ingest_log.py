"""Raw series by ingest batch: append-only, pruned before a file is opened.

Each load is a part of its own (``batch=<stamp>``) under the pointer of
``sinks.partitioned``; nothing stored is rewritten.  A key that comes again is in
several batches and the newest one counts; a batch whose keys have all come again is
dropped from the pointer, so re-sent rolling windows do not pile up.

``batches`` is the log's index, one row a batch: the range of point times that its
rows cover.  A reader that needs some days opens only the batches that overlap them,
and from newer batches the key columns alone (to leave out rows sent again).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickmart.operators.joins import small_side
from tickmart.sinks.partitioned import Months, _write, commit, live_months, partitioned_exists
from tickmart.sinks.tables import publish_document, read_document

BATCH = "batch"


def batch_name(batch_ts: str) -> str:
    """A stamp as a part name that sorts by time."""
    return "".join(ch for ch in str(batch_ts) if ch.isdigit()).ljust(20, "0")


@dataclass
class IngestLog:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    def exists(self) -> bool:
        return partitioned_exists(self.spark, self.path)

    def live(self) -> Months:
        return live_months(self.spark, self.path)

    def batches(self) -> list[str]:
        """Live batches, oldest first."""
        return sorted(self.live().writes)

    def _index(self) -> dict[str, list]:
        """Range of point times of each live batch (two numbers each)."""
        return read_document(self.spark, f"{self.path}/index") or {}

    def _keys_of(self, live: Months, batches: Sequence[str]) -> DataFrame:
        """Key columns and batch of the rows of some batches; the arrays are not read."""
        parts = [live.read(self.spark, [b]).select(*self.keys, F.lit(b).alias(BATCH)) for b in batches]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def append(self, rows: DataFrame, batch_ts: str, times: str = "prices") -> Months:
        """Store ``rows`` (one a key) as the batch of ``batch_ts``; running the same
        batch again replaces it."""
        name, seen = batch_name(batch_ts), Observation("times")
        at = F.transform(times, lambda p: F.get(p, 0).cast("long"))
        rows = rows.observe(seen, F.min(F.array_min(at)).alias("first"), F.max(F.array_max(at)).alias("last"))
        new = _write(rows.withColumn(BATCH, F.lit(name)), self.path, f"{BATCH}:{','.join(self.keys)}")
        old = self.live() if self.exists() else Months(self.path, new.schema, {}, {}, new.layout)
        writes, counts = {**old.writes, **new.writes}, {**old.rows, **new.rows}
        live = Months(self.path, new.schema, writes, counts, new.layout)
        if len(writes) > 1:
            newest = self._keys_of(live, sorted(writes)).groupBy(*self.keys).agg(F.max(BATCH).alias(BATCH))
            current = {r[0] for r in newest.select(BATCH).distinct().collect()}
            live.writes = {b: w for b, w in writes.items() if b in current}
            live.rows = {b: counts[b] for b in live.writes}
        index = self._index()
        if name in new.writes:
            index[name] = [seen.get["first"], seen.get["last"]]
        publish_document(self.spark, f"{self.path}/index", {b: index.get(b, [None, None]) for b in live.writes})
        commit(self.spark, live)
        return live

    def read(self, batches: Sequence[str] | None = None) -> DataFrame:
        """The current row of each key that is in ``batches`` (all live ones by default):
        rows whose key came again in a newer batch are left out."""
        live = self.live()
        wanted = sorted(live.writes if batches is None else set(batches) & set(live.writes))
        if not wanted:
            return self.spark.createDataFrame([], live.schema)
        newer = [b for b in sorted(live.writes) if b >= wanted[0]]
        if newer == wanted and len(wanted) == 1:
            return live.read(self.spark, wanted)
        newest = self._keys_of(live, newer).groupBy(*self.keys).agg(F.max(BATCH).alias("_newest"))
        sides, out = small_side(newest), None
        for b in wanted:
            part = live.read(self.spark, [b])
            if b != newer[-1]:
                part = part.join(sides.where(F.col("_newest") == b).drop("_newest"), list(self.keys), "left_semi").select(*part.columns)
            out = part if out is None else out.unionByName(part)
        return out

    def overlapping(self, first_ms: int, last_ms: int) -> list[str]:
        """Live batches that may hold a point between the two times."""
        index = self._index()
        return [b for b in self.batches()
                if b not in index or index[b][0] is None or (index[b][0] <= last_ms and index[b][1] >= first_ms)]
