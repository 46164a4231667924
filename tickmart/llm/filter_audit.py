"""Filter interaction audit (operator 13): count-weighted decision diagrams.

Every text fails some of the filters A to E; its set of failures is a mask.  Masks
are counted by part with grouped sums, so a part is at most 32 counts however
many documents it holds.  From them a task builds one decision diagram a part:
level by level a filter, a "pass" and a "fail" edge, equal subdiagrams shared,
and every node carries the documents, good and toxic ones below it.  All orders of
the filters are reached from one another by swaps of two adjacent levels, which
rewrite only these levels.  In each order the steps are read off the all-pass
path: the fail edge of its k-th node holds what step k removes.

Filters: A under 50 words; B 100 * distinct words < 65 * words; C 100 * capitals
A-Z > 5 * code points; D holds one of ``#$%&*|``; E the text of a smaller doc_id,
anywhere in the table.

Defined results: a null text is empty (it fails A, and E behind a smaller id with an
empty text); a null part is the part ''; rows without an id never fail E and make
nobody fail it; rows of one id and text don't fail E by each other; an id without
labels is neither good nor toxic, several labels of one id count if one of them is
1; an empty table has no parts and so no rows.  Only the named columns are looked
at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.sinks.tables import stage

FILTERS = "ABCDE"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DUPLICATE = 1 << FILTERS.index("E")
AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
         "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_masks(docs: DataFrame, part: str) -> DataFrame:
    """doc_id, part, sha, mask (bits A to D) and the number of equal rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                        text.alias("text"), F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"))
    n, chars = F.size("w"), F.char_length("text")
    capitals = chars - F.char_length(F.translate("text", CAPITALS, ""))
    fails = [n < 50, 100 * F.size(F.array_distinct("w")) < 65 * n, 100 * capitals > 5 * chars,
             F.col("text").rlike(r"[#$%&*|]")]
    mask: Column = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return (words.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
                         mask.alias("mask"))
            .groupBy("doc_id", "part", "sha", "mask").agg(F.count(F.lit(1)).alias("rows")))


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: at most 32 rows a part.

    Which rows fail E is settled by (text, id): the smallest id of each text, found with
    partial minima, is joined on both, so the copies of one text are spread by their ids."""
    rows = stage(text_masks(docs, part), "masks")
    known = rows.where("doc_id IS NOT NULL")
    firsts = known.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    later = F.when(F.col("first").isNull(), DUPLICATE).otherwise(0)
    judged = (known.join(firsts, ["sha", "doc_id"], "left").join(marks, "doc_id", "left")
              .select("part", (F.col("mask") + later).alias("mask"), "rows",
                      F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad")))
    nameless = rows.where("doc_id IS NULL").select("part", "mask", "rows", F.lit(0).alias("good"), F.lit(0).alias("bad"))
    return judged.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("good")).alias("good"),
        F.sum(F.col("rows") * F.col("bad")).alias("toxic"))


class Diagram:
    """Shared decision diagram of one part.  A node is (pass, fail); a leaf is the
    triple (documents, good, toxic) of one mask."""

    def __init__(self, counts: dict[int, tuple[int, int, int]], filters: str = FILTERS):
        self.order = list(range(len(filters)))
        self.filters = filters
        self.nodes: dict[tuple, tuple] = {}     # structure -> the one node that has it
        self.sums: dict[int, tuple] = {}        # node identity -> (documents, good, toxic) below
        self.root = self._grow(counts, 0, 0)

    def node(self, passed, failed):
        held = self.nodes.setdefault((id(passed), id(failed)), (passed, failed))
        if id(held) not in self.sums:
            self.sums[id(held)] = tuple(a + b for a, b in zip(self.total(passed), self.total(failed), strict=True))
        return held

    def leaf(self, triple):
        held = self.nodes.setdefault(("leaf", triple), ("leaf", triple))
        self.sums[id(held)] = triple
        return held

    def total(self, node) -> tuple[int, int, int]:
        return self.sums[id(node)]

    def _grow(self, counts, level, mask):
        if level == len(self.filters):
            return self.leaf(counts.get(mask, (0, 0, 0)))
        return self.node(self._grow(counts, level + 1, mask), self._grow(counts, level + 1, mask | 1 << level))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below it."""
        done = {}

        def rebuilt(node, depth):
            if id(node) not in done:
                passed, failed = node
                if depth < level:
                    done[id(node)] = self.node(rebuilt(passed, depth + 1), rebuilt(failed, depth + 1))
                else:
                    done[id(node)] = self.node(self.node(passed[0], failed[0]), self.node(passed[1], failed[1]))
            return done[id(node)]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self):
        """(filter, triple kept, triple removed) down the all-pass path."""
        node = self.root
        for f in self.order:
            passed, failed = node
            yield f, self.total(passed), self.total(failed)
            node = passed

    def only(self, f: int) -> int:
        """Documents that fail ``f`` and nothing else."""
        node = self.root
        for g in self.order:
            node = node[1] if g == f else node[0]
        return self.total(node)[0]


def adjacent_swaps(n: int) -> list[int]:
    """Levels to swap, one after another, to see every order of n once: the last
    element moves through each order of the others, to and fro."""
    if n < 2:
        return []
    out, down = [], True
    sweep = list(range(n - 2, -1, -1))
    for inner in [*adjacent_swaps(n - 1), None]:
        out += sweep if down else sweep[::-1]
        if inner is not None:
            out.append(inner + 1 if down else inner)
        down = not down
    return out


def audit_rows(part: str, counts: dict[int, tuple[int, int, int]]) -> list[tuple]:
    d = Diagram(counts)
    width = len(FILTERS)
    fails = [sum(c[0] for m, c in counts.items() if m >> f & 1) for f in range(width)]
    only = [d.only(f) for f in range(width)]
    seen, shapley = [], [0] * width
    for level in [None, *adjacent_swaps(width)]:
        if level is not None:
            d.swap(level)
        steps = list(d.steps())
        for f, _, removed in steps:
            shapley[f] += removed[0]
        seen.append(("".join(FILTERS[f] for f in d.order), steps))
    return [(part, name, k + 1, kept[0], out[0], fails[f] - out[0], only[f], out[1], out[2], shapley[f])
            for name, steps in seen for k, (f, kept, out) in enumerate(steps)]


def _audits(batches):
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    names, kinds = zip(*(x.split() for x in AUDIT.split(", ")), strict=True)
    for batch in batches:
        for part, masks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = audit_rows(part, {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks})
            yield pa.RecordBatch.from_arrays([pa.array(v, types[k]) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                             names=list(names))


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step (600 rows a part)."""
    counts = mask_counts(docs, labels, part)
    whole = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return whole.mapInArrow(_audits, AUDIT)
