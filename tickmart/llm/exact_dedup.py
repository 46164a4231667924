"""Exact dedup by progressive refinement (operator 10).

Rows are narrowed by byte length, then by a hash of a text prefix, and only
rows that still share both enter the full-hash grouping.  ``keep_one`` hashes the full
text of these rows alone; ``exact_dedup`` returns the hash of every text, and so takes
all of them in its one scan.  What moves are lengths, hashes and ids.

Defined results: a null text is the empty text, and equal to it; a null
``doc_id`` is smaller than any other; repeated rows (same id and text) are one
group whose every row carries the same verdict; an empty table gives no rows.
Columns other than ``doc_id`` and ``text`` are never looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.operators.joins import small_side
from tickmart.sinks.tables import stage

PREFIX_CHARS = 128


def fingerprints(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """doc_id, n_bytes, prefix_hash, text_sha256 of every row, from one scan."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix_hash"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose ``keys`` occur more than once.

    Counts combine on the map side; the semi join is left to Spark, which
    splits a skewed key (one length can hold a third of all rows).
    """
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    return rows.join(repeated, keys, "left_semi")


def exact_groups(prints: DataFrame) -> DataFrame:
    """text_sha256, n_bytes, keep_id, group_size of every text held by two rows or more."""
    by_length = _shared(prints, ["n_bytes"])
    by_prefix = _shared(by_length, ["n_bytes", "prefix_hash"])
    return (by_prefix.groupBy("n_bytes", "text_sha256")
            .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .where("group_size > 1"))


def exact_dedup(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays.  The fingerprints
    are staged once (about 100 bytes a row), so the text is read once.
    """
    prints = stage(fingerprints(docs, prefix_chars), "exact-prints")
    groups = exact_groups(prints)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (prints.join(groups, ["n_bytes", "text_sha256"], "left")
            .select("doc_id", keep.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``docs`` without the dropped copies, all columns kept; repeated rows of
    one id and text are reduced to one.

    Rows whose length, or length and prefix, no other row has go through unread; the
    full text is hashed only for the rows that are left.  The lengths and prefixes that
    repeat are broadcast while they are few, so texts do not move."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({"_n_bytes": F.octet_length(text), "_prefix": F.xxhash64(F.substring(text, 1, prefix_chars))})
    marks = stage(keyed.select(F.col("_n_bytes").alias("n_bytes"), F.col("_prefix").alias("prefix_hash")), "lengths")
    by_length = _shared(marks, ["n_bytes"])
    again = stage(by_length.groupBy("n_bytes", "prefix_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                  .select(F.col("n_bytes").alias("_n_bytes"), F.col("prefix_hash").alias("_prefix")), "repeated-prefixes")
    sides, key = small_side(again), ["_n_bytes", "_prefix"]
    alone = keyed.join(sides, key, "left_anti")
    sha = F.sha2(text.cast("binary"), 256)
    left = keyed.join(sides, key, "left_semi").withColumn("_sha", sha)
    kept = stage(left.groupBy("_n_bytes", "_sha").agg(F.max("doc_id").alias("_keep")), "kept-copies")
    # A text's rows with the id that stays, once: (text, id) spreads a text's many copies.
    same = (F.col("l._sha") == F.col("k._sha")) & F.col("l.doc_id").eqNullSafe(F.col("k._keep"))
    first = (left.alias("l").join(kept.alias("k"), same, "left_semi")
             .dropDuplicates(["doc_id", "_sha"]))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return alone.select(*columns).unionByName(first.select(*columns))
