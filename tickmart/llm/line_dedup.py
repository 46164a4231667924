"""Line dedup (operator 3): range-partitioned line hashes, first occurrences
streamed, compressed per-document keep bitmaps instead of text.

A line's key is the line without white space at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points that ``min_docs`` documents hold lose
all their lines except in the document of the largest id.

Per eligible line 128 bits of hash, the document's key and the line's place are
staged, range-partitioned by (hash, document descending) and streamed in that
order (``sorted_runs``); only dropped places go on, and become one bitmap a
document.  Text moves once, when the bitmaps are applied.

Defined results: a null or empty text is one empty line; a null ``doc_id`` is
smaller than any other; rows with one id but different texts are different
rows that count as one document; repeated rows give repeated results; an empty
table gives no rows.  Other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.sorted_runs import later_owners
from tickmart.llm.textscan import SPACE_BYTES
from tickmart.sinks.tables import stage

NULL_ID = -(2**63)


def _owner() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _eligible(raw: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """(place, key) of the lines whose key is long enough."""
    out = []
    for i, line in enumerate(raw.split(b"\n")):
        key = line.strip(SPACE_BYTES)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8")) >= min_chars):
            out.append((i, key.lower()))  # bytes.lower folds A-Z only
    return out


def _line_rows(batches, min_chars: int):
    for batch in batches:
        owner, text_key, texts = batch.columns
        who, at, high, low = [], [], [], []
        for row, raw in enumerate(texts.cast(pa.binary())):
            if not (raw := raw.as_py()):
                continue
            for i, key in _eligible(raw, min_chars):
                who.append(row)
                at.append(i)
                high.append(xxhash.xxh3_64_intdigest(key, 1))
                low.append(xxhash.xxh3_64_intdigest(key, 2))
        idx = pa.array(who, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(high, np.uint64).view(np.int64)), pa.array(np.array(low, np.uint64).view(np.int64)),
             owner.take(idx), text_key.take(idx), pa.array(at, pa.int64())],
            names=["h1", "h2", "owner", "text_key", "place"])


def _bitmap(places: list[int]) -> bytes:
    """Deflated bitmap up to the last dropped line: bit 1 keeps, 0 drops."""
    keep = np.ones((max(places) // 8 + 1) * 8, bool)
    keep[places] = False
    return zlib.compress(np.packbits(keep).tobytes())


def _bitmaps(batches):
    for batch in batches:
        owner, text_key, places = batch.columns
        found = [sorted(set(p)) for p in places.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [owner, text_key, pa.array([len(p) for p in found], pa.int64()),
             pa.array([_bitmap(p) for p in found], pa.binary())],
            names=["owner", "text_key", "n_dropped", "keep_bitmap"])


def line_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """owner, text_key, n_dropped, keep_bitmap of the documents that lose lines.

    ``owner`` is doc_id (null: the least long), ``text_key`` a hash of the text;
    lines behind the bitmap's end stay.
    """
    lines = stage(
        docs.select(_owner().alias("owner"), _text_key().alias("text_key"), "text")
        .mapInArrow(lambda it: _line_rows(it, min_chars),
                    "h1 long, h2 long, owner long, text_key long, place long"), "lines")
    dropped = later_owners(lines, ["h1", "h2"], "owner", ["text_key", "place"], min_docs,
                           "line-runs", descending=True)
    # One row a document; a list is never longer than its document has lines.
    return (dropped.groupBy("owner", "text_key").agg(F.collect_list("place").alias("places"))
            .mapInArrow(_bitmaps, "owner long, text_key long, n_dropped long, keep_bitmap binary"))


def kept_text(raw: bytes, bitmap: bytes | None) -> tuple[bytes, int]:
    """The text without its dropped lines, and how many lines it had."""
    lines = raw.split(b"\n")
    n = len(lines)
    if bitmap:
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
        lines = [x for i, x in enumerate(lines) if i >= len(keep) or keep[i]]
    return b"\n".join(lines), n


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with n_dropped and keep_bitmap (null: all stays)."""
    keyed = docs.select("doc_id", "text", _owner().alias("owner"), _text_key().alias("text_key"))
    return keyed.join(bitmaps, ["owner", "text_key"], "left")


def _digests(batches):
    for batch in batches:
        ids, texts, dropped, maps = batch.columns
        n_lines, shas = [], []
        for raw, bitmap in zip(texts.cast(pa.binary()), maps, strict=True):
            kept, n = kept_text(raw.as_py() or b"", bitmap.as_py())
            n_lines.append(n)
            shas.append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n_lines, pa.int64()), dropped, pa.array(shas, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def line_dedup_digests(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row of ``docs``."""
    marked = with_bitmaps(docs, line_bitmaps(docs, min_chars, min_docs))
    return (marked.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                          F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep_bitmap")
            .mapInArrow(_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"))
