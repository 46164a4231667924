"""Suffix-array dedup (operator 4): bytes covered by a ``length``-byte string that
also starts earlier (smaller doc_id, or same document and earlier start).

A round a byte of whole documents would be 100,000 rounds over the whole corpus,
so the columns are cut to where a repeat can be:

1. Each ``length``-byte window has one anchor, its ``GRAM``-byte substring of the
   smallest hash, leftmost of ties.  Equal windows have equal anchors at equal
   offsets.  The windows of one anchor are a span; a row (anchor hash, span hash,
   place) stands for about 35 windows.  Equal spans are settled by their hashes:
   all but the first are removed whole.
2. Spans that share an anchor but differ may share some windows (edges of copied
   passages).  Their bytes, about 130, are the documents of the column-wise
   construction (``columnwise``): a round inserts one symbol a string into the
   Burrows-Wheeler transform of a bucket of strings and updates the common
   prefixes; windows whose common prefix reaches ``length`` are equal, and all but
   the first are removed.  A key with very many strings is not given to one task:
   its windows are hashed and grouped instead.
3. The removed runs of a document come together and are cut from its text.

Within a map task an equal span is shuffled once, so a passage that a third of
all documents hold costs a row a task, not a row a document.

Defined results: a null text has no bytes; a null doc_id is the smallest; rows
of one doc_id with different texts are ordered by a hash of the text; repeated
rows are one document with one result each; texts shorter than ``length`` lose
nothing; an empty table gives no rows.  Other columns are never looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.columnwise import equal_windows
from tickmart.llm.textscan import (POWERS, SEGMENT, U64, byte_table, column_bytes, mix, prefix_sums,
                                   row_chunks, span_hash)
from tickmart.sinks.tables import stage

GRAM = 32
NULL_ID = -(2**63)
PLACE_BITS = 22                     # of a place within a piece of text
BUCKET_STRINGS = 4096               # strings a column-wise construction takes, on average
HOT_STRINGS = 1024                  # of one key; more are grouped window by window
TABLE_A, TABLE_B = byte_table(101), byte_table(202)
IDS = ["owner", "text_key"]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, anchor's place, first window, last window, anchor hash, span hash) of
    concatenated documents of less than 2^PLACE_BITS bytes together."""
    n, none = len(data), np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(U64), none.astype(U64)
    _, down = POWERS.to(n + 1)
    a = prefix_sums(data, TABLE_A)
    h = mix((a[gram:] - a[:-gram]) * down[: n - gram + 1])
    place = U64((1 << PLACE_BITS) - 1)
    low, size, wide = (h & ~place) | np.arange(len(h), dtype=U64), 1, length - gram + 1
    while size * 2 <= wide:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if wide > size:
        low = np.minimum(low[: size - wide], low[wide - size:])
    inside = np.zeros(n + 1, np.int64)          # windows that lie within one document
    sizes = np.diff(offsets)
    np.add.at(inside, offsets[:-1][sizes >= length], 1)
    np.add.at(inside, (offsets[1:] - length + 1)[sizes >= length], -1)
    start = np.flatnonzero(np.cumsum(inside)[: len(low)])
    at = (low[start] & place).astype(np.int64)
    if not len(start):
        return none, none, none, none, none.astype(U64), none.astype(U64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    begin = np.flatnonzero(fresh)
    first, last = start[begin], start[np.append(begin[1:], len(start)) - 1]
    at = at[begin]
    row = np.searchsorted(offsets, first, side="right") - 1
    b = prefix_sums(data, TABLE_B)
    return row, at, first, last, h[at], span_hash(b, first, last + length)


def _pieces(offsets: np.ndarray, length: int):
    """(first row, stop row, begin, stop) of pieces of about SEGMENT bytes: whole
    rows, or parts of a long row that overlap by length - 1 bytes."""
    for lo, hi in row_chunks(offsets):
        begin, stop = int(offsets[lo]), int(offsets[hi])
        if hi - lo > 1 or stop - begin <= 2 * SEGMENT:
            yield lo, hi, begin, stop
            continue
        while begin < stop:
            yield lo, hi, begin, min(begin + SEGMENT + length - 1, stop)
            begin += SEGMENT


# A row of the anchor table: ``extent`` 0 is an anchor at ``place`` whose windows
# ``left`` .. ``left - count + 1`` bytes before it make up the span; any other is a
# settled run of ``extent`` bytes at ``place``.
ANCHOR_COLUMNS = [("gram", "long"), ("span", "long"), *((c, "long") for c in IDS), ("place", "long"),
                  ("left", "int"), ("count", "int"), ("extent", "int")]
DDL = ", ".join(f"{c} {t}" for c, t in ANCHOR_COLUMNS)
ARROW = pa.schema([(c, pa.int64() if t == "long" else pa.int32()) for c, t in ANCHOR_COLUMNS])


def _table(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(cols[f.name]), f.type) for f in ARROW], schema=ARROW)


def merged_runs(row: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Touching or overlapping [start, stop) of each row as one, sorted."""
    if not len(row):
        return row, start, stop
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    begin = np.ones(len(row), bool)
    # Stops seen so far, lifted by row so that a row's first run always begins anew.
    lift = (np.cumsum(np.diff(row, prepend=row[0]) != 0)) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    begin[1:] = start[1:] + lift[1:] > reach[:-1]
    first = np.flatnonzero(begin)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], reach[last] - lift[last]


def _anchor_rows(batches, length: int, gram: int):
    for batch in batches:
        ids = [np.asarray(batch.column(i)) for i in range(2)]
        data, offsets = column_bytes(batch.column(2))
        found = []
        for lo, hi, begin, stop in _pieces(offsets, length):
            own = np.clip(offsets[lo:hi + 1], begin, stop) - begin
            row, at, first, last, g, s = anchors(data[begin:stop], own, length, gram)
            base = begin - offsets[lo + row]
            found.append((row + lo, at + base, first + base, last + base, g, s))
        if not found:
            continue
        row, at, first, last, g, s = (np.concatenate(x) for x in zip(*found, strict=True))
        # Equal spans of this batch: the first goes on, the others are settled here.
        rank = np.empty(batch.num_rows, np.int64)
        rank[np.lexsort((ids[1], ids[0]))] = np.arange(batch.num_rows)
        order = np.lexsort((first, rank[row]))
        with np.errstate(over="ignore"):
            key = mix(g ^ (s * U64(0x9E3779B97F4A7C15))) + (at - first).astype(U64)
        order = order[np.argsort(key[order], kind="stable")]
        again = np.zeros(len(key), bool)
        same = key[order][1:] == key[order][:-1]
        again[order[1:][same]] = True
        r, a, b = merged_runs(row[again], first[again], last[again] + length)
        go = ~again
        n, m = int(go.sum()), len(r)
        zero, none = np.zeros(n, np.int32), np.zeros(m, np.int32)
        yield _table(gram=g[go].view(np.int64), span=s[go].view(np.int64), owner=ids[0][row[go]],
                     text_key=ids[1][row[go]], place=at[go], left=(at - first)[go],
                     count=(last - first + 1)[go], extent=zero)
        if m:  # settled runs only pass through the exchange; the id spreads them
            yield _table(gram=ids[1][r], span=none, owner=ids[0][r], text_key=ids[1][r], place=a,
                         left=none, count=none, extent=b - a)


def _settle(batches, length: int):
    """Sorted anchor rows -> settled runs (extent > 0) and the first anchor of
    each span whose gram has several spans (extent 0)."""
    last = held = None      # (gram, span, left) of the last anchor; first of its gram, not yet out
    many = False            # the last gram has several spans
    for batch in batches:
        cols = {f.name: np.asarray(c) for f, c in zip(ARROW, batch.columns, strict=True)}
        run = cols["extent"] > 0
        if run.any():
            yield batch.filter(pa.array(run))
        batch = batch.filter(pa.array(~run))
        if not batch.num_rows:
            continue
        gram, span, left = (np.asarray(batch.column(n)) for n in ("gram", "span", "left"))
        new_gram, new_span = np.ones(len(gram), bool), np.ones(len(gram), bool)
        new_gram[1:] = gram[1:] != gram[:-1]
        new_span[1:] = new_gram[1:] | (span[1:] != span[:-1]) | (left[1:] != left[:-1])
        if last is not None:
            new_gram[0] = gram[0] != last[0]
            new_span[0] = new_gram[0] or span[0] != last[1] or left[0] != last[2]
        group = np.cumsum(new_gram)                     # 0: the last batch's gram goes on
        spans = np.bincount(group, new_span, minlength=group[-1] + 1)
        several = spans > 1
        several[0] = many or (held is not None and spans[0] > 0)
        if held is not None and (several[0] or len(spans) > 1):
            if several[0]:
                yield held
            held = None
        out = new_span & several[group]
        tail = group[-1]
        if not several[tail] and new_span[group == tail].any():
            held = batch.slice(int(np.flatnonzero(new_gram)[-1]), 1)
        if out.any():
            yield batch.filter(pa.array(out))
        copy = ~new_span
        if copy.any():
            place, n = np.asarray(batch.column("place"))[copy], np.asarray(batch.column("count"))[copy]
            zero = np.zeros(len(n), np.int32)
            yield _table(gram=gram[copy], span=span[copy], owner=np.asarray(batch.column("owner"))[copy],
                         text_key=np.asarray(batch.column("text_key"))[copy], place=place - left[copy],
                         left=zero, count=zero, extent=n + length - 1)
        last, many = (gram[-1], span[-1], left[-1]), bool(several[tail])


# A string of the column-wise construction: bytes at ``start`` of a document that
# hold windows of one key (the half of the window around the anchor).
STRING_DDL = "k1 long, k2 long, owner long, text_key long, start long, body binary"


def _strings(batches, length: int, gram: int):
    """Bytes of the open anchors, in two parts: windows that hold the ``half`` bytes
    before the anchor, and windows that hold as many behind it."""
    half = (length - gram) // 2
    for batch in batches:
        owner, text_key, texts, opened = batch.columns
        out: list[tuple] = []
        for i, (raw, items) in enumerate(zip(texts.cast(pa.binary()), opened.to_pylist(), strict=True)):
            raw = raw.as_py()
            for x in items:
                at, top = x["place"], x["left"]
                low = top - x["count"] + 1
                for side, lo, hi in ((b"<", max(low, half), top), (b">", low, min(top, half - 1))):
                    if lo > hi:
                        continue
                    core = raw[at - half: at + gram] if side == b"<" else raw[at: at + length - half + 1]
                    key = hashlib.blake2b(side + core, digest_size=16).digest()
                    out.append((key, i, at - hi, raw[at - hi: at - lo + length]))
        keys = np.frombuffer(b"".join(x[0] for x in out), np.int64).reshape(-1, 2)
        idx = pa.array([x[1] for x in out], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(keys[:, 0])), pa.array(np.ascontiguousarray(keys[:, 1])),
             owner.take(idx), text_key.take(idx), pa.array([x[2] for x in out], pa.int64()),
             pa.array([x[3] for x in out], pa.binary())],
            names=["k1", "k2", "owner", "text_key", "start", "body"])


def _bucket_runs(table: pa.Table, length: int) -> pa.Table:
    """Runs covered by windows that start earlier in another string of the bucket."""
    table = table.sort_by([(c, "ascending") for c in [*IDS, "start"]])
    data, offsets = column_bytes(table.column("body").combine_chunks())
    starts = np.asarray(table.column("start"))
    # Strings are in order of document and place, so the first of equal windows is
    # the one of the smallest (document, place).
    doc = np.cumsum(np.append(False, np.any([np.diff(np.asarray(table.column(c))) != 0 for c in IDS], axis=0))) \
        if table.num_rows else np.zeros(0, np.int64)
    string, at = equal_windows(data, offsets, length, doc, starts)
    row, a, b = merged_runs(string, starts[string] + at, starts[string] + at + length)
    take = pa.array(row)
    return pa.table({**{c: table.column(c).take(take) for c in IDS}, "place": pa.array(a, pa.int64()),
                     "extent": pa.array(b - a, pa.int64())})


def _windows(batches, length: int):
    """(window hash, document, place) of every window of hot strings."""
    for batch in batches:
        data, offsets = column_bytes(batch.column("body"))
        for lo, hi in row_chunks(offsets):
            own = offsets[lo:hi + 1] - offsets[lo]
            body = data[offsets[lo]:offsets[hi]]
            n = np.maximum(np.diff(own) - length + 1, 0)
            row = np.repeat(np.arange(hi - lo), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            first = own[row] + at
            hashes = [span_hash(prefix_sums(body, t), first, first + length).view(np.int64) for t in (TABLE_A, TABLE_B)]
            take = pa.array(row + lo)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(h) for h in hashes), batch.column("owner").take(take), batch.column("text_key").take(take),
                 pa.array(np.asarray(batch.column("start"))[row + lo] + at, pa.int64())],
                names=["h1", "h2", *IDS, "place"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("owner"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")


def removed_runs(docs: DataFrame, length: int = 100, gram: int = GRAM) -> DataFrame:
    """owner, text_key, place, extent of the removed runs; they may overlap."""
    keyed = _keyed(docs)
    # Repeated rows are one document; texts only move for it where there are any.
    if not keyed.groupBy(*IDS).count().where("count > 1").isEmpty():
        keyed = keyed.dropDuplicates(IDS)
    rows = keyed.mapInArrow(lambda it: _anchor_rows(it, length, gram), DDL)
    order = ["gram", "span", "left", *IDS, "place"]
    settled = stage(rows.repartition("gram").sortWithinPartitions(*order)
                    .mapInArrow(lambda it: _settle(it, length), DDL), "anchors")
    runs = settled.where("extent > 0").select(*IDS, "place", F.col("extent").cast("long").alias("extent"))

    opened = (settled.where("extent = 0").groupBy(*IDS)
              .agg(F.collect_list(F.struct("place", "left", "count")).alias("opened")))
    strings = stage(keyed.join(opened, IDS).select(*IDS, "text", "opened")
                    .mapInArrow(lambda it: _strings(it, length, gram), STRING_DDL), "strings")
    counts = stage(strings.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "string-keys")
    total = counts.where(F.col("n") <= HOT_STRINGS).agg(F.sum("n")).first()[0] or 0
    buckets = -(-total // BUCKET_STRINGS) or 1
    warm = (strings.join(counts.where(F.col("n") <= HOT_STRINGS), ["k1", "k2"])
            .select(F.pmod(F.xxhash64("k1"), F.lit(buckets)).alias("bucket"), *IDS, "start", "body")
            .groupBy("bucket").applyInArrow(lambda t: _bucket_runs(t, length),
                                            "owner long, text_key long, place long, extent long"))
    windows = (strings.join(counts.where(F.col("n") > HOT_STRINGS).select("k1", "k2"), ["k1", "k2"])
               .mapInArrow(lambda it: _windows(it, length), "h1 long, h2 long, owner long, text_key long, place long"))
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct(*IDS, "place")).alias("first"))
    hot = (windows.join(first, ["h1", "h2"]).where(F.struct(*IDS, "place") != F.col("first"))
           .select(*IDS, "place", F.lit(length).cast("long").alias("extent")))
    return runs.unionByName(warm).unionByName(hot)


def _cut(batches):
    for batch in batches:
        ids, texts, runs = batch.columns
        sizes, removed, spans, shas = [], [], [], []
        for raw, found in zip(texts.cast(pa.binary()), runs.to_pylist(), strict=True):
            raw = raw.as_py() or b""
            n = len(found or [])
            a = np.array([x["place"] for x in found or []], np.int64)
            b = a + np.array([x["extent"] for x in found or []], np.int64)
            _, a, b = merged_runs(np.zeros(n, np.int64), a, b)
            sha, at = hashlib.sha256(), 0
            for start, stop in zip(a.tolist(), b.tolist(), strict=True):
                sha.update(raw[at:start])
                at = stop
            sha.update(raw[at:])
            sizes.append(len(raw))
            removed.append(int((b - a).sum()))
            spans.append(len(a))
            shas.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(shas, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup_digests(docs: DataFrame, length: int = 100, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``."""
    # A document's runs are at most one for every few bytes of its text.
    runs = removed_runs(docs, length, gram).groupBy(*IDS).agg(F.collect_list(F.struct("place", "extent")).alias("runs"))
    doc_id = F.when(F.col("owner") != NULL_ID, F.col("owner")).alias("doc_id")
    return (_keyed(docs).join(runs, IDS, "left").select(doc_id, "text", "runs")
            .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
