"""Benchmark decontamination (operator 7): Wu-Manber search over words.

An item's windows (``size`` consecutive words; a shorter item is one window) are
the test strings, a word is the symbol.  For the windows of one length a shift
table over hashed blocks of two words says how far the search may skip; where it
says zero, buckets by the hash of the window's last and first block name the
test strings to try, and the words themselves are compared.  A task searches
many stretches of text in step, so every move is one array operation.

Documents never shuffle.  The items, made distinct and cut into stretches, are
broadcast in blocks of at most about ``BLOCK_BYTES`` of text, one scan of the documents
a block, and only hits of several blocks are brought together.

Defined results: null and empty texts have no words; items without words have
no windows; items are told apart by their id as a string (a null id is
``null``), rows of one id are one item; repeated rows give repeated results; an
empty benchmark hits nothing.  Other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.textscan import (U64, Words, alnum_word_table, column_bytes, fold_table, mix,
                                   owners, row_chunks)
from tickmart.sinks.tables import stage

BLOCK_BYTES = 16 << 20
PIECE_WORDS = 4096      # windows of an item that stay together
LANE = 256              # words of text that one lane of the search goes through
WORDS = Words(alnum_word_table(), seed=7)
FOLD = fold_table()


def _blocks(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words that end at each word (the first ones wrap)."""
    return h if width == 1 else mix(np.roll(h, 1) * U64(0x9E3779B97F4A7C15 | 1) + h)


class LengthClass:
    """Shift table and buckets of the different windows of one length."""

    def __init__(self, length: int, hashes: np.ndarray, items: list[list[int]], words: list[list[bytes]]):
        self.length, self.items, self.words = length, items, words
        self.width = min(2, length)
        self.mask = U64((1 << max(10, int(len(items) * length * 4).bit_length())) - 1)
        most = length - self.width + 1
        self.shift = np.full(int(self.mask) + 1, most, np.int64)
        blocks = np.stack([self._block(hashes, q) for q in range(self.width - 1, length)], axis=1)
        for q in range(blocks.shape[1]):
            np.minimum.at(self.shift, (blocks[:, q] & self.mask).astype(np.int64), most - 1 - q)
        bucket = self._bucket(blocks[:, -1], blocks[:, 0])
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order]
        self.hashes = hashes

    def _block(self, hashes: np.ndarray, q: int) -> np.ndarray:
        if self.width == 1:
            return hashes[:, q]
        return mix(hashes[:, q - 1] * U64(0x9E3779B97F4A7C15 | 1) + hashes[:, q])

    @staticmethod
    def _bucket(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return suffix ^ (prefix << U64(1))

    def search(self, h: np.ndarray, first: np.ndarray, stop: np.ndarray):
        """(last word, window) of the occurrences in documents of the words
        [first, stop), up to the comparison of the words' bytes."""
        m = self.length
        lo = first + m - 1
        sizes = np.maximum(stop - lo, 0)
        lanes = -(-sizes // LANE)
        begin = np.repeat(lo - (np.cumsum(lanes) - lanes) * LANE, lanes) + np.arange(lanes.sum()) * LANE
        end = np.minimum(begin + LANE, np.repeat(stop, lanes))
        block = _blocks(h, self.width)
        index = (block & self.mask).astype(np.int64)
        at, found = begin, []
        while len(at):
            skip = self.shift[index[at]]
            found.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
            go = at < end
            at, end = at[go], end[go]
        last = np.concatenate(found) if found else np.zeros(0, np.int64)
        key = self._bucket(block[last], block[last - m + self.width])
        left, right = np.searchsorted(self.bucket, key), np.searchsorted(self.bucket, key, side="right")
        n = right - left
        pair = np.repeat(left - np.cumsum(n) + n, n) + np.arange(n.sum())
        last, window = np.repeat(last, n), self.order[pair]
        same = np.ones(len(last), bool)
        for j in range(m):
            same &= h[last - m + 1 + j] == self.hashes[window, j]
        return last[same], window[same]


class TestStrings:
    """The windows of one block of items, by length."""

    def __init__(self, items: list[tuple[str, str | None]], size: int):
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        held: dict[int, dict[tuple, list]] = {}
        for name, text in items:
            raw = np.frombuffer((text or "").encode("utf-8"), np.uint8)
            start, end, h = WORDS.find(raw, np.array([0, len(raw)]))
            if not len(h):
                continue
            folded = FOLD[raw]
            words = [folded[s:e].tobytes() for s, e in zip(start, end, strict=True)]
            m = min(size, len(words))
            for i in range(len(words) - m + 1):
                entry = held.setdefault(m, {}).setdefault(tuple(words[i:i + m]), [h[i:i + m], set()])
                entry[1].add(number[name])
        self.classes = [LengthClass(m, np.stack([h for h, _ in w.values()]), [sorted(s) for _, s in w.values()],
                                    [list(k) for k in w]) for m, w in sorted(held.items())]

    def occurrences(self, data: np.ndarray, offsets: np.ndarray):
        """(words a document, its first word, [(first word, stop, window's items)])."""
        start, end, h = WORDS.find(data, offsets)
        first = np.searchsorted(start, offsets[:-1])
        stop = np.append(first[1:], len(start))
        hits = []
        for c in self.classes:
            for last, window in zip(*c.search(h, first, stop), strict=True):
                a = last - c.length + 1
                if all(FOLD[data[start[a + j]:end[a + j]]].tobytes() == w for j, w in enumerate(c.words[window])):
                    hits.append((int(a), int(last) + 1, c.items[window]))
        return stop - first, first, hits


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [{"lo": lo, "hi": hi} for lo, hi in out]


SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def _search(batches, strings):
    for batch in batches:
        data, offsets = column_bytes(batch.column(batch.num_columns - 1))
        counts, spans, items = [], [], []
        for lo, hi in row_chunks(offsets):
            own = offsets[lo:hi + 1]
            n, first, hits = strings.value.occurrences(data[own[0]:own[-1]], own - own[0])
            by_row: dict[int, list] = {}
            rows = owners(np.append(first, first[-1] + n[-1]), np.array([a for a, _, _ in hits], np.int64))
            for row, hit in zip(rows.tolist(), hits, strict=True):
                by_row.setdefault(row, []).append(hit)
            for row in range(hi - lo):
                found = by_row.get(row, [])
                counts.append(int(n[row]))
                spans.append(_merged([(a - first[row], b - first[row]) for a, b, _ in found]))
                items.append(sorted({strings.value.names[i] for _, _, held in found for i in held}))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(spans, SPANS),
             pa.array(items, pa.list_(pa.string()))],
            names=[*batch.schema.names[:-1], "n_words", "spans", "items"])


def _pieces(batches, size: int, piece: int):
    """(item id, words): an item in stretches that overlap by ``size - 1`` words, so each of
    its windows is in one of them.  Words keep their bytes, with a space between."""
    for batch in batches:
        names, texts = [], []
        for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = np.frombuffer((text or "").encode("utf-8"), np.uint8)
            start, end, _ = WORDS.find(raw, np.array([0, len(raw)]))
            for lo in range(0, max(1, len(start) - size + 1), piece):
                stop = min(lo + piece + size - 1, len(start))
                if lo < stop:
                    names.append(name)
                    texts.append(" ".join(raw[s:e].tobytes().decode("utf-8") for s, e in zip(start[lo:stop], end[lo:stop], strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["item_id", "text"])


def _item_blocks(benchmark: DataFrame, size: int):
    """Lists of (item id as string, words), each of about BLOCK_BYTES at most, however often
    a row repeats and however long an item is."""
    piece = PIECE_WORDS
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
             .where(F.length("text") > 0).distinct()
             .mapInArrow(lambda batches: _pieces(batches, size, piece), "item_id string, text string").distinct())
    items = stage(items, "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for block in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, text_key (hash of the text), n_words, spans (merged runs [lo, hi)
    of hit words) and items (ids of the items found, sorted) of every row."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", _text_key().alias("text_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = (f"doc_id {kind}, text_key long, n_words long, spans array<struct<lo: long, hi: long>>, "
           "items array<string>")

    def scan(items):
        strings = spark.sparkContext.broadcast(TestStrings(items, size))
        return keyed.mapInArrow(lambda batches: _search(batches, strings), ddl)

    found = [scan(items) for items in _item_blocks(benchmark, size)] or [scan([])]
    if len(found) == 1:
        return found[0]
    hits = found[0].where("size(spans) > 0")
    for more in found[1:]:
        hits = hits.unionByName(more.where("size(spans) > 0"))
    # Of several blocks: a document's spans and items come together; repeated rows are alike.
    together = hits.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.flatten(F.collect_set("spans")).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"))
    rows = found[0].select("doc_id", "text_key", "n_words")
    return (rows.join(together, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
            .select("doc_id", "text_key", "n_words",
                    F.coalesce("_spans", F.lit([]).cast("array<struct<lo: long, hi: long>>")).alias("spans"),
                    F.coalesce("_items", F.lit([]).cast("array<string>")).alias("items")))


def contamination_digests(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    hit = F.size(F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["lo"], s["hi"] - 1))))).cast("long")
    return contamination(docs, benchmark, size).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean_only(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window of an item, all columns kept."""
    bad = stage(contamination(docs, benchmark, size).where("size(spans) > 0")
                .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "contaminated")
    keyed = docs.withColumn("_text_key", _text_key())
    return (keyed.join(bad, keyed["doc_id"].eqNullSafe(bad["_id"]) & (keyed["_text_key"] == bad["_key"]), "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
