"""Byte-level BPE encoding and decoding (operator 8), two tiers.

Tier one: a minimal perfect hash over the vocabulary resolves every pre-token
that is a vocabulary entry as a whole.  Tier two: the others are merged with a
heap over a linked list of bytes, O(n log n) for a pre-token of n bytes; short
ones go through the same merges many at a time, as array operations.

A narrow map: no shuffle.  The vocabulary tables are broadcast; their size is
that of the vocabulary file (checked against ``MAX_VOCABULARY_BYTES``).  Results
of pre-tokens seen before come from a cache of bounded size per worker.

Defined results: a null text is the empty text (no ids); other columns, and a
null ``doc_id``, pass through untouched; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tickmart.llm.textscan import SEGMENT, byte_table, column_bytes, mix, row_chunks, span_hash, value_sums

MAX_VOCABULARY_BYTES = 64 << 20
CACHE_ENTRIES = 400_000
CACHE_IDS = 4 << 20
SHORT = 48                  # bytes up to which misses are merged many at once


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash by displacement: key -> slot in [0, n), plus the
    keys by slot for the one comparison that tells members from strangers.

    Keys fall into buckets; a bucket of several keys gets the first seed that
    sends them to free slots, largest buckets first; a bucket of one key then
    simply names one of the slots left.
    """

    TRIES = 256

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 2)
        self.seed = np.zeros(self.buckets, np.uint64)
        self.named = np.full(self.buckets, -1, np.int64)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        groups: dict[int, list[int]] = {}
        for i, b in enumerate((hashes % np.uint64(self.buckets)).tolist()):
            groups.setdefault(b, []).append(i)
        free = np.ones(n, bool)
        key_at = np.zeros(n, np.int64)
        for b, members in sorted(groups.items(), key=lambda g: -len(g[1])):
            if len(members) == 1:
                break
            for first in range(0, 1 << 24, self.TRIES):
                seeds = np.arange(first, first + self.TRIES, dtype=np.uint64)
                slots = self._slots(hashes[members], seeds[:, None])
                ok = free[slots].all(axis=1)
                ordered = np.sort(slots, axis=1)
                ok &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if ok.any():
                    at = int(np.argmax(ok))
                    break
            else:
                raise ValueError("no seed found")
            self.seed[b] = seeds[at]
            free[slots[at]] = False
            key_at[slots[at]] = members
        rest = iter(np.flatnonzero(free).tolist())
        for b, members in groups.items():
            if len(members) == 1:
                self.named[b] = slot = next(rest)
                key_at[slot] = members[0]
        self.keys = [keys[i] for i in key_at]

    def _slots(self, h: np.ndarray, seed) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(h ^ (seed * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(self.n)).astype(np.int64)

    def slots(self, tokens: list[bytes]) -> np.ndarray:
        """Slot of each token, -1 where it is not a key."""
        if not tokens or not self.n:
            return np.full(len(tokens), -1, np.int64)
        h = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        slot = np.where(self.named[bucket] >= 0, self.named[bucket], self._slots(h, self.seed[bucket]))
        keys = self.keys
        return np.array([s if keys[s] == t else -1 for s, t in zip(slot.tolist(), tokens, strict=True)],
                        np.int64)


def merge_bytes(token: bytes, byte_id: list[int], pair_id: dict[int, int], width: int) -> list[int]:
    """BPE of one pre-token: the adjacent pair of lowest rank merges first, the
    leftmost of equal ones; a heap holds the pairs, links join the live parts."""
    n = len(token)
    ids = [byte_id[b] for b in token]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = pair_id.get(ids[i] * width + ids[i + 1])
        if r is not None:
            heap.append(r * n + i)
    heapq.heapify(heap)
    while heap:
        r, i = divmod(heapq.heappop(heap), n)
        j = after[i]
        # Stale unless the pair that begins at i now still makes this token.
        if j >= n or ids[i] < 0 or pair_id.get(ids[i] * width + ids[j]) != r:
            continue
        ids[i], ids[j] = r, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (q := pair_id.get(r * width + ids[k])) is not None:
                heapq.heappush(heap, q * n + i)
        if (h := before[i]) >= 0 and (q := pair_id.get(ids[h] * width + r)) is not None:
            heapq.heappush(heap, q * n + h)
    return [x for x in ids if x >= 0]


NO_PAIR = np.int32(2**31 - 1)


class PairTable:
    """Merged id of a pair of ids, for whole arrays of pairs."""

    def __init__(self, pair_id: dict[int, int], width: int, byte_id: list[int]):
        keys = np.fromiter(pair_id.keys(), np.int64, len(pair_id))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.ids = np.append(np.fromiter(pair_id.values(), np.int64, len(pair_id))[order], NO_PAIR).astype(np.int32)
        self.width = width
        self.byte_id = np.array(byte_id, np.int32)
        left, right = np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)
        self.of_bytes = self.find(left, right).reshape(256, 256)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ids[at], NO_PAIR)


def merge_short(tokens: list[bytes], table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """:func:`merge_bytes` of many short pre-tokens at once, as (all ids, ids of
    each): a row each, its lowest pair merged in every round.  Among this few
    pairs the smallest of a row is found faster than a heap is kept."""
    n, wide = len(tokens), max(map(len, tokens)) + 1
    size = np.array([len(t) for t in tokens])
    raw = np.zeros((n, wide), np.uint8)
    raw[np.arange(wide) < size[:, None]] = np.frombuffer(b"".join(tokens), np.uint8)
    ids = table.byte_id[raw]
    pair = table.of_bytes[raw[:, :-1], raw[:, 1:]]
    column = np.arange(wide - 1)
    pair[column >= size[:, None] - 1] = NO_PAIR
    done, count = np.zeros_like(ids), np.zeros(n, np.int64)
    row_of = np.arange(n)
    while len(row_of):
        row = np.arange(len(row_of))
        at = pair.argmin(axis=1)
        new = pair[row, at]
        ended = new == NO_PAIR
        if ended.any():
            done[row_of[ended]], count[row_of[ended]] = ids[ended], size[ended]
            go = ~ended
            ids, pair, size, row_of, at, new = ids[go], pair[go], size[go], row_of[go], at[go], new[go]
            row = np.arange(len(row_of))
            if not len(row):
                break
        moved = column > at[:, None]        # what stands behind the pair moves up by one
        ids[:, :-1] = np.where(moved, ids[:, 1:], ids[:, :-1])
        pair[:, :-1] = np.where(moved[:, :-1], pair[:, 1:], pair[:, :-1])
        pair[:, -1] = NO_PAIR
        ids[row, at] = new
        size -= 1
        before = np.maximum(at - 1, 0)
        pair[row, before] = np.where(at > 0, table.find(ids[row, before], new), pair[row, before])
        pair[row, at] = np.where(at + 1 < size, table.find(new, ids[row, at + 1]), NO_PAIR)
    return done[np.arange(wide) < count[:, None]], count


# Contractions that the pattern takes as a match of their own, behind an apostrophe.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
SPACE, LETTER, NUMBER, OTHER = range(4)


def char_classes() -> np.ndarray:
    """Class of every code point as the pattern's \\s, \\p{L} and \\p{N} see it."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    for lo in range(0, 0x110000, 1 << 16):
        text = "".join(map(chr, range(lo, lo + (1 << 16))))
        for kind, expr in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(expr, text):
                out[lo + m.start(): lo + m.end()] = kind
    return out


def token_starts(chars: np.ndarray, classes: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of concatenated texts (code points), as the
    pattern's alternatives give them: one optional space and a run of letters,
    numbers or others; white space up to the last one before such a run."""
    n = len(chars)
    kind = classes[chars]
    begins = np.zeros(n + 3, bool)          # a text begins here; also beyond the end
    begins[doc_starts] = True
    begins[n:] = True
    start = begins[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.zeros(n, bool)                # white space right before something else
    last[:-1] = space[:-1] & ~space[1:] & ~begins[1:n]
    start |= last
    joined = np.flatnonzero(last & (chars == 32)) + 1
    start[joined] = False                   # the space leads its match
    quote = np.flatnonzero(start & (chars == 39))
    if len(quote):
        padded = np.concatenate([chars, np.zeros(2, chars.dtype)])
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in ONE_LETTER]) & ~begins[quote + 1]
        two = np.zeros(len(quote), bool)
        for x, y in TWO_LETTERS:
            two |= (a == ord(x)) & (b == ord(y))
        two &= ~begins[quote + 1] & ~begins[quote + 2]
        for found, size in ((quote[one], 2), (quote[two], 3)):
            start[found + 1] = False
            end = found + size
            start[end[end < n]] = True
    return np.flatnonzero(start)


def safe_pieces(text: str, size: int) -> list[str]:
    """Cuts a long text before a space behind a non-space, where every match ends."""
    out, at = [], 0
    while len(text) - at > size:
        step = size
        while True:
            cut = text.rfind(" ", at + 1, at + step)
            while cut > at and text[cut - 1].isspace():
                cut = text.rfind(" ", at + 1, cut)
            if cut > at or at + step >= len(text):
                break
            step *= 2                       # one match longer than the piece
        if cut <= at:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


class Codec:
    """Encoder and decoder of one vocabulary; plain data, so it broadcasts.

    ``pattern`` None means the pattern that :func:`token_starts` implements;
    any other is matched with the regex library.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str | None):
        if sum(map(len, ranks)) > MAX_VOCABULARY_BYTES:
            raise ValueError("the vocabulary is too large to broadcast")
        self.pattern, self.ranks = pattern, ranks
        self.hash = PerfectHash(list(ranks))
        self.rank_at = np.array([ranks[k] for k in self.hash.keys], np.uint32)
        self.classes = char_classes() if pattern is None else None
        self._ready()

    def _ready(self) -> None:
        ranks = self.ranks
        self._forget()
        self.width = max(ranks.values(), default=0) + 1
        self.byte_id = [ranks[bytes([b])] for b in range(256)]
        self.pair_id = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pair_id[left * self.width + right] = rank
        self.table = PairTable(self.pair_id, self.width, self.byte_id)
        size = np.zeros(self.width, np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        self.size, self.at = size, np.cumsum(size) - size
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        self.bytes = np.frombuffer(b"".join(t for t, _ in by_rank), np.uint8)
        if self.pattern is not None:
            import regex

            self.split = regex.compile(self.pattern)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("pattern", "ranks", "hash", "rank_at", "classes")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _forget(self) -> None:
        self.entry: dict[str, int] = {}     # pre-token -> place in the arrays below
        self.ids = [np.zeros(0, "<u4")]
        self.counts = [np.zeros(0, np.int64)]
        self.n_ids = 0

    def _entries(self, tokens: list[str]) -> list[int]:
        """Cache entries of different pre-tokens; new ones go through the two tiers."""
        found = list(map(self.entry.get, tokens))
        new = [t for t, i in zip(tokens, found, strict=True) if i is None]
        if not new:
            return found
        if len(new) < len(tokens) and (len(self.entry) + len(new) > CACHE_ENTRIES or self.n_ids > CACHE_IDS):
            self._forget()
            return self._entries(tokens)
        raw = [t.encode("utf-8") for t in new]
        slots = self.hash.slots(raw)
        known = np.flatnonzero(slots >= 0)
        parts = [(known.tolist(), self.rank_at[slots[known]], np.ones(len(known), np.int64))]
        by_size: dict[int, list[int]] = {}
        for i in np.flatnonzero(slots < 0).tolist():
            by_size.setdefault(len(raw[i]).bit_length() if len(raw[i]) <= SHORT else 0, []).append(i)
        for kind, members in by_size.items():
            if kind:
                parts.append((members, *merge_short([raw[i] for i in members], self.table)))
            else:
                lists = [merge_bytes(raw[i], self.byte_id, self.pair_id, self.width) for i in members]
                parts.append((members, np.array([x for ids in lists for x in ids], np.int64),
                              np.array([len(ids) for ids in lists], np.int64)))
        at = len(self.entry)
        for members, ids, count in parts:
            self.entry.update(zip([new[i] for i in members], range(at, at + len(members)), strict=True))
            at += len(members)
            self.ids.append(ids.astype("<u4"))
            self.counts.append(count)
            self.n_ids += len(ids)
        return list(map(self.entry.__getitem__, tokens))

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.ids) > 1:
            self.ids, self.counts = [np.concatenate(self.ids)], [np.concatenate(self.counts)]
        count = self.counts[0]
        return self.ids[0], np.cumsum(count) - count, count

    def _starts(self, text: str, chars: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
        if self.pattern is None:
            return token_starts(chars, self.classes, doc_starts)
        stops = [*doc_starts.tolist(), len(text)]
        found = [m.start() for lo, hi in zip(stops, stops[1:], strict=False)
                 for m in self.split.finditer(text, lo, hi)]
        return np.array(found, np.int64)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        text = "".join(texts)
        if not text:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        ends = np.cumsum(sizes)
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
        start = self._starts(text, chars, (ends - sizes)[sizes > 0])
        stop = np.append(start[1:], len(chars))
        table = byte_table(7)
        wide = (chars >> np.uint32(8)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        _, first, which = np.unique(span_hash(value_sums(table[chars & np.uint32(255)] + wide), start, stop),
                                    return_index=True, return_inverse=True)
        different = [text[s:e] for s, e in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
        entry = np.array(self._entries(different), np.int64)[which]
        flat, at, count = self._tables()
        ids = flat[ragged(at, count, entry)]
        per_token = np.concatenate(([0], np.cumsum(count[entry])))
        return ids, per_token[np.searchsorted(start, ends, side="left")]

    def encode(self, text: str) -> list[int]:
        return [i for piece in safe_pieces(text, SEGMENT) for i in self.encode_many([piece])[0].tolist()]

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        return self.bytes[ragged(self.at, self.size, ids)].tobytes()


def ragged(at: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Indices of the spans at[w] .. at[w] + size[w] for w in ``which``, in order."""
    n = size[which]
    end = np.cumsum(n)
    total = int(end[-1]) if len(end) else 0
    return np.repeat(at[which] - end + n, n) + np.arange(total)


def text_groups(column, limit: int = SEGMENT // 2):
    """Lists of consecutive texts (null: empty) of about ``limit`` bytes."""
    _, offsets = column_bytes(column)
    for lo, hi in row_chunks(offsets, limit):
        yield [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def _codec(spark, path: str, pattern: str | None):
    return spark.sparkContext.broadcast(Codec(load_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of long: the token ids of the whole text)."""
    shared = _codec(docs.sparkSession, path, pattern)

    def run(batches):
        codec = shared.value
        for batch in batches:
            ids = [codec.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))],
                                             names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<long>")


def decode(encoded: DataFrame, path: str, pattern: str | None = None) -> DataFrame:
    """doc_id and ``text`` of rows (doc_id, ids); ids that are not the codes of
    valid UTF-8 give the replacement character."""
    shared = _codec(encoded.sparkSession, path, pattern)

    def run(batches):
        codec = shared.value
        for batch in batches:
            texts = [codec.decode(x.as_py() or []).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def bpe_digests(docs: DataFrame, path: str, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every whole text is encoded
    and its ids are decoded again."""
    shared = _codec(docs.sparkSession, path, pattern)

    def run(batches):
        codec = shared.value
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for texts in text_groups(batch.column(1)):
                if len(texts) == 1:         # perhaps a very long one: piece by piece
                    n, a, b = 0, hashlib.sha256(), hashlib.sha256()
                    for piece in safe_pieces(texts[0], SEGMENT):
                        ids, _ = codec.encode_many([piece])
                        n += len(ids)
                        a.update(ids.tobytes())
                        b.update(codec.decode(ids))
                    counts.append(n)
                    ids_sha.append(a.hexdigest())
                    text_sha.append(b.hexdigest())
                    continue
                ids, ends = codec.encode_many(texts)
                begin = 0
                for end in ends.tolist():
                    own = ids[begin:end]
                    counts.append(len(own))
                    ids_sha.append(hashlib.sha256(own.tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(codec.decode(own)).hexdigest())
                    begin = end
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
