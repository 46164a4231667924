"""Token counts under a unigram vocabulary (operator 6).

The best segmentation of a pre-token is the one of the largest sum of piece
scores.  Distinct pre-tokens go into a trie: walking it in preorder, the forward
scores of a shared prefix are computed once, and a word's end stores its count
of pieces (its terminal count).  Preorder is the order of the sorted pre-tokens,
so only the path of the current one is held.

A narrow map: no shuffle, one text scan.  The vocabulary (pieces and scores) is
broadcast; its size is that of the model file.  Counts of pre-tokens seen before
come from a cache of bounded size per worker.

Defined results: null and empty texts, and texts of white space only, have no
tokens; code points that no piece covers cost their bytes (byte fallback); ties
between segmentations go to the one of fewer pieces; repeated rows give
repeated results; an empty table gives no rows.  Other columns are never
looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickmart.llm.textscan import SEGMENT, Words, column_bytes, owners, row_chunks, space_word_table

WORD_MARK = "▁"        # stands for the space before a word
CACHE_ENTRIES = 400_000
UNKNOWN_SCORE = -1e6        # of a code point without a piece, below any sum of scores


def load_scores(path: str) -> dict[str, float]:
    """Piece -> score of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}


class Unigram:
    """Vocabulary and the forward pass over sorted pre-tokens."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self._ready()

    def _ready(self) -> None:
        self.cache: dict[bytes, int] = {}

    def __getstate__(self):
        return {"scores": self.scores, "longest": self.longest}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _step(self, word: str, end: int, best: list[float], count: list[int]) -> None:
        """Extends the forward scores by the node of ``word[:end]``."""
        scores, top, n = self.scores, None, 0
        for begin in range(max(0, end - self.longest), end):
            score = scores.get(word[begin:end])
            if score is not None:
                s = best[begin] + score
                if top is None or s > top or s == top and count[begin] + 1 < n:
                    top, n = s, count[begin] + 1
        if word[end - 1] not in scores:             # byte fallback
            s, cost = best[end - 1] + UNKNOWN_SCORE, count[end - 1] + len(word[end - 1].encode("utf-8"))
            if top is None or s > top or s == top and cost < n:
                top, n = s, cost
        best.append(top)
        count.append(n)

    def sorted_counts(self, words: list[str]) -> list[int]:
        """Terminal counts of sorted pre-tokens: one walk through their trie."""
        best, count, path, out = [0.0], [0], "", []
        for word in words:
            marked = WORD_MARK + word
            shared, limit = 0, min(len(path), len(marked))
            while shared < limit and path[shared] == marked[shared]:
                shared += 1
            del best[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(marked) + 1):
                self._step(marked, end, best, count)
            path = marked
            out.append(count[-1])
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Counts of different pre-tokens (UTF-8)."""
        cache = self.cache
        new = sorted(w for w in words if w not in cache)
        if len(cache) + len(new) > CACHE_ENTRIES:
            cache.clear()
            new = sorted(words)
        cache.update(zip(new, self.sorted_counts([w.decode("utf-8") for w in new]), strict=True))
        return np.array([cache[w] for w in words], np.int64)


WORDS = Words(space_word_table(), seed=11, fold=False)


def _count(batches, shared):
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        totals = []
        for lo, hi in row_chunks(offsets, SEGMENT):
            own = offsets[lo:hi + 1] - offsets[lo]
            body = data[offsets[lo]:offsets[hi]]
            start, end, h = WORDS.find(body, own)
            _, first, which = np.unique(h, return_index=True, return_inverse=True)
            raw = body.tobytes()
            words = [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
            each = shared.value.counts(words)[which] if len(words) else np.zeros(0, np.int64)
            totals.append(np.bincount(owners(own, start), each, hi - lo).astype(np.int64))
        n = np.concatenate(totals) if totals else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n)], names=["doc_id", "n_tokens"])


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and n_tokens of every row's whole text; ``path`` names a
    sentencepiece model whose piece scores are the unigram scores."""
    shared = docs.sparkSession.sparkContext.broadcast(Unigram(load_scores(path)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda it: _count(it, shared),
                                                    f"doc_id {kind}, n_tokens long")
