"""Token counts by byte-pair merging with a heap and a linked list.

The vocabulary is a sentencepiece BPE model.  A word's symbols form a doubly
linked list; a heap holds every adjacent pair whose concatenation is a piece,
ordered by rank and then position; the lowest is popped, merged and its new
neighbours pushed until the heap is empty.  The count is the number of initial
symbols minus the number of merges (a character without a piece starts as its
UTF-8 bytes, which never merge).  No identifiers are produced.

White space is marked as the library does: each U+0020 becomes the mark, one
mark is put in front, an empty text has no tokens, and control strings in a
text are ordinary text.  No piece of the vocabulary holds a mark after another
character (checked on loading), so a text is counted word by word, and the
counts of words are kept in a bounded cache of the worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsync.llm.text import local, slices, text_bytes

MARK = "▁"
LIMIT = 4096
CACHE_WORDS = 400_000
CACHED_LENGTH = 40
_PIECES = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Merger:
    """Counts the tokens of texts under one model file."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        # a higher score merges first; equal scores are told apart by position only
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece of this vocabulary crosses words")
        self.adjacent = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.cache: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def merges(self, symbols: str) -> int:
        """Number of merges in a run of symbols."""
        n, rank = len(symbols), self.rank
        piece = list(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(symbols[i:i + 2])
            if r is not None:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            if piece[i] is None:
                continue
            j = right[i]
            if j >= n or len(piece[i]) + len(piece[j]) != size:
                continue                                  # one of the two has changed since
            piece[i] += piece[j]
            piece[j] = None
            k = right[i] = right[j]
            done += 1
            if k < n:
                left[k] = i
                r = rank.get(piece[i] + piece[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, size + len(piece[k])))
            h = left[i]
            if h >= 0:
                r = rank.get(piece[h] + piece[i])
                if r is not None:
                    heapq.heappush(heap, (r, h, len(piece[h]) + size))
        return done

    def run(self, symbols: str) -> int:
        """Tokens of a run of symbols without a cut."""
        if len(symbols) == 1:
            return 1 if symbols in self.rank else len(symbols.encode())
        return len(symbols) - self.merges(symbols)

    def word(self, word: str) -> int:
        """Tokens of one marked word: symbols minus merges, run by run.

        No merge crosses two characters that are adjacent in no piece, so the
        word falls into runs there.
        """
        adjacent, total, start = self.adjacent, 0, 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in adjacent:
                head = self.cache.get(word[1:i]) if not start and i > 1 and word[0] == MARK else None
                total += self.run(word[start:i]) if head is None else head
                start = i
        return total + self.run(word[start:])

    def _learn(self, unit: str) -> int:
        """Tokens of the mark and the unit, which holds no mark."""
        c = self.old.get(unit)
        if c is None:
            c = self.word(MARK + unit)
        if len(unit) <= CACHED_LENGTH:
            if len(self.cache) >= CACHE_WORDS:            # two generations of bounded size
                self.old, self.cache = self.cache, {}
            self.cache[unit] = c
        return c

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "  " in text or text[-1] == " " or text[0] == " " or MARK in text:
            return sum(self.word(w) if w[:2] == MARK * 2 or w[0] != MARK or len(w) == 1
                       else self._known(w[1:]) for w in _pieces(MARK + text.replace(" ", MARK)))
        counts = list(map(self.cache.get, units := text.split(" ")))
        if None in counts:
            counts = [self._known(u) if c is None else c for u, c in zip(units, counts)]
        return sum(counts)

    def _known(self, unit: str) -> int:
        c = self.cache.get(unit)
        return self._learn(unit) if c is None else c


def _pieces(marked: str) -> Iterator[str]:
    """Runs of marks with the characters up to the next mark."""
    return (m.group() for m in _PIECES.finditer(marked))


_MERGERS: dict[str, Merger] = {}


def merger(model_file: str) -> Merger:
    """The worker's merger for a model file, made once."""
    if model_file not in _MERGERS:
        _MERGERS[model_file] = Merger(model_file)
    return _MERGERS[model_file]


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; no shuffle.

    ``model_file`` must be readable at that path on the executors.  Null
    texts count as empty (0 tokens); texts of any length are counted whole.
    """
    rows = docs.select(F.col(id_col).alias("id"), local(text_col))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(model_file)
        for b in slices(batches):
            size = np.diff(text_bytes(b.column("text"))[1])
            n = np.array([m.count(t) for t in b.column("text").to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(size), pa.array(n), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean") \
        .withColumnRenamed("id", id_col)
