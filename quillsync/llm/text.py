"""Words, word hashes and shingles of whole Arrow text blocks.

A block is a slice of a record batch with about ``BLOCK_BYTES`` of text (one
longer text is a block of its own).  Words are maximal runs of bytes other
than 0x20 and 0x09-0x0D, with A-Z lower-cased; both sets are ASCII, so working
on UTF-8 bytes gives the same words as working on code points.

A word's identity is a 64-bit hash.  Distinct words share one with a chance of
about n^2 / 2^65 for n distinct words (below 1e-6 for five million words).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
BATCH_BYTES = 4 << 20
SHINGLE_WORDS = 5

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise and bijective."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables():
    code = np.arange(256, dtype=np.uint64)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, dtype=bool)
    space[[0x20, 9, 10, 11, 12, 13]] = True
    return lower, space, mix((code + _U(1)) * _U(_ODD))


LOWER, SPACE, BYTE_HASH = _tables()
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first n powers of an odd constant modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        step = np.full(max(n, 4096), _ODD, dtype=np.uint64)
        step[0] = 1
        _POWERS = np.cumprod(step, dtype=np.uint64)
    return _POWERS[:n]


def text_array(column) -> pa.Array:
    """A string column as one array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its texts."""
    a = text_array(column)
    wide = pa.types.is_large_string(a.type)
    offsets = np.zeros(1, dtype=np.int64)
    if len(a):
        offsets = np.frombuffer(a.buffers()[1], dtype=np.int64 if wide else np.int32)
        offsets = offsets[a.offset:a.offset + len(a) + 1].astype(np.int64)
    if a.buffers()[2] is None or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(a.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           target: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each has at most ``target`` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + target, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


class Words:
    """Words of a block: ``hash`` per word and, per text, ``first``..``first + 1``."""

    def __init__(self, column, breaks: np.ndarray = SPACE, lower: bool = True):
        data, offsets = text_bytes(column)
        self.data, self.offsets = data, offsets
        if lower and len(data):
            data = LOWER[data]
        n = len(data)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~breaks[data]
        word = inside[1:-1]
        before, after = inside[:-2].copy(), inside[2:].copy()
        edges = offsets[(offsets > 0) & (offsets < n)]
        before[edges] = False
        after[edges - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        length = self.end - self.start
        self.first = np.searchsorted(self.start, offsets)
        if not len(length):
            self.hash = np.zeros(0, dtype=np.uint64)
            return
        body = BYTE_HASH[data[word]]
        at = np.cumsum(length) - length
        place = np.arange(len(body)) - np.repeat(at, length)
        body *= _powers(int(length.max()))[place]
        self.hash = mix(np.add.reduceat(body, at) + length.astype(np.uint64) * _U(_ODD))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text's position in the block, per word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def shingles(words: Words, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width``-word shingle and their text's position.

    A text with fewer words, but at least one, has its whole sequence as its
    only shingle; a text without words has none.
    """
    n = len(words.hash)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    doc = words.doc()
    last, first = words.first[1:][doc], words.first[:-1][doc]
    at = np.arange(n)
    padded = np.concatenate([words.hash, np.zeros(width, dtype=np.uint64)])
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        part = np.where(at + j < last, padded[j:n + j], _U(j + 1))
        out = mix(out * _U(6364136223846793005) + part)
    keep = (at + width <= last) | (at == first)
    return out[keep], doc[keep]


def local(column, texts_as: str = "text"):
    """``column`` as the working text column, under a fixed name."""
    from pyspark.sql import functions as F
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(texts_as)


def bounded_batches(spark) -> None:
    """Lowers the session's limit of bytes in an Arrow batch to ``BATCH_BYTES`` (it is never
    raised), as every task holds a few batches outside its executor's heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().removesuffix("b")
    shift = {"k": 10, "m": 20, "g": 30}.get(now[-1:], 0)
    number = now[:-1] if shift else now
    if not number.isdigit() or int(number) << shift > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def release_memory() -> None:
    """Gives freed memory of this process back to the machine: Arrow's pool and malloc's
    heap otherwise keep the most that a task ever took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # not glibc
        pass


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, a function for mapInArrow, after which its worker keeps no freed memory.  Workers
    wait for further tasks, so what they keep adds to that of later stages, also of those without Python."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped
