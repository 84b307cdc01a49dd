"""Vector bin packing of documents into fixed-length sequences.

Three quantities limit a sequence at once: tokens, segments (pieces) and
loss-bearing tokens.  A piece's loss-bearing tokens are those after the first
``loss_from`` tokens of its document (a prompt, in instruction data) that
have a token before them in the piece.

Placement: open items wait in a pool of bounded size; a sequence takes, again
and again, the item with the largest dot product of its demand and the
sequence's remaining capacity (both relative to the limits) among those that
fit whole.  When none fits, the item with the largest dot product is cut so that it
fills what remains and its rest goes back to the pool.  Documents longer than
a sequence are cut into full ones first.  What is left at the end of an input
partition is cut into sequences whose lengths are powers of two, which need
no padding.  So sequences are padded only where the segment or loss limit
binds.

Map-only: no shuffle, no group; state is the pool and one document.  A
sequence's id is the input partition's number and a counter, so a task that
runs again gives the same rows as long as the input's partitions hold the same
rows in the same order (files do; write a shuffled frame first).

Null or empty text: the end token alone.  Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsync.llm.text import local, released, slices

TOKENS = 2048
SEGMENTS = 256
END = 1
POOL = 512
CACHE_WORDS = 300_000
CACHED_LENGTH = 32
LONG = 4096


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters stand for themselves, the others from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}


class Encoder:
    """Identifiers of a byte-level BPE tokenizer file as little-endian unsigned 32-bit bytes.

    A space followed by a visible character always starts a token, so a text
    falls into units there; units are encoded once and kept in a bounded
    cache.  Special tokens' strings become their ids, the file's default.
    Units of more than ``LONG`` characters go to the library that takes time
    nearly linear in them; all others to the one that is faster on short ones.
    """

    def __init__(self, tokenizer_file: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(tokenizer_file)
        added = self.slow.get_added_tokens_decoder()
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in piece): i
                 for piece, i in self.slow.get_vocab(with_added_tokens=True).items() if i not in added}
        self.special = [t.content for t in added.values()]
        self.bpe = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        """Empties the cache; two generations in a worker that waits take more than the tokenizers do."""
        self.cache, self.old = {}, {}

    def _plain(self, text: str) -> bytes:
        if len(text) > LONG:
            return array("I", self.slow.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.bpe.encode_ordinary(text)).tobytes()

    def _learn(self, unit: str) -> bytes:
        """Ids of a space and the unit."""
        ids = self.old.get(unit)
        if ids is None:
            ids = self._plain(" " + unit)
        if len(unit) <= CACHED_LENGTH:
            if len(self.cache) >= CACHE_WORDS:             # two generations of bounded size
                self.old, self.cache = self.cache, {}
            self.cache[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return array("I", self.slow.encode(text, add_special_tokens=False).ids).tobytes()
        units = text.split(" ")
        ids = list(map(self.cache.get, units))
        ids[0] = b""
        odd = []                                  # a space before white space: no unit starts there
        for i in [i for i, known in enumerate(ids) if known is None]:
            unit = units[i]
            if unit and not unit[0].isspace():
                ids[i] = self._learn(unit)
            else:
                odd.append(i)
        start, out = 0, []                        # start: of the units not yet written
        for i in odd:
            if i < start:
                continue
            first, end = max(start, i - 1), i + 1
            while end < len(units) and (not units[end] or units[end][0].isspace()):
                end += 1
            out += self._run(units, ids, start, first)
            piece = " ".join(units[first:end])
            out.append(self._plain(" " + piece if first else piece))
            start = end
        return b"".join(out + self._run(units, ids, start, len(units)))

    def _run(self, units, ids, start: int, end: int) -> list[bytes]:
        """Ids of units[start:end], the text's first unit having no space before it."""
        if start == 0 < end:
            return [self._plain(units[0]), *ids[1:end]]
        return ids[start:end]


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokenizer_file: str) -> Encoder:
    """The worker's encoder for a tokenizer file, made once."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = Encoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


class Packer:
    """Packs the documents of one partition; ``rows`` fills with pieces."""

    def __init__(self, prefix: int, tokens: int = TOKENS, segments: int = SEGMENTS,
                 loss: int | None = None, pool: int = POOL):
        if min(tokens, segments, 1 if loss is None else loss) < 1:
            raise ValueError("limits must be at least 1")
        self.limit = np.array([tokens, segments, tokens if loss is None else loss], dtype=np.int64)
        self.tokens, self.next, self.pool = tokens, prefix, pool
        self.items: list[tuple] = []                     # (doc, ids, start, prompt)
        self.need = np.zeros((2 * pool + 2, 3), dtype=np.int64)
        self.rows: list[tuple] = []

    def _loss(self, start: int, length: int, prompt: int) -> int:
        return max(0, start + length - max(start + 1, prompt))

    def add(self, doc, ids: bytes, prompt: int) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.tokens:
            n = self._fits(start, total - start, prompt, self.limit)
            self._write([(doc, ids, start, prompt, n)])
            start += n
        if start < total:
            self._keep((doc, ids[4 * start:], start, prompt, total))
        while len(self.items) > self.pool:
            self._fill(self.limit)

    def _keep(self, item) -> None:
        n = len(item[1]) // 4
        self.need[len(self.items)] = n, 1, self._loss(item[2], n, item[3])
        self.items.append(item)

    def _drop(self, i: int) -> None:
        """Removes an item; the last takes its place."""
        last = len(self.items) - 1
        self.items[i], self.need[i] = self.items[last], self.need[last]
        self.items.pop()

    def _fits(self, start: int, left: int, prompt: int, room: np.ndarray) -> int:
        """The longest prefix of a piece that the room allows (0 if none)."""
        if room[1] < 1:
            return 0
        # tokens without loss come first, then each token costs one
        free = max(start + 1, prompt) - start
        return int(max(0, min(left, room[0], free + room[2])))

    def _fill(self, limit: np.ndarray) -> None:
        """Writes one sequence from the pool."""
        room, chosen = limit.copy(), []
        while self.items and room[0] > 0 and room[1] > 0:
            need = self.need[:len(self.items)]
            value = (need / self.limit) @ (room / self.limit)
            fits = (need <= room).all(axis=1)
            whole = bool(fits.any())
            i = int(np.argmax(np.where(fits, value, -1.0) if whole else value))
            doc, ids, start, prompt, total = self.items[i]
            left = len(ids) // 4
            n = left if whole else self._fits(start, left, prompt, room)
            if n == 0:
                break
            chosen.append((doc, ids, start, prompt, n, start, total))
            room -= np.array([n, 1, self._loss(start, n, prompt)])
            self._drop(i)
            if n < left:
                self._keep((doc, ids[4 * n:], start + n, prompt, total))
        self._emit(chosen)

    def _write(self, pieces) -> None:
        self._emit([(doc, ids[4 * s:4 * (s + n)], s, prompt, n, s, len(ids) // 4)
                    for doc, ids, s, prompt, n in pieces])

    def _emit(self, pieces) -> None:
        at = 0
        for doc, ids, start, prompt, n, _, total in pieces:
            self.rows.append((doc, start, n, zlib.crc32(memoryview(ids)[:4 * n]), total, self.next, at,
                              self._loss(start, n, prompt)))
            at += n
        self.next += 1

    def finish(self) -> None:
        """Empties the pool: full sequences, then lengths that are powers of two."""
        while self.items:
            left = int(self.need[:len(self.items), 0].sum())
            room = self.limit.copy()
            if left < self.tokens:
                room[0] = 1 << (left.bit_length() - 1)
            self._fill(room)


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, loss_tokens long")


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
         loss_from: str | None = None, tokens: int = TOKENS, segments: int = SEGMENTS,
         loss: int | None = None) -> DataFrame:
    """One row per piece: its document, place there, checksum, sequence and offset.

    ``loss_from`` names an integer column with the number of prompt tokens
    (null: 0).  Every token of every document lies in exactly one piece.
    """
    prompt = F.lit(0) if loss_from is None else F.coalesce(F.col(loss_from).cast("int"), F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), prompt.alias("prompt"), local(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_file)
        end = np.array([END], dtype="<u4").tobytes()
        packer = Packer(TaskContext.get().partitionId() << 40, tokens, segments, loss)
        try:
            for b in slices(batches):
                for doc, start, text in zip(*(b.column(c).to_pylist() for c in ("id", "prompt", "text"))):
                    packer.add(doc, enc.encode(text) + end, start)
                yield _batch(packer)
        finally:
            enc.forget()
        packer.finish()
        yield _batch(packer)

    return rows.mapInArrow(released(run), SCHEMA)


def _batch(packer: Packer) -> pa.RecordBatch:
    cols = list(zip(*packer.rows)) or [()] * 8
    packer.rows = []
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                      names=[f.split()[0] for f in SCHEMA.split(", ")])
