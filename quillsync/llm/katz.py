"""Katz back-off scores of texts under a bigram model of the corpus.

Tokens are a text's words and one end mark; the history of the first is a begin
mark.  With r the training count of (h, w) and c of a word:

    P(w | h) = d_r r / c(h)                 r > 0
             = a(h) P(w)                    r = 0, c(h) > 0
             = P(w)                         c(h) = 0
    P(w)     = e_c c / N                    c > 0
             = 1 - sum of these             unknown words, as one class

d and e are Good-Turing discounts up to ``KATZ`` from the counts of counts of
all bigrams and of all words (absolute discounting where those are too few or
not decreasing).  a(h) = (1 - sum_seen d_r r / c(h)) / (1 - sum_seen P(w)), so
every distribution sums to one.  Where all counts of a history exceed ``KATZ``,
its probabilities are scaled by c(h) / (c(h) + 1) to leave some mass.

How it runs.  Documents are taken in blocks of about ``BLOCK_TEXT`` bytes.

* Words: each block sends its distinct words, with their training counts, to
  the partition of the word; the answer, the word's count in the whole corpus,
  goes back to the block.  These counts are written as a table, partitioned by
  word, with the counts of counts of each partition.
* Bigrams: each block sends its distinct (h, w), the count of w and the documents
  in which they occur to the partition of h, which holds all of that part of the
  bigram table.  Histories with more than half a partition's share of the tokens
  are split by w; their sums are put together with the counts of counts.
* Scores: with the counts of counts of the whole table (one row) the partition
  evaluates its bigrams and returns a sum per document.

What is shuffled are compressed arrays, one per block and partition.  No text
is shuffled.  Words are told apart by 64-bit hashes, and the words that follow one
history by 48 bits of theirs.

Null or blank text: the end mark alone.  Null doc_id: counts as the empty
string for the choice of held-out rows.  Repeated rows count each time.  With
no training row every probability is 1.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.llm.text import Words, local, mix, slices
from quillsync.session import scratch_dir

KATZ = 5                      # counts up to this are discounted
BLOCK_TEXT = 8 << 20
HOT_SHARE = 2                 # a history is split from 1/2 of a partition's share of the tokens

_END, _BEGIN = np.uint64(0x656E64), np.uint64(0x626567696E)
_TOKENS, _COUNTS, _STATS = 0, 1, 2            # kinds of rows on the way to blocks
_DOCS, _PAIRS, _SUMS = 0, 1, 2                # kinds of rows of the second half
_ROW = "bucket long, kind int, block long, payload binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, each split into planes of bytes."""
    parts = [struct.pack("<B", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts += [struct.pack("<cq", a.dtype.char.encode(), len(a)),
                  a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()]
    body = b"".join(parts)
    return struct.pack("<q", len(body)) + pa.compress(body, "zstd", asbytes=True)


def unpack(payload: bytes) -> list[np.ndarray]:
    body = pa.decompress(memoryview(payload)[8:], struct.unpack("<q", payload[:8])[0], "zstd", asbytes=True)
    out, at = [], 1
    for _ in range(body[0]):
        kind, n = struct.unpack_from("<cq", body, at)
        at += 9
        dtype = np.dtype(kind.decode())
        planes = np.frombuffer(body, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += n * dtype.itemsize
    return out


def _delta(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _row(bucket, kind, block, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int64()), pa.array([kind], pa.int32()), pa.array([block], pa.int64()),
         pa.array([payload], pa.binary())], names=["bucket", "kind", "block", "payload"])


# --- discounts ---------------------------------------------------------------

def discounts(n: np.ndarray) -> np.ndarray:
    """d_0..d_KATZ+1 from n_0..n_KATZ+1 (n_r types of count r; n_0 unused); d of
    larger counts is 1, held at the last place."""
    n = n.astype(float)
    d = np.ones(KATZ + 2)
    tail = (KATZ + 1) * n[KATZ + 1] / n[1] if n[1] else 1.0
    if tail < 1 and (n[1:] > 0).all():
        r = np.arange(1, KATZ + 1)
        d[1:KATZ + 1] = ((r + 1) * n[2:] / (r * n[1:-1]) - tail) / (1 - tail)
        if (d[1:KATZ + 1] > 0).all() and (d[1:KATZ + 1] < 1).all():
            return d
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    d[1:KATZ + 1] = 1 - absolute / np.arange(1, KATZ + 1)
    return d


class Unigrams:
    """P(w) by the count of w."""

    def __init__(self, stats: np.ndarray):
        self.n, self.tokens, self.types = stats[:KATZ + 2], int(stats[KATZ + 2]), int(stats[KATZ + 3])
        self.d = discounts(self.n)
        lost = ((1 - self.d[1:-1]) * np.arange(1, KATZ + 1) * self.n[1:-1]).sum()
        # without words of small counts one token's share is set aside, by scaling
        self.scale = 1.0 if lost > 0 else self.tokens / (self.tokens + 1.0)
        self.unknown = lost / self.tokens if lost > 0 else 1 - self.scale if self.tokens else 1.0

    def p(self, count: np.ndarray) -> np.ndarray:
        known = self.scale * self.d[np.minimum(count, KATZ + 1)] * count / max(self.tokens, 1)
        return np.where(count > 0, known, self.unknown)


def counts_of_counts(count: np.ndarray) -> np.ndarray:
    """n_0..n_KATZ+1 with n_0 = 0."""
    small = np.bincount(count[(count > 0) & (count <= KATZ + 1)].astype(np.int64), minlength=KATZ + 2)
    return small[:KATZ + 2]


# --- blocks ------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]):
    """(block, ids, held out, tokens, tokens per document) of about BLOCK_TEXT bytes each."""
    block, held, size = TaskContext.get().partitionId() << 24, [], 0

    def done():
        ids = pa.concat_arrays([h[0] for h in held])
        return (block, ids, *(np.concatenate([h[i] for h in held]) for i in (1, 2, 3)))

    for b in slices(batches):
        w = Words(b.column("text"))
        n = b.num_rows
        tokens = np.empty(len(w.hash) + n, dtype=np.uint64)
        tokens[np.arange(len(w.hash)) + w.doc()] = w.hash
        tokens[w.first[1:] + np.arange(n)] = _END
        held.append((b.column("id"), b.column("held").to_numpy(zero_copy_only=False), tokens, w.counts + 1))
        size += len(w.data)
        if size >= BLOCK_TEXT:
            yield done()
            block, held, size = block + 1, [], 0
    if held:
        yield done()


def _words(buckets: int):
    """Distinct words of every block with their training counts, by word partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, out, tokens, per in _blocks(batches):
            words, at = np.unique(tokens, return_inverse=True)
            count = np.bincount(at[~np.repeat(out, per)], minlength=len(words)).astype(np.uint32)
            bucket = (words % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for i, (a, e) in enumerate(zip(cut[:-1], cut[1:])):
                if e > a:
                    yield _row(i, _COUNTS, block, pack(_delta(words[order[a:e]]), count[order[a:e]]))
    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The corpus counts of each block's words, and each partition's counts of counts."""
    for bucket, rows in _groups(batches, "bucket"):
        asked = [unpack(p) for _, _, p in rows]
        words = [np.cumsum(w, dtype=np.uint64) for w, _ in asked]
        every, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([c for _, c in asked])).astype(np.int64)
        cut = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        for (_, block, _), a, e in zip(rows, cut[:-1], cut[1:]):
            yield _row(bucket, _COUNTS, block, pack(total[at[a:e]].astype(np.uint64)))
        yield _row(bucket, _STATS, -1, pack(np.concatenate(
            [counts_of_counts(total), [total.sum(), np.count_nonzero(total)]]).astype(np.int64)))


def _groups(batches: Iterator[pa.RecordBatch], by: str):
    """(value, [(kind, block or bucket, payload)]) of rows that are sorted by ``by``."""
    other = "block" if by == "bucket" else "bucket"
    now, rows = None, []
    for b in batches:
        for key, kind, o, p in zip(*(b.column(c).to_pylist() for c in (by, "kind", other, "payload"))):
            if rows and key != now:
                yield now, rows
                rows = []
            now = key
            rows.append((kind, o, p))
    if rows:
        yield now, rows


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every block's tokens as places in its sorted words, for the block's own partition."""
    for block, ids, out, tokens, per in _blocks(batches):
        words, at = np.unique(tokens, return_inverse=True)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        yield _row(-1, _TOKENS, block, pack(
            _delta(words), at.astype(np.uint32), per.astype(np.uint32), out.astype(np.uint8),
            known.astype(np.uint8), ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))


# --- bigrams -----------------------------------------------------------------

def _pairs(word_buckets: int, buckets: int, tokens_all: int):
    """The bigrams of every block, by the partition of their history."""
    def emit(block, rows) -> Iterator[pa.RecordBatch]:
        words, at, per, out, known, ids = unpack(rows[0][2])
        words = np.cumsum(words, dtype=np.uint64)
        at, per = at.astype(np.int64), per.astype(np.int64)
        order = np.argsort(words % np.uint64(word_buckets), kind="stable")
        answers = [unpack(p)[0] for _, _, p in rows[1:]]
        if rows[0][0] != _TOKENS or sum(map(len, answers)) != len(words):
            raise ValueError("the input's partitions changed between two reads; write it first")
        count = np.empty(len(words), dtype=np.int64)
        count[order] = np.concatenate(answers)
        start = np.cumsum(per) - per
        c = count[at]
        yield _row(block % buckets, _DOCS, block, pack(
            ids, known, out, per, np.add.reduceat((c > 0).astype(np.int64), start),
            np.add.reduceat(np.log10(c + 0.1), start)))

        history = np.empty(len(at), dtype=np.int64)
        history[1:] = at[:-1]
        history[start] = len(words)                           # the begin mark
        full = np.append(words, _BEGIN)
        seen = np.append(count, count[np.searchsorted(words, _END)])
        doc = np.repeat(np.arange(len(per)) * 2 + out, per)   # with the held-out flag
        pair = history * len(words) + at
        order = np.argsort(pair, kind="stable")
        pair, doc = pair[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        times = np.diff(np.append(first, len(pair)))
        h, w = pair[first] // len(words), pair[first] % len(words)
        bucket = bucket_of(full[h], words[w], seen[h], buckets, tokens_all)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for i in np.flatnonzero(np.diff(cut)):
            pick = order[cut[i]:cut[i + 1]]
            hh = h[pick]
            new = np.flatnonzero(np.concatenate([[True], hh[1:] != hh[:-1]]))
            n = times[pick]
            place = np.repeat(first[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield _row(int(i), _PAIRS, block, pack(
                full[hh[new]], np.diff(np.append(new, len(hh))).astype(np.uint32), seen[hh[new]].astype(np.uint64),
                words[w[pick]] >> np.uint64(16), count[w[pick]].astype(np.uint64), n.astype(np.uint32),
                doc[place].astype(np.uint32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _groups(batches, "block"):
            yield from emit(block, rows)

    return run


def splits(seen: np.ndarray, buckets: int, tokens_all: int) -> np.ndarray:
    """Into how many parts the bigrams of a history with that count are split."""
    return np.maximum(1, seen * HOT_SHARE * buckets // max(tokens_all, 1)).astype(np.uint64)


def bucket_of(h, w, seen, buckets: int, tokens_all: int) -> np.ndarray:
    part = mix(w) % splits(seen, buckets, tokens_all)
    return (mix(h + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)


class Table:
    """One partition of the bigram table, with the occurrences to score."""

    def __init__(self, rows, unigrams: Unigrams):
        self.blocks, parts = [], []
        for _, block, payload in rows:
            hs, types, seen, w, cw, n, doc = unpack(payload)
            types = types.astype(np.int64)
            n = n.astype(np.int64)
            trained = np.add.reduceat((doc & 1 ^ 1).astype(np.int64), np.cumsum(n) - n)
            self.blocks.append((block, n, doc >> 1))
            parts.append((np.repeat(hs, types), w, np.repeat(seen, types), cw, trained))
        h, w, seen, cw, trained = (np.concatenate(c) for c in zip(*parts))
        self.cut = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
        order = np.lexsort((w, h))
        h, w = h[order], w[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
        first = np.flatnonzero(new)
        #: of each row sent, its type; types are sorted by history and word
        self.type = np.empty(len(order), dtype=np.int64)
        self.type[order] = np.cumsum(new) - 1
        self.h = h[first]
        self.r = np.add.reduceat(trained[order], first)
        self.seen = seen[order][first].astype(np.int64)
        self.p = unigrams.p(cw[order][first].astype(np.int64))
        new = np.concatenate([[True], self.h[1:] != self.h[:-1]])
        self.start = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        # of each history: its seen words' share of P, and its types of count 1..KATZ
        self.share = np.add.reduceat(np.where(self.r > 0, self.p, 0.0), self.start)
        self.small = np.stack([np.add.reduceat((self.r == k).astype(np.int64), self.start)
                               for k in range(1, KATZ + 1)], axis=1)

    def hot(self, buckets: int, tokens_all: int) -> np.ndarray:
        """Histories of which this partition holds a part only."""
        return splits(self.seen[self.start], buckets, tokens_all) > 1


def _count_pairs(unigrams: Unigrams, buckets: int):
    """Counts of counts of each partition, and the sums of its part of split histories."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, hs, share, small = np.zeros(KATZ + 2, dtype=np.int64), [], [], []
        for _, rows in _groups(batches, "bucket"):
            rows = [r for r in rows if r[0] == _PAIRS]
            if not rows:
                continue
            t = Table(rows, unigrams)
            n += counts_of_counts(t.r)
            hot = t.hot(buckets, unigrams.tokens)
            hs.append(t.h[t.start[hot]])
            share.append(t.share[hot])
            small.append(t.small[hot].reshape(-1))
        empty = [np.zeros(0, dtype=np.uint64)], [np.zeros(0)], [np.zeros(0, dtype=np.int64)]
        cat = [np.concatenate(x or e) for x, e in zip((hs, share, small), empty)]
        yield pa.RecordBatch.from_arrays([pa.array([pack(n, *cat)], pa.binary())], names=["stats"])
    return run


def _merge_stats(stats: list[bytes]):
    """Discounts, and (histories, share, small) of the split histories, sorted."""
    parts = [unpack(s) for s in stats]
    n = sum((p[0] for p in parts), np.zeros(KATZ + 2, dtype=np.int64))
    h = np.concatenate([p[1] for p in parts])
    hs, at = np.unique(h, return_inverse=True)
    share = np.zeros(len(hs))
    small = np.zeros((len(hs), KATZ), dtype=np.int64)
    order = np.lexsort((np.concatenate([p[2] for p in parts]), at))     # one order of sums
    np.add.at(share, at[order], np.concatenate([p[2] for p in parts])[order])
    np.add.at(small, at, np.concatenate([p[3] for p in parts]).reshape(-1, KATZ))
    return discounts(n), (hs, share, small)


def _score_pairs(unigrams: Unigrams, buckets: int):
    """Sums of log10 P per document, block and partition."""
    def sums(bucket, rows, d, hot) -> Iterator[pa.RecordBatch]:
        t = Table(rows, unigrams)
        share, small, seen = t.share, t.small, t.seen[t.start]
        split = np.flatnonzero(t.hot(buckets, unigrams.tokens))
        if len(split):
            at = np.searchsorted(hot[0], t.h[t.start[split]])
            share[split], small[split] = hot[1][at], hot[2][at]
        left = (small * ((1 - d[1:-1]) * np.arange(1, KATZ + 1))).sum(axis=1)
        none = (left <= 0) & (seen > 0)
        c = np.maximum(seen, 1)
        scale = np.where(none, c / (c + 1.0), 1.0)
        mass = np.where(none, 1 / (c + 1.0), left / c)
        back = np.where(seen > 0, np.log10(np.where(seen > 0, mass, 1.0)) - np.log10(1 - share), 0.0)
        logp = np.where(
            t.r > 0, np.log10(scale[t.of] * d[np.minimum(t.r, KATZ + 1)] * np.maximum(t.r, 1) / c[t.of]),
            back[t.of] + np.log10(t.p))
        for (block, n, doc), a, e in zip(t.blocks, t.cut[:-1], t.cut[1:]):
            total = np.bincount(doc, weights=np.repeat(logp[t.type[a:e]], n))
            docs = np.unique(doc)
            yield _row(bucket, _SUMS, block, pack(docs, total[docs]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = []

        def flat():
            for b in batches:
                if not stats and b.num_rows:
                    stats.append(_merge_stats(b.column("stats")[0].as_py()))
                yield b

        for bucket, rows in _groups(flat(), "bucket"):
            for kind, block, p in rows:
                if kind == _DOCS:
                    yield _row(bucket, _DOCS, block, p)
            pairs = sorted((r for r in rows if r[0] == _PAIRS), key=lambda r: r[1])
            if pairs:
                yield from sums(bucket, pairs, *stats[0])

    return run


RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def _totals(unigrams: Unigrams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.log10(unigrams.tokens + 0.1 * (unigrams.types + 1))
        for _, rows in _groups(batches, "block"):
            ids, known, out, per, n_known, logs = unpack(next(p for k, _, p in rows if k == _DOCS))
            score = np.zeros(len(ids))
            for _, _, p in sorted((r for r in rows if r[0] == _SUMS), key=lambda r: r[1]):
                doc, part = unpack(p)
                score[doc] += part
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=known == 0), pa.array(out.astype(bool)), pa.array(per),
                 pa.array(n_known), pa.array(np.full(len(ids), unigrams.tokens)),
                 pa.array(logs - per * floor), pa.array(score)],
                names=[f.split()[0] for f in RESULT.split(", ")])
    return run


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
           partitions: int | None = None) -> DataFrame:
    """Scores of every row under the model of the rows where ``held_out`` is false.

    ``docs`` must give the same rows in the same partitions when it is read again
    (files do).
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = scratch_dir(spark, f"katz-{uuid.uuid4().hex}")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       local(text_col))

    def dealt(df: DataFrame, by: str) -> DataFrame:
        return df.repartition(n, by).sortWithinPartitions(by, "kind", "block" if by == "bucket" else "bucket")

    dealt(rows.mapInArrow(_words(n), _ROW), "bucket").mapInArrow(_count_words, _ROW).write.parquet(f"{base}/words")
    words = spark.read.parquet(f"{base}/words")
    stats = [unpack(r.payload)[0] for r in words.where(f"kind = {_STATS}").select("payload").collect()]  # n rows
    unigrams = Unigrams(sum(stats, np.zeros(KATZ + 4, dtype=np.int64)))

    blocks = rows.mapInArrow(_tokens, _ROW).unionByName(words.where(f"kind = {_COUNTS}"))
    pairs = dealt(blocks, "block").mapInArrow(_pairs(n, n, unigrams.tokens), _ROW).repartition(n, "bucket")
    # read twice: for the counts of counts, then for the scores; Spark keeps one exchange for
    # both.  The sort comes after the join, as the optimizer drops one before it; the
    # key is never null, as a filter on it would make the two exchanges differ.
    order = ("bucket", "kind", "block")
    counted = pairs.sortWithinPartitions(*order).mapInArrow(_count_pairs(unigrams, n), "stats binary") \
        .agg(F.collect_list("stats").alias("stats")).withColumn("one", F.xxhash64("stats").bitwiseAND(0))  # a row a partition
    scored = pairs.withColumn("one", F.xxhash64("bucket").bitwiseAND(0)).join(F.broadcast(counted), "one") \
        .select("bucket", "kind", "block", "payload", "stats").sortWithinPartitions(*order) \
        .mapInArrow(_score_pairs(unigrams, n), _ROW)
    return dealt(scored, "block").mapInArrow(_totals(unigrams), RESULT)
