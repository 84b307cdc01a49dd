"""Quality classifier: a factorisation machine over hashed words and structure.

score(x) = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the
pairwise sum is computed in linear time as
1/2 * sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

Features of a text (nothing else of the row is read):

* hashed words: ``WORD_BUCKETS`` buckets, x = count / norm of the counts;
* structure: shares of byte classes, of repeated words and lines, of words said twice running,
  mean word and line length; metadata: length in bytes, words and lines.
  Each is cut into ``BINS`` intervals, one feature per interval.

Empty or null texts have structure features only and so get a score as well.

The machine is fitted on at most ``TRAIN_ROWS`` labelled rows, those with the
smallest hash of doc_id among the labelled rows left for learning (a bounded
sample, the same at every input size); everything else reads all rows.
Labels that are null are skipped; a document with several labels counts once
for each value, and of several documents with one id the smallest text counts.  Without any labelled row every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsync.llm.text import SPACE, Words, local, released, slices

TRAIN_ROWS = 6000
WORD_BUCKETS = 1 << 14
BINS = 16
FACTORS = 8
EPOCHS = 12
RATE = 0.08
BATCH = 64
THRESHOLD = 0.3

_PUNCT = "|!#$%&*.,;:<>{}[]()=/\\\"'@_+-?~^`"
_CLASSES = 8 + len(_PUNCT)


def _byte_classes() -> np.ndarray:
    t = np.zeros(256, dtype=np.int64)
    t[np.arange(256) < 32] = 1
    t[10], t[32] = 2, 3
    t[48:58], t[65:91], t[97:123], t[128:] = 4, 5, 6, 7
    for i, c in enumerate(_PUNCT):
        t[ord(c)] = 8 + i
    return t


BYTE_CLASS = _byte_classes()
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[10] = True
_SHARES = _CLASSES + 5
_STATS = _SHARES + 5
SIZE = WORD_BUCKETS + _STATS * BINS


def _ratio(a, b):
    return np.divide(a, b, out=np.zeros(np.shape(a), dtype=np.float64), where=b > 0)


def _repeats(words: Words) -> np.ndarray:
    """Share of the pieces of each text that repeat an earlier one of it."""
    n = len(words.first) - 1
    doc = words.doc()
    order = np.lexsort((words.hash, doc))
    h, d = words.hash[order], doc[order]
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    return _ratio(np.bincount(d[again], minlength=n).astype(float), words.counts)


def _runs(words: Words) -> np.ndarray:
    """Share of the words of each text that equal the word before."""
    doc, same = words.doc(), np.zeros(len(words.hash), dtype=bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    return _ratio(np.bincount(doc[same], minlength=len(words.counts)).astype(float), words.counts)


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (indptr, index, value) of a block of texts."""
    words, lines = Words(column), Words(column, breaks=_NEWLINE, lower=False)
    n = len(words.first) - 1
    length = np.diff(words.offsets)
    of_byte = np.repeat(np.arange(n) * _CLASSES, length)
    classes = np.bincount(of_byte + BYTE_CLASS[words.data], minlength=n * _CLASSES).reshape(n, _CLASSES)
    nw, nl = words.counts, lines.counts
    spans = np.concatenate([[0], np.cumsum(words.end - words.start)])
    in_words = spans[words.first[1:]] - spans[words.first[:-1]]
    first = np.where(nw > 0, words.first[:-1], 0)
    upper = np.zeros(len(words.start), dtype=float)
    if len(upper):
        upper = (BYTE_CLASS[words.data[words.start]] == 5).astype(float)
    ups = np.concatenate([[0], np.cumsum(upper)])
    shares = np.column_stack([
        _ratio(classes.astype(float), np.repeat(length, _CLASSES).reshape(n, _CLASSES)) if n else
        np.zeros((0, _CLASSES)),
        _repeats(words), _repeats(lines),
        _ratio(ups[words.first[1:]] - ups[words.first[:-1]], nw),
        _ratio((classes[:, 2]).astype(float), np.maximum(nw, 1)), _runs(words)])
    logs = np.column_stack([np.log2(1.0 + x) / 1.25 for x in (
        length, nw, nl, 4 * _ratio(in_words.astype(float), nw), _ratio(length.astype(float), nl))])
    bins = np.concatenate([np.floor(BINS * np.sqrt(np.minimum(shares, 1.0))), np.floor(logs)], axis=1)
    bins = np.clip(bins, 0, BINS - 1).astype(np.int64)
    stat = WORD_BUCKETS + np.arange(_STATS) * BINS + bins                    # n x stats

    key = words.doc() * WORD_BUCKETS + (words.hash & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    of = key // WORD_BUCKETS
    norm = np.sqrt(np.bincount(of, weights=count.astype(float) ** 2, minlength=n))
    value = count / norm[of] if len(key) else np.zeros(0)
    per = np.bincount(of, minlength=n) + _STATS
    ptr = np.concatenate([[0], np.cumsum(per)])
    index = np.empty(ptr[-1], dtype=np.int32)
    x = np.empty(ptr[-1], dtype=np.float32)
    at = ptr[:-1, None] + np.arange(_STATS)
    index[at], x[at] = stat, 1.0 / np.sqrt(_STATS)
    rest = np.ones(ptr[-1], dtype=bool)
    rest[at] = False
    index[rest], x[rest] = key % WORD_BUCKETS, value
    return ptr, index, x


def raw_scores(model: dict, ptr, index, x) -> np.ndarray:
    """The machine's output before the sigmoid, in time linear in the features."""
    if len(ptr) == 1:
        return np.zeros(0)
    at = ptr[:-1]
    w, v = model["w"][index], model["v"][index]
    vx = v * x[:, None]
    total = np.add.reduceat(vx, at, axis=0)
    squares = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), at)
    return model["w0"] + np.add.reduceat(w * x, at) + 0.5 * ((total ** 2).sum(axis=1) - squares)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit(ptr, index, x, y, seed: int = 7) -> dict:
    """Mini-batch Adagrad on the logistic loss; the order of rows decides nothing
    but rounding, as it is shuffled from a fixed seed."""
    rng = np.random.default_rng(seed)
    model = {"w0": np.float32(0), "w": np.zeros(SIZE, np.float32),
             "v": rng.normal(0, 0.05, (SIZE, FACTORS)).astype(np.float32)}
    if not len(y):
        return model
    model["w0"] = np.float32(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    gw, gv = np.full(SIZE, 1e-6, np.float32), np.full((SIZE, FACTORS), 1e-6, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for s in range(0, len(y), BATCH):
            rows = np.sort(order[s:s + BATCH])
            per = ptr[rows + 1] - ptr[rows]
            at = np.concatenate([[0], np.cumsum(per)])
            take = np.repeat(ptr[rows] - at[:-1], per) + np.arange(at[-1])
            i, xi = index[take], x[take]
            of = np.repeat(np.arange(len(rows)), per)
            err = (sigmoid(raw_scores(model, at, i, xi)) - y[rows]) / len(rows)
            model["w0"] -= np.float32(RATE * err.sum())
            v = model["v"][i]
            total = np.add.reduceat(v * xi[:, None], at[:-1], axis=0)
            ex = (err[of] * xi).astype(np.float32)
            uniq, inv = np.unique(i, return_inverse=True)
            dw = np.bincount(inv, weights=ex, minlength=len(uniq)).astype(np.float32)
            dv = ex[:, None] * (total[of] - v * xi[:, None])
            dv = np.column_stack([np.bincount(inv, weights=dv[:, f], minlength=len(uniq))
                                  for f in range(FACTORS)]).astype(np.float32)
            dw += 1e-5 * model["w"][uniq]
            dv += 1e-4 * model["v"][uniq]
            gw[uniq] += dw ** 2
            gv[uniq] += dv ** 2
            model["w"][uniq] -= RATE * dw / np.sqrt(gw[uniq])
            model["v"][uniq] -= RATE * dv / np.sqrt(gv[uniq])
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> dict:
    """Fit on at most ``rows`` labelled rows; the sampled labels (bounded) are broadcast
    and the features, not the texts, come to the driver."""
    wanted = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .where(F.col("id").isNotNull() & F.col("y").isNotNull())
              .orderBy(F.xxhash64("id"), "id", "y").limit(rows))
    known = docs.select(F.col(id_col).alias("id"), local(text_col)).join(F.broadcast(wanted), "id") \
        .groupBy("id", "y").agg(F.min("text").alias("text"))   # one row an id, so still bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ptr, index, x = features(b.column("text"))
            cut = [(ptr[i], ptr[i + 1]) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").cast(pa.string()), b.column("y"),
                 pa.array([index[a:e].tobytes() for a, e in cut], pa.binary()),
                 pa.array([x[a:e].astype(np.float16).tobytes() for a, e in cut], pa.binary())],
                names=["id", "y", "i", "x"])

    got = known.mapInArrow(released(run), "id string, y int, i binary, x binary").collect()  # <= rows
    got.sort(key=lambda r: (r.id, r.y, r.i))
    parts = [np.frombuffer(r.i, np.int32) for r in got]
    ptr = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    index = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    x = np.concatenate([np.frombuffer(r.x, np.float16) for r in got]).astype(np.float32) if parts \
        else np.zeros(0, np.float32)
    return fit(ptr, index, x, np.array([r.y for r in got], dtype=np.float32))


def score(docs: DataFrame, model: dict, text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if at least the threshold).

    Columns of those names are replaced; all others are kept.  No shuffle; the
    model has a fixed size (``SIZE`` weights and factor rows).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    flat = docs.select(*[F.col(f"`{c}`") for c in kept], local(text_col, "__text"))
    schema = flat.drop("__text").schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            s = sigmoid(raw_scores(shared.value, *features(b.column("__text"))).astype(np.float64))
            cols = [b.column(c) for c in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*kept, "score", "predicted"])

    return flat.mapInArrow(released(run), schema)
