"""Hard negatives by anchor clusters that share one sorted list of candidates.

Anchors are clustered by direction and cut into parts of at most ``MEMBERS`` anchors of one
cluster.  With theta the largest angle between a part's members and their mean
direction c, no member u has an inner product with a vector x above
``|u| |x| cos(max(0, angle(x, c) - theta))``.  Every task sorts its vectors by that bound, less the
factor |u|, once for a part; each member then walks the list, with exact scores, and ends
where the bound of all that follows is below what it still needs.  The bound carries a slack
for rounding, so the end is certified.

Two walks: the first finds each anchor's positives (the first rows of its own label); the second the
negatives of each positive, the first rows of other labels whose scores lie in a range set by the
positive's score.  The second also ends below the least range.

The centroids are fitted on ``FIT_ROWS`` anchors at most; they decide how early the walks end, never the
result.  Parts are written, and broadcast in bundles of at most ``lattice.BLOCK_CELLS`` components (4 MB), so
vectors are read where they lie and only results are shuffled.

Rows with a null id or label, a null vector or a null or non-finite component take no part; a shorter vector
counts as filled with zeros.  Repeated rows are rows, anchors and positives of their own.  A
negative positive score leaves an empty range.  Other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.llm import lattice
from quillsync.llm.lattice import NONE, fit, products
from quillsync.llm.text import bounded_batches
from quillsync.session import scratch_dir

FIT_ROWS = 2048
FIT_ROUNDS = 8
ANCHORS_PER_CLUSTER = 32       # of the fitted ones
MEMBERS = 128                  # anchors that share a list
SEGMENT_CELLS = 1 << 21        # components of the vectors that are sorted together
CHUNK = 1024                   # places of the list that are scored together, at most
FIRST_CHUNK = 32               # at its head, where no entry is known yet; doubled from there on
SLACK = 1e-6

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_PART = "cells binary, ids binary, labels binary, dim int"


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows as unit vectors (zero rows stay zero), and their lengths."""
    size = np.linalg.norm(x, axis=1)
    return x / np.where(size > 0, size, 1)[:, None], size


def centroids(x: np.ndarray) -> np.ndarray:
    """Mean directions of clusters of the rows (spherical k-means from evenly spaced rows)."""
    unit, _ = _directions(x)
    k = max(1, len(unit) // ANCHORS_PER_CLUSTER)
    means = unit[np.linspace(0, len(unit) - 1, k).astype(int)] if len(unit) else unit
    for _ in range(FIT_ROUNDS if len(unit) else 0):
        near = np.argmax(unit @ means.T, axis=1)
        new = np.zeros_like(means)
        np.add.at(new, near, unit)
        means = np.where(np.linalg.norm(new, axis=1)[:, None] > 0, _directions(new)[0], means)
    return means


def _assign(shared, scale: float):
    """(cluster, id, label, vector) of the usable anchors."""
    def run(batches):
        means = shared.value
        for x, ids, labels in lattice.pieces(batches, "id", "label", scale=scale):
            unit, _ = _directions(x)
            near = np.argmax(fit(unit, means.shape[1]) @ means.T, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(near), pa.array(ids), pa.array(labels), pa.array(list(x), pa.list_(pa.float64()))],
                ["cluster", "id", "label", "vector"])
    return run


def _pack(batches):
    """Parts of anchors that follow each other in a partition and are of one cluster."""
    def part(x, ids, labels):
        return pa.RecordBatch.from_pylist(
            [{"cells": x.tobytes(), "ids": ids.tobytes(), "labels": labels.tobytes(), "dim": x.shape[1]}],
            pa.schema([("cells", pa.binary()), ("ids", pa.binary()), ("labels", pa.binary()), ("dim", pa.int32())]))

    for x, cluster, ids, labels in lattice.pieces(batches, "cluster", "id", "label", scale=1):
        edges = np.flatnonzero(np.diff(cluster)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(x)]):
            for at in range(lo, hi, MEMBERS):
                end = min(at + MEMBERS, hi)
                yield part(x[at:end], ids[at:end], labels[at:end])


class Part:
    """Anchors that share a list: their vectors, mean direction and largest angle to it."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, first: int):
        self.x, self.ids, self.labels, self.first = x, ids, labels, first
        unit, self.size = _directions(x)
        self.centre = _directions(unit.sum(axis=0, keepdims=True))[0][0]
        cos = np.clip(unit @ self.centre, -1, 1)[self.size > 0]
        self.angle = float(np.arccos(cos.min())) if len(cos) else 0.0

    def shared_list(self, unit: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vectors by falling upper bound, and the bounds (to be multiplied by a member's length)."""
        angle = np.arccos(np.clip(unit @ self.centre, -1, 1))
        bound = size * (np.cos(np.clip(angle - self.angle - SLACK, 0, np.pi)) + SLACK)
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def walk(self, x: np.ndarray, unit: np.ndarray, size: np.ndarray, visit) -> int:
        """``visit(members, places, scores)`` for chunks of the list, until no member goes on: it returns
        the score below which a member needs nothing more.  Returns how many scores were made."""
        order, bound = self.shared_list(unit, size)
        members, made = np.arange(len(self.x)), 0
        at, step = 0, FIRST_CHUNK
        while at < len(order) and len(members):
            places = order[at:at + step]
            need = visit(members, places, products(self.x[members], x[places]))
            made += len(members) * len(places)
            at, step = at + step, min(2 * step, CHUNK)
            if at < len(order):
                most = self.size[members] * bound[at]
                members = members[most + SLACK * np.abs(most) >= need]
        return made


class Best:
    """The first ``k`` entries (score, id) of every key, and each key's last score once it has k.

    New entries are gathered and sorted in once they are as many as those held, so that an entry costs
    about one place of a sort; until then floors are lower than they could be, which only lets more pass."""

    def __init__(self, keys: int, k: int):
        self.k, self.most = k, max(1024, keys * k)
        self.floor = np.full(keys, NONE)
        none = np.zeros(0, dtype=np.int64)
        self.held, self.new = [(none, none, none, np.zeros(0, dtype=bool))], 0

    def add(self, key, score, vec, own=None) -> None:
        good = np.flatnonzero(score >= self.floor[key])
        if not len(good):
            return
        own = np.zeros(len(good), dtype=bool) if own is None else own[good]
        self.held.append((key[good], score[good], vec[good], own))
        self.new += len(good)
        if self.new >= self.most:
            self.entries()

    def entries(self) -> tuple[np.ndarray, ...]:
        """(key, score, id, own) of the first entries so far, by key; floors are up to date after it."""
        if self.new:
            key, score, vec, own = (np.concatenate(c) for c in zip(*self.held))
            left = lattice.firsts(key, score, vec, self.k)
            key = key[left]
            self.held, self.new = [(key, score[left], vec[left], own[left])], 0
            # by key and falling score: the k-th of a key is its floor
            full = np.flatnonzero(key[self.k - 1:] == key[:len(key) - self.k + 1])
            self.floor[key[full]] = self.held[0][1][full + self.k - 1]
        return self.held[0]

    key, score, id, own = (property(lambda self, i=i: self.entries()[i]) for i in range(4))


def _segments(batches, dim: int, scale: float):
    """(x, unit, size, ids, labels) of about SEGMENT_CELLS components."""
    held, cells = [], 0
    for x, ids, labels in lattice.pieces(batches, "id", "label", scale=scale):
        held.append((x, ids, labels))
        cells += x.size
        if cells >= SEGMENT_CELLS:
            yield _segment(held, dim)
            held, cells = [], 0
    if held:
        yield _segment(held, dim)


def _segment(held, dim: int):
    # components beyond the anchors' meet zeros
    x = np.vstack([fit(h[0], dim) for h in held])
    unit, size = _directions(x)
    return x, unit, size, np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])


def _positives(shared, keep: int, scale: float):
    """(at, id, score, own): this task's first rows of each anchor's label."""
    def run(batches):
        parts, dim, _ = shared.value
        # a part's entries are sorted by themselves, whatever the number of anchors
        found = [Best(len(part.x), keep) for part in parts]
        for x, unit, size, ids, labels in _segments(batches, dim, scale):
            for part, best in zip(parts, found):
                def visit(members, places, scores, part=part, best=best):
                    m, p = np.nonzero((scores >= best.floor[members][:, None])
                                      & (part.labels[members, None] == labels[places]))
                    score, p, m = scores[m, p], places[p], members[m]
                    own = ids[p] == part.ids[m]
                    own[own] = (x[p[own]] == part.x[m[own]]).all(axis=1)
                    best.add(m, score, ids[p], own)
                    return best.floor[members]
                part.walk(x, unit, size, visit)
        for part, best in zip(parts, found):
            key, score, vec, own = best.entries()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part.first + key, vec, score, own)],
                                             ["at", "id", "score", "own"])
    return run


def _negatives(shared, per_anchor: int, keep: int, scale: float):
    """(slot, id, score): this task's first rows within each slot's range, of other labels than the
    anchor's.  A slot is an anchor's place times ``per_anchor`` plus a positive's."""
    def run(batches):
        parts, dim, _, low, high = shared.value
        # a row per member, a column per slot; a slot without a range (low above high) needs nothing
        low, high = low.reshape(-1, per_anchor), high.reshape(-1, per_anchor)
        found = [Best(len(part.x) * per_anchor, keep) for part in parts]
        for x, unit, size, ids, labels in _segments(batches, dim, scale):
            for part, best in zip(parts, found):
                of = slice(part.first, part.first + len(part.x))

                def least(members, best=best, lo=low[of], hi=high[of]):
                    now = np.maximum(best.floor.reshape(-1, per_anchor)[members], lo[members])
                    return np.where(lo[members] <= hi[members], now, np.iinfo(np.int64).max)

                def visit(members, places, scores, part=part, best=best, hi=high[of], least=least):
                    # what any slot of a member may take, then slot by slot
                    need = least(members)
                    m, p = np.nonzero((scores >= need.min(axis=1)[:, None])
                                      & (scores <= hi[members].max(axis=1)[:, None])
                                      & (part.labels[members, None] != labels[places]))
                    score, p = scores[m, p], places[p]
                    e, j = np.nonzero((score[:, None] >= need[m]) & (score[:, None] <= hi[members[m]]))
                    best.add(members[m[e]] * per_anchor + j, score[e], ids[p[e]])
                    return least(members).min(axis=1)
                part.walk(x, unit, size, visit)
        for part, best in zip(parts, found):
            key, score, vec, own = best.entries()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part.first * per_anchor + key, vec, score, own)],
                                             ["slot", "id", "score", "own"])
    return run


def _parts(spark, anchors: DataFrame, scale: float) -> DataFrame:
    """The anchors, clustered and packed into written parts."""
    # rows in the order of a hash, as a sample whatever the order of ids
    some = anchors.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).toArrow().combine_chunks()
    means = centroids(lattice.matrix(some.column("vector"), scale)[0])
    shared = spark.sparkContext.broadcast(means)
    kinds = "cluster long, id long, label long, vector array<double>"
    near = lattice.written(anchors.mapInArrow(_assign(shared, scale), kinds), "negatives-anchors")
    shared.destroy()
    size = near.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    dealt = near.repartitionByRange(lattice.parts_for(size["n"], size["dim"] or 1), "cluster", "id") \
        .sortWithinPartitions("cluster", "id")
    return lattice.written(dealt.mapInArrow(_pack, _PART), "negatives-parts")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: tuple = (3, 10),
         high: tuple = (9, 10), id_col: str = "vec_id", values_col: str = "embedding", label: Column | None = None,
         scale: float = lattice.SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A negative's score is between ``low`` and ``high`` (fractions, both included) of the positive's.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    label = F.col("label") if label is None else label
    rows = lattice.rows_of(vectors, id_col, values_col, label=label.cast("long"), asked=is_anchor) \
        .where(F.col("label").isNotNull())
    parts = _parts(spark, rows.where("asked"), scale)
    rows = rows.drop("asked")
    out = scratch_dir(spark, f"negatives-{uuid.uuid4().hex}")
    made = False
    for i, bundle in enumerate(lattice.bundles(parts)):
        x, ids = lattice.unpacked(bundle)
        labels = [np.frombuffer(r["labels"], dtype=np.int64) for r in bundle]
        first = np.cumsum([0, *[len(v) for v in ids]])
        cut = [Part(x[a:b], v, w, int(a)) for a, b, v, w in zip(first[:-1], first[1:], ids, labels)]
        n, dim = len(x), x.shape[1]
        if _mine_bundle(rows, cut, n, dim, np.concatenate(ids), positives, negatives, low, high, scale,
                        f"{out}/block={i}"):
            made = True
    if not made:
        return spark.createDataFrame([], RESULT)
    return spark.read.parquet(out).select(*[c.split()[0] for c in RESULT.split(", ")])


def _mine_bundle(rows, parts, n, dim, ids, positives, negatives, low, high, scale, path) -> bool:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((parts, dim, n))
    found = rows.mapInArrow(_positives(shared, positives + 1, scale), "at long, id long, score long, own boolean")
    chosen = lattice.ranked(found, "at", positives).collect()      # ``positives`` rows per anchor of the bundle
    shared.destroy()
    # one slot per anchor and positive, with the range of its negatives; empty where there is none
    least, most = np.full(n * positives, 1), np.full(n * positives, 0)
    slots = []
    for r in chosen:
        slot = r["at"] * positives + r["rank"] - 1
        least[slot] = -(-low[0] * r["score"] // low[1])
        most[slot] = high[0] * r["score"] // high[1]
        slots.append((slot, int(ids[r["at"]]), r["id"], r["score"]))
    if not slots:
        return False
    shared = spark.sparkContext.broadcast((parts, dim, n, least, most))
    entries = rows.mapInArrow(_negatives(shared, positives, negatives, scale),
                              "slot long, id long, score long, own boolean")
    named = F.broadcast(spark.createDataFrame(
        slots, "slot long, anchor_id long, positive_id long, positive_score long"))
    lattice.ranked(entries, "slot", negatives).join(named, "slot") \
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score")).write.parquet(path)
    shared.destroy()
    return True
