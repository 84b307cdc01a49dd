"""Exact top-k and hard negatives against plain loops over whole numbers."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillsync.llm import hard_negatives, lattice, threshold_topk

SCHEMA = "vec_id long, embedding array<double>, label int, score string, at int"


def whole(v):
    """The vector on the lattice; None where it takes no part."""
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def usable(rows):
    return [(i, whole(v), label) for i, v, label in rows if i is not None and whole(v) is not None]


def plain_topk(rows, every, k):
    rows = usable(rows)
    out = []
    for a, (i, v, _) in enumerate(rows):
        if i % every == 0:
            scores = sorted((-inner(v, w), j) for b, (j, w, _) in enumerate(rows) if b != a)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def plain_negatives(rows, every):
    rows = [r for r in usable(rows) if r[2] is not None]
    out = []
    for a, (i, v, label) in enumerate(rows):
        if i % every:
            continue
        scored = sorted((-inner(v, w), j, other == label) for b, (j, w, other) in enumerate(rows) if b != a)
        for ps, pid in [(-s, j) for s, j, same in scored if same][:5]:
            hard = [(-s, j) for s, j, same in scored if not same and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(i, pid, n + 1, j, ps, s) for n, (s, j) in enumerate(hard)]
    return sorted(out)


def clustered(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))
    x *= rng.uniform(0.2, 2, size=(n, 1))
    return [(i, [float(c) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]


ODD = [
    (None, [1.0, 2.0, 3.0], 1), (10, None, 1), (20, [], 1), (30, [None, 1.0, 2.0], 1), (40, [math.nan, 0.0, 1.0], 2),
    (50, [math.inf, 0.0, 1.0], 2), (60, [1.0], 1), (70, [0.0, 0.0, 0.0], 1), (80, [-1.0, 0.5, 2.0], None),
    (90, [1.0, 0.5, 2.0, 7.0, -1.0], 1), (100, [0.3, 0.1, 0.2], 1), (100, [0.3, 0.1, 0.2], 1), (100, [0.3, 0.1, 0.2], 2),
    (100, [0.1, 0.9, 0.2], 1), (-110, [0.2, 0.3, 0.4], 2), (5, [0.3, 0.1, 0.2], 3), (6, [0.3, 0.1, 0.2], 3),
    (7, [0.2, 0.1, 0.2], 3), (8, [0.1, 0.1, 0.1], 1), (9, [-0.3, -0.1, -0.2], 1), (3, [-0.0001, 0.0, 0.0], 2)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def small_blocks(monkeypatch):
    """Limits so small that queries, anchors, segments and steps come in many blocks."""
    monkeypatch.setattr(lattice, "BLOCK_CELLS", 60)


@pytest.mark.parametrize("lists", [1, 2, 4])
def test_topk_as_by_loops(spark, lists):
    for rows in (clustered(1, 300, 8, 0.3), clustered(2, 200, 3, 3.0), ODD, ODD[:3] + ODD[10:12]):
        docs = frame(spark, rows)
        res = threshold_topk.topk(docs, docs.where("vec_id % 10 = 0"), 5, lists=lists)
        assert res.columns == ["query_id", "rank", "vec_id", "score"]
        assert got(res) == plain_topk(rows, 10, 5)


def test_topk_in_many_blocks(spark, small_blocks):
    rows = clustered(3, 150, 6, 0.5) + [(1000 + i, [0.5] * 6, 1) for i in range(60)]
    docs = frame(spark, rows)
    assert got(threshold_topk.topk(docs, docs.where("vec_id % 10 = 0"), 5)) == plain_topk(rows, 10, 5)


def test_topk_of_numbers_beyond_doubles(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 5, 6]) for _ in range(4)], 1) for i in range(80)]
    docs = frame(spark, rows)
    assert got(threshold_topk.topk(docs, docs.where("vec_id % 10 = 0"), 5)) == plain_topk(rows, 10, 5)


def test_sufficient_entries_are_few():
    """Phase 2 collects a part of the pairs only, and every result is among them."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(4000, 32)) / 5.6)
    q = x[::100]
    whole_scores = lattice.products(q, x)
    tau = np.sort(whole_scores, axis=1)[:, -6]
    lists = threshold_topk._list_scores(q, x, 2)
    enough = (lists[0] >= tau[:, None] / 2) | (lists[1] >= tau[:, None] / 2)
    assert enough[whole_scores >= tau[:, None]].all() and enough.mean() < 0.1


def test_negatives_as_by_loops(spark):
    for rows in (clustered(6, 300, 8, 0.3), clustered(7, 250, 3, 3.0), ODD):
        res = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
        assert res.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert got(res) == plain_negatives(rows, 10)
    assert len(plain_negatives(ODD, 10)) > 5


def test_negatives_in_many_parts(spark, small_blocks, monkeypatch):
    rows = clustered(8, 150, 6, 0.5) + [(1000 + i, [0.5] * 6, i % 2) for i in range(60)]
    assert got(hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)) == plain_negatives(rows, 10)


def test_hot_label_and_equal_vectors(spark):
    rows = [(i, [1.0, 0.5], 1) for i in range(400)] + [(i, [0.5, 0.5 * (i % 3)], i % 3) for i in range(400, 500)]
    assert got(hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 100 == 0)) == plain_negatives(rows, 100)


def test_walks_end_early_and_miss_nothing(monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK", 64)
    rows = clustered(9, 6000, 16, 0.05)
    x, _ = lattice.matrix(pa.array([r[1] for r in rows]))
    anchors = np.flatnonzero(np.argmax(x @ hard_negatives.centroids(x[::100]).T, axis=1) == 0)[:40]
    part = hard_negatives.Part(x[anchors], anchors, np.zeros(len(anchors), dtype=np.int64), 0)
    unit, size = hard_negatives._directions(x)
    best = hard_negatives.Best(len(anchors), 10)

    def visit(members, places, scores):
        m, p = np.nonzero(scores > lattice.NONE)
        best.add(members[m], scores[m, p], places[p])
        return best.floor[members]

    made = part.walk(x, unit, size, visit)
    assert made < 0.5 * len(anchors) * len(x)
    want = np.sort(lattice.products(x[anchors], x), axis=1)[:, -10:]
    assert np.array_equal(np.sort(best.score.reshape(len(anchors), 10), axis=1), want)


def test_empty_tables(spark):
    empty = frame(spark, ODD).limit(0)
    assert threshold_topk.topk(empty, empty, 5).collect() == []
    assert hard_negatives.mine(empty, F.lit(True)).collect() == []
    none = frame(spark, ODD)
    assert threshold_topk.topk(none, none.where("vec_id = 12345"), 5).collect() == []
    assert hard_negatives.mine(none, F.lit(False)).collect() == []


def test_best_entries_cost_a_sort_now_and_then(monkeypatch):
    # many keys, few new entries a time: sorting all that is held each time made the walks cubic
    rng = np.random.default_rng(4)
    sizes = []
    firsts = lattice.firsts
    monkeypatch.setattr(lattice, "firsts", lambda keys, *rest: sizes.append(len(keys)) or firsts(keys, *rest))
    n, k, steps = 500, 4, 400
    best = hard_negatives.Best(n, k)
    added = []
    for _ in range(steps):
        key, score, vec = rng.integers(0, n, 100), rng.integers(0, 1000, 100), rng.integers(0, 10 ** 6, 100)
        added.append((key, score, vec))
        best.add(key, score, vec)
    key, score, vec, _ = best.entries()
    a, b, c = (np.concatenate(x) for x in zip(*added))
    want = [sorted(zip(-b[a == i], c[a == i]))[:k] for i in range(n)]
    assert [sorted(zip(-score[key == i], vec[key == i])) for i in range(n)] == want
    assert sum(sizes) <= 4 * steps * 100
