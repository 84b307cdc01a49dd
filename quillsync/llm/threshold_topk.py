"""Exact top-k by inner product in three phases with a uniform threshold.

A vector's components are dealt to ``lists`` groups; a group's inner product with a
query is the vector's score in that list, and the lists' scores add up to the whole.

1. Every task gathers the first entries of its part of each list, and the whole scores of the
   vectors in them; the k-th best of these over all tasks is a score tau that the k-th result
   has at least.
2. The cutoff tau / lists goes to all tasks.  A vector that is below it in every list has
   less than tau in all, so the vectors at or above it in some list are sufficient.
3. The remaining list scores of these vectors are added, and those with tau or more
   are ranked exactly, ties by smaller id.

All lists of a vector lie in the task that reads it, so that phases 2 and 3 share a job, no entry but
a task's results is shuffled, and vectors are read where they lie.  Queries are broadcast in
blocks of at most ``lattice.BLOCK_CELLS`` components (4 MB), whatever their number; every block's results
are written before the next one starts.

Null vectors, vectors with a null or non-finite component and rows with a null id take no part; a shorter
vector counts as filled with zeros.  Repeated rows are candidates, and queries, of their own.  Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsync.llm import lattice
from quillsync.llm.lattice import NONE, fit, products
from quillsync.llm.text import bounded_batches
from quillsync.session import scratch_dir

LISTS = 2
RESULT = "query_id long, rank int, vec_id long, score long"


def _pack(scale: float):
    def run(batches):
        for x, ids in lattice.pieces(batches, "id", scale=scale):
            yield pa.RecordBatch.from_pylist(
                [{"cells": x.tobytes(), "ids": ids.tobytes(), "dim": x.shape[1]}],
                pa.schema([("cells", pa.binary()), ("ids", pa.binary()), ("dim", pa.int32())]))
    return run


def _list_scores(q: np.ndarray, x: np.ndarray, lists: int) -> list[np.ndarray]:
    """The scores in each list; of one list where the numbers are too large to be added."""
    dim = q.shape[1]
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, dim) >= lattice.EXACT:
        return [products(q, x)]
    return [products(q[:, c], x[:, c]) for c in np.array_split(np.arange(dim), lists)]


def _steps(batches, queries: np.ndarray, scale: float):
    """(first, end, x, ids): vectors against as many queries as make STEP_CELLS scores."""
    dim = queries.shape[1]
    for x, ids in lattice.pieces(batches, "id", scale=scale):
        x = fit(x, dim)
        step = max(1, lattice.STEP_CELLS // len(x))
        for lo in range(0, len(queries), step):
            yield lo, min(lo + step, len(queries)), x, ids


def _gather(shared, lists: int, keep: int, scale: float):
    """Phase 1: (at, score): the best whole scores among the first entries of this task's lists."""
    def run(batches):
        queries, _ = shared.value
        best = np.full((len(queries), keep), NONE)
        for lo, hi, x, _ in _steps(batches, queries, scale):
            scores = _list_scores(queries[lo:hi], x, lists)
            if len(x) > keep:
                first = [np.argpartition(s, len(x) - keep, axis=1)[:, -keep:] for s in scores]
                at = np.sort(np.concatenate(first, axis=1), axis=1)
            else:
                at = np.tile(np.arange(len(x)), (hi - lo, 1))
            whole = sum(np.take_along_axis(s, at, axis=1) for s in scores)
            whole[:, 1:][at[:, 1:] == at[:, :-1]] = NONE       # a vector that is first in two lists
            both = np.concatenate([best[lo:hi], whole], axis=1)
            best[lo:hi] = np.sort(both, axis=1)[:, -keep:]
        at, place = np.nonzero(best != NONE)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(best[at, place])], ["at", "score"])
    return run


def _resolve(shared, lists: int, keep: int, scale: float):
    """Phases 2 and 3: (at, query_id, id, score, own) of this task's results."""
    def run(batches):
        queries, ids, tau = shared.value
        held = [np.zeros(0, dtype=np.int64)] * 3 + [np.zeros(0, dtype=bool)]
        waiting, n = [], 0

        def settle():
            at, vec, score, own = (np.concatenate(c) for c in zip(held, *waiting))
            left = lattice.firsts(at, score, vec, keep)
            return [c[left] for c in (at, vec, score, own)]

        for lo, hi, x, vec in _steps(batches, queries, scale):
            scores = _list_scores(queries[lo:hi], x, lists)
            least = tau[lo:hi, None]
            enough = scores[0] >= least / len(scores) if len(scores) > 1 else scores[0] >= least
            for s in scores[1:]:
                enough |= s >= least / len(scores)
            at, j = np.nonzero(enough)
            whole = sum(s[at, j] for s in scores)
            good = whole >= tau[lo + at]
            at, j, whole = at[good] + lo, j[good], whole[good]
            own = vec[j] == ids[at]
            own[own] = (queries[at[own]] == x[j[own]]).all(axis=1)
            waiting.append((at, vec[j], whole, own))
            n += len(at)
            if n > lattice.STEP_CELLS:
                held, waiting, n = settle(), [], 0
        at, vec, score, own = settle()
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (at, ids[at], vec, score, own)],
                                         ["at", "query_id", "id", "score", "own"])
    return run


def _cutoffs(gathered: DataFrame, n: int, keep: int) -> np.ndarray:
    """tau of every query of a block; NONE where fewer than ``keep`` vectors are there."""
    w = Window.partitionBy("at").orderBy(F.desc("score"))
    rows = gathered.withColumn("place", F.row_number().over(w)).where(F.col("place") == keep) \
        .select("at", "score").collect()          # one row per query of a block at most
    tau = np.full(n, NONE)
    for r in rows:
        tau[r["at"]] = r["score"]
    return tau


def topk(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", values_col: str = "embedding",
         scale: float = lattice.SCALE, lists: int = LISTS) -> DataFrame:
    """The k first rows of ``vectors`` for each row of ``queries`` (rows of the same table; the own
    row does not count): (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = lattice.rows_of(vectors, id_col, values_col)
    asking = lattice.rows_of(queries, id_col, values_col)
    size = asking.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    blocks = lattice.written(
        asking.repartition(lattice.parts_for(size["n"], size["dim"] or 1))
        .mapInArrow(_pack(scale), "cells binary, ids binary, dim int"), "topk-queries")
    out = scratch_dir(spark, f"topk-{uuid.uuid4().hex}")
    keep = k + 1                                   # the own row may be one of them
    made = False
    for i, bundle in enumerate(lattice.bundles(blocks)):
        q, ids = lattice.unpacked(bundle)
        ids = np.concatenate(ids)
        first = spark.sparkContext.broadcast((q, ids))
        tau = _cutoffs(rows.mapInArrow(_gather(first, lists, keep, scale), "at long, score long"), len(q), keep)
        second = spark.sparkContext.broadcast((q, ids, tau))
        entries = rows.mapInArrow(_resolve(second, lists, keep, scale),
                                  "at long, query_id long, id long, score long, own boolean")
        lattice.ranked(entries, "at", k).select("query_id", "rank", F.col("id").alias("vec_id"), "score") \
            .write.parquet(f"{out}/block={i}")
        first.destroy()
        second.destroy()
        made = True
    if not made:
        return spark.createDataFrame([], RESULT)
    return spark.read.parquet(out).select("query_id", "rank", "vec_id", "score")
