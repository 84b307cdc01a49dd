"""Exact top-k over clustered blocks of vectors, skipping blocks that cannot reach the k-th score.

An index is two written tables: the vectors, partitioned by block, and one row per block with
its centre, the largest distance of a vector to it (radius) and its number of rows.  No vector
of a block has a score above ``q.c + |q| radius`` with a query q.  A search

1. scores each query against the blocks with its highest bounds, as many as hold ``k`` rows,
   which gives a score that the k-th result reaches;
2. scores the blocks whose bound reaches that score, and no others.

Both read the partitions of the asked blocks only, in place; queries go to the tasks in sets of at
most ``QUERIES_MAX``.  The centres are fitted on ``FIT_ROWS`` vectors at most; that decides how many blocks
are skipped, never the result.  Results are those of :func:`quillsync.operators.retrieval.topk`.
"""

from __future__ import annotations

import math
import os
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsync.functions.predicates import predicate
from quillsync.operators.retrieval import SCORE_DECIMALS, TOPK_SCHEMA, _score_into, _stack

FIT_ROWS = 8192
FIT_ROUNDS = 8
QUERIES_MAX = 4096
BLOCKS_MAX = 4096              # rows of the block table, which the driver reads
#: scores are rounded, and bounds computed in doubles: what may be lost
SLACK = 2 * 10 ** -SCORE_DECIMALS


@dataclass
class BlockIndex:
    vectors: DataFrame             # block, id, values and the other columns
    blocks: DataFrame              # block, centre, radius, rows


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    """Centres of k-means, begun at evenly spaced rows."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(FIT_ROUNDS):
        near = np.argmin((centres ** 2).sum(1) - 2 * x @ centres.T, axis=1)
        total, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(total, near, x)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def build(vectors: DataFrame, path: str, blocks: int = 64) -> BlockIndex:
    """Writes the index of ``vectors`` (id, values of one length, any other columns) below ``path``."""
    spark = vectors.sparkSession
    if not 0 < blocks <= BLOCKS_MAX:
        raise ValueError(f"between 1 and {BLOCKS_MAX} blocks")
    usable = vectors.where(F.col("values").isNotNull())
    # a sample by hash: the same rows whatever their order
    some = usable.select("id", "values").orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).toPandas()
    if some.empty:
        centres = np.zeros((1, 0))
    else:
        centres = _centres(_stack(some["values"]), blocks)
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("block int, distance double")
    def nearest(values: pd.Series) -> pd.DataFrame:
        c = shared.value
        x = _stack(values)
        near = np.argmin((c ** 2).sum(1) - 2 * x @ c.T, axis=1)
        return pd.DataFrame({"block": near, "distance": np.linalg.norm(x - c[near], axis=1)})

    placed = usable.withColumn("_p", nearest("values")).select("*", "_p.block", "_p.distance").drop("_p")
    placed.hint("rebalance", "block").write.partitionBy("block").parquet(os.path.join(path, "vectors"))
    shared.destroy()
    schema = placed.schema
    rows = spark.read.schema(schema).parquet(os.path.join(path, "vectors"))
    centre = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)],
                                   "block int, centre array<double>")
    stats = rows.groupBy("block").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("rows"))
    centre.join(stats, "block").write.parquet(os.path.join(path, "blocks"))
    return BlockIndex(rows.drop("distance"), spark.read.parquet(os.path.join(path, "blocks")))


def open_index(spark, path: str) -> BlockIndex:
    return BlockIndex(spark.read.parquet(os.path.join(path, "vectors")).drop("distance"),
                      spark.read.parquet(os.path.join(path, "blocks")))


def _scan(k: int, ids: list, shared):
    """Scores every batch's rows with the queries that ask for their block."""
    def run(batches):
        q, asked = shared.value
        best = [[] for _ in ids]
        for pdf in batches:
            for block, rows in pdf.groupby("block"):
                who = np.flatnonzero(asked[:, block])
                if len(who):
                    mine = [best[w] for w in who]
                    _score_into(mine, q[who], _stack(rows["values"]), rows["id"].to_numpy(dtype=object), k)
                    for w, b in zip(who, mine):
                        best[w] = b
        yield pd.DataFrame([(ids[i], v, s) for i, b in enumerate(best) for s, v in b],
                           columns=["query_id", "id", "score"])
    return run


def _first(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def topk(index: BlockIndex, queries: DataFrame, k: int = 5,
         where: Mapping | None = None) -> tuple[DataFrame, dict[str, float]]:
    """(query_id, id, score, rank), and what was scanned: ``pairs`` (queries x rows), ``scored`` and the
    ``skipped`` share.  ``where`` (a metadata predicate) is taken into the scan; blocks then promise
    no number of rows, so the first step may find fewer than ``k`` and fewer blocks are skipped."""
    spark = index.vectors.sparkSession
    blocks = index.blocks.orderBy("block").toPandas()      # BLOCKS_MAX rows at most
    empty = spark.createDataFrame([], TOPK_SCHEMA + ", rank int")
    counted = {"pairs": 0, "scored": 0}
    out = []
    if len(blocks):
        centre, radius = _stack(blocks["centre"]), blocks["radius"].to_numpy()
        size, number = blocks["rows"].to_numpy(), blocks["block"].to_numpy()
        rows = index.vectors.where(F.col("values").isNotNull())
        if where is not None:
            rows = rows.where(predicate(where, index.vectors.schema, "metadata"))
        rows = rows.select(F.col("id").cast("string").alias("id"), "values", "block")
        asking = queries.where(F.col("values").isNotNull()).select(
            F.col("query_id").cast("string").alias("query_id"), F.col("values"))
        sets = max(1, math.ceil(asking.count() / QUERIES_MAX))
        for i in range(sets):
            part = asking if sets == 1 else asking.where(F.pmod(F.xxhash64("query_id"), F.lit(sets)) == i)
            out.append(_search(spark, rows, part.toPandas(), k, centre, radius, size, number, counted))
    hits = empty
    for h in out:
        hits = h if hits is empty else hits.unionByName(h)
    counted["skipped"] = 1 - counted["scored"] / counted["pairs"] if counted["pairs"] else 0.0
    return hits, counted


def _search(spark, rows, asked, k, centre, radius, size, number, counted) -> DataFrame:
    if asked.empty:
        return spark.createDataFrame([], TOPK_SCHEMA + ", rank int")
    ids = asked["query_id"].tolist()
    q = _stack(asked["values"])
    bound = q @ centre.T + np.linalg.norm(q, axis=1)[:, None] * radius + SLACK
    order = np.argsort(-bound, axis=1, kind="stable")
    # the blocks with the highest bounds, until they hold k rows
    before = np.cumsum(size[order], axis=1) - size[order]
    probe = np.zeros_like(bound, dtype=bool)
    np.put_along_axis(probe, order, before < k, axis=1)

    def scanned(want: np.ndarray) -> DataFrame:
        table = np.zeros((len(ids), int(number.max()) + 1), dtype=bool)
        table[:, number] = want
        use = [int(b) for b in number[want.any(axis=0)]]
        counted["scored"] += int((want * size).sum())
        shared = spark.sparkContext.broadcast((q, table))
        return rows.where(F.col("block").isin(use)).mapInPandas(_scan(k, ids, shared), TOPK_SCHEMA)

    # k rows per query of the set
    first = _first(scanned(probe), k).toPandas()
    least = np.full(len(ids), -np.inf)
    full = first[first["rank"] == k].set_index("query_id")["score"]
    for i, name in enumerate(ids):
        least[i] = full.get(name, -np.inf)
    rest = (bound >= least[:, None]) & ~probe
    counted["pairs"] += int(len(ids) * size.sum())
    found = spark.createDataFrame(first[["query_id", "id", "score"]], TOPK_SCHEMA) if len(first) \
        else spark.createDataFrame([], TOPK_SCHEMA)
    if rest.any():
        found = found.unionByName(scanned(rest))
    return _first(found, k)
