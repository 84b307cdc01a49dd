"""Retrieval: exact top-k similarity, context assembly, term search.

Top-k is an exact nearest-neighbour search in two shapes:

* a query set of checked, bounded size is broadcast; each vector partition
  is scored in place with a numpy matrix product (``mapInPandas``) and keeps
  only its own top ``k`` per query, so vectors are never shuffled;
* a larger query set is joined block-wise: vectors hashed into ``bv`` blocks,
  queries into ``bq`` blocks, one cogroup per block pair.

Either way a final ``row_number`` keeps the global top ``k`` from at most
``k`` candidates per query and task; no query x vector pair is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsync.functions.predicates import predicate

SCORE_DECIMALS = 6
VECTORS_PER_BLOCK = 50_000
QUERIES_PER_BLOCK = 1_024
# Query sets up to this many rows are broadcast (checked with a count of the
# query side); larger ones take the blocked cogroup path.
BROADCAST_QUERIES_MAX = 4_096
# A cogroup block holds at most this many vector (or query) values: 16M
# doubles, 128 MB, whatever the dimension.
BLOCK_CELLS = 16_000_000
TERMS_BROADCAST_MAX = 200_000
# Hits (queries x k rows) up to this many rows are broadcast into the joins
# that attach chunk text and titles, so the stores are never shuffled.
HITS_BROADCAST_MAX = 1_000_000

TOPK_SCHEMA = "query_id string, id string, score double"


# A scoring step holds at most this many query x vector scores (1M doubles,
# 8 MB, of which up to four copies are alive at once): vector batches are scored
# in column slices of that size.
MAX_SCORE_CELLS = 1_000_000


def _merge_topk(best: list, S, ids, k: int) -> None:
    """Fold a score block (queries x vectors) into each query's running top k.

    Everything scoring at least the block's k-th best is a candidate, so ties
    at the boundary are settled by id exactly; ``best[q]`` stays <= k long.
    """
    import numpy as np

    kk = min(k, S.shape[1])
    if kk == 0:
        return
    # a query whose k-th best so far beats the whole block needs no merge
    floor = np.array([b[-1][0] if len(b) == k else -np.inf for b in best])
    ask = np.flatnonzero(S.max(axis=1) >= floor)
    if not len(ask):
        return
    kth = np.maximum(-np.partition(-S[ask], kk - 1, axis=1)[:, kk - 1], floor[ask])
    for q, least in zip(ask, kth):
        cand = np.nonzero(S[q] >= least)[0]
        merged = best[q] + [(float(S[q, j]), ids[j]) for j in cand]
        merged.sort(key=lambda t: (-t[0], t[1]))
        best[q] = merged[:k]


def _score_into(best: list, Q, V, ids, k: int) -> None:
    import numpy as np

    step = max(1, MAX_SCORE_CELLS // max(1, Q.shape[0]))
    for lo in range(0, V.shape[0], step):
        S = np.round(Q @ V[lo:lo + step].T, SCORE_DECIMALS)
        _merge_topk(best, S, ids[lo:lo + step], k)


def _stack(values) -> "np.ndarray":
    import numpy as np
    return np.vstack([np.asarray(v, dtype=np.float64) for v in values])


def _block_topk(k: int):
    import pandas as pd

    def run(vdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        if vdf.empty or qdf.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        qids = qdf["query_id"].tolist()
        best = [[] for _ in qids]
        _score_into(best, _stack(qdf["values"]), _stack(vdf["values"]),
                    vdf["id"].to_numpy(dtype=object), k)
        rows = [(qids[q], i, sc) for q in range(len(qids)) for sc, i in best[q]]
        return pd.DataFrame(rows, columns=["query_id", "id", "score"])

    return run


def _partition_topk(k: int, qids: list, bq):
    import pandas as pd

    def run(batches):
        Q = bq.value
        best = [[] for _ in qids]
        for pdf in batches:
            if not pdf.empty:
                _score_into(best, Q, _stack(pdf["values"]), pdf["id"].to_numpy(dtype=object), k)
        rows = [(qids[q], i, sc) for q in range(len(qids)) for sc, i in best[q]]
        yield pd.DataFrame(rows, columns=["query_id", "id", "score"])

    return run


def topk(vectors: DataFrame, queries: DataFrame, k: int = 5, **kw) -> DataFrame:
    """Exact k nearest vectors per query; see :func:`topk_bounded`."""
    return topk_bounded(vectors, queries, k, **kw)[0]


def topk_bounded(vectors: DataFrame, queries: DataFrame, k: int = 5,
                 namespace: str | None = None, where: Mapping | None = None,
                 vectors_per_block: int = VECTORS_PER_BLOCK,
                 queries_per_block: int = QUERIES_PER_BLOCK,
                 broadcast_max: int = BROADCAST_QUERIES_MAX) -> tuple[DataFrame, int]:
    """Exact k nearest vectors per query by dot product (cosine on unit vectors).

    ``vectors``: ``id, values`` (and ``namespace`` when filtering);
    ``queries``: ``query_id, values``.  Output: ``query_id, id, score, rank``;
    scores are rounded to 6 decimals, ties broken by id.  Also returns the
    proven row bound of the output (queries x k) for :func:`context`.

    A query set of at most ``broadcast_max`` rows (counted first) is
    broadcast and every vector partition is scored where it lies, keeping
    its own top ``k`` per query; vectors are never shuffled.  A larger query
    set is joined block-wise: vectors hashed into ``bv`` blocks, queries into
    ``bq`` blocks, one cogroup per block pair.

    ``where``: a predicate on the metadata (:mod:`quillsync.functions.predicates`), taken
    into the scan of the vectors, below the scoring.
    """
    from quillsync.session import ship_package
    ship_package(vectors.sparkSession)
    v = vectors
    if namespace is not None:
        v = v.where(F.col("namespace") == F.lit(namespace))
    if where is not None:
        v = v.where(predicate(where, vectors.schema, "metadata"))
    # a vector without values has no score, and a query without values no hits
    v = v.where(F.size("values") > 0).select(F.col("id").cast("string").alias("id"), F.col("values"))
    q = queries.where(F.size("values") > 0).select(F.col("query_id").cast("string").alias("query_id"), F.col("values"))
    n_q = q.count()
    if n_q <= broadcast_max:
        import numpy as np
        rows = q.collect()
        qids = [r.query_id for r in rows]
        Qm = (np.vstack([np.asarray(r["values"], dtype=np.float64) for r in rows])
              if rows else np.zeros((0, 0)))
        bq = v.sparkSession.sparkContext.broadcast(Qm)
        scored = v.mapInPandas(_partition_topk(k, qids, bq), TOPK_SCHEMA) if qids else \
            v.sparkSession.createDataFrame([], TOPK_SCHEMA)
    else:
        dim = q.select(F.size("values")).first()[0] or 1
        per_v = max(1, min(vectors_per_block, BLOCK_CELLS // dim))
        per_q = max(1, min(queries_per_block, BLOCK_CELLS // dim))
        n_v = v.count()
        bv = max(1, math.ceil(n_v / per_v))
        bqn = max(1, math.ceil(n_q / per_q))
        vb = (v.withColumn("_vb", F.pmod(F.xxhash64("id"), F.lit(bv)))
              .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(bqn - 1)).cast("array<long>"))))
        qb = (q.withColumn("_qb", F.pmod(F.xxhash64("query_id"), F.lit(bqn)))
              .withColumn("_vb", F.explode(F.sequence(F.lit(0), F.lit(bv - 1)).cast("array<long>"))))
        scored = (vb.groupBy("_vb", "_qb")
                  .cogroup(qb.groupBy("_vb", "_qb"))
                  .applyInPandas(lambda a, b: _block_topk(k)(a, b), TOPK_SCHEMA))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    hits = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return hits, n_q * k


def centroids(vectors: DataFrame, group_col: str, dim: int,
              values_col: str = "values") -> DataFrame:
    """Mean vector per group (``query_id, values``), partial-aggregated per dimension."""
    means = [F.avg(F.col(values_col)[i].cast("double")) for i in range(dim)]
    return (vectors.groupBy(F.col(group_col).cast("string").alias("query_id"))
            .agg(F.array(*means).alias("values")))


def context(hits: DataFrame, chunks: DataFrame, docs: DataFrame,
            hits_max_rows: int | None = None) -> DataFrame:
    """Top-k hits joined back to their chunk text and document title (null where
    a vector has no chunk any more).

    With a proven bound on the hits (``topk_bounded`` returns one) of at most
    ``HITS_BROADCAST_MAX`` rows, every join broadcasts its small side (the
    hits, their document ids, the titles found, each bounded by the hits):
    the chunk and document stores are scanned where they lie, never shuffled
    (the hit documents' ids come from a second, column-pruned chunk scan).
    """
    small = hits_max_rows is not None and hits_max_rows <= HITS_BROADCAST_MAX
    c = chunks.select(F.col("id"), "document_id", "chunk_index",
                      F.col("content").alias("chunk_content"))
    d = docs.select(F.col("id").alias("document_id"), "title")
    cols = ["query_id", "rank", "score", F.col("id").alias("chunk_id"),
            "document_id", "title", "chunk_index", "chunk_content"]
    if not small:
        return hits.join(c, "id", "left").join(d, "document_id", "left").select(*cols)
    # the hit chunks, found by a broadcast semi join, are as few as the hits
    found = c.join(F.broadcast(hits.select("id").distinct()), "id", "left_semi")
    with_text = hits.join(F.broadcast(found), "id", "left")
    # titles of the hit documents only (a broadcast semi join scans the store
    # in place), then a left join whose broadcast build side is that small set
    titles = d.join(F.broadcast(with_text.select("document_id").distinct()), "document_id",
                    "left_semi")
    return with_text.join(F.broadcast(titles), "document_id", "left").select(*cols)


def search(docs: DataFrame, terms, id_col: str = "id",
           text_col: str = "content", ignore_case: bool = False, where: Mapping | None = None) -> DataFrame:
    """Term search: ``(document id, term, hits)`` for every listed term a document holds.

    ``where``: a predicate on the documents' other columns, taken into their scan.

    Documents are tokenised with the token pattern (lower-cased, with the
    terms, when ``ignore_case``); the term list is
    broadcast when its row count is within ``TERMS_BROADCAST_MAX`` (checked),
    otherwise it is a normal join and AQE plans it.
    """
    from quillsync.functions.text import TOKEN_PATTERN
    if where is not None:
        docs = docs.where(predicate(where, docs.schema))
    if not isinstance(terms, DataFrame):
        terms = docs.sparkSession.createDataFrame([(x,) for x in terms], "term string")
    t = terms.select(F.col(terms.columns[0]).cast("string").alias("term"))
    if ignore_case:
        t = t.select(F.lower("term").alias("term"))
    t = t.distinct()
    if t.count() <= TERMS_BROADCAST_MAX:
        t = F.broadcast(t)
    text = F.lower(F.col(text_col)) if ignore_case else F.col(text_col)
    toks = docs.select(F.col(id_col).alias("doc"),
                       F.explode(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)).alias("term"))
    return (toks.join(t, "term", "left_semi")
            .groupBy("doc", "term").agg(F.count(F.lit(1)).alias("hits"))
            .withColumnRenamed("doc", id_col))
