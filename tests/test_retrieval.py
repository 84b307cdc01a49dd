import numpy as np
from pyspark.sql import functions as F

from quillsync.operators import retrieval


def _brute(V, ids, Q, qids, k):
    out = {}
    S = np.round(Q @ V.T, 6)
    for qi, q in enumerate(qids):
        order = sorted(range(len(ids)), key=lambda j: (-S[qi, j], ids[j]))[:k]
        out[q] = [(ids[j], S[qi, j]) for j in order]
    return out


def test_topk_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(7)
    V = rng.normal(size=(300, 8))
    V = (V / np.linalg.norm(V, axis=1, keepdims=True)).astype(np.float32)
    V[10] = V[11]  # exact tie, settled by id
    Q = rng.normal(size=(13, 8))
    ids = [f"v{i:03d}" for i in range(300)]
    qids = [f"q{i}" for i in range(13)]
    vdf = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, V)], "id string, values array<float>")
    qdf = spark.createDataFrame([(q, v.tolist()) for q, v in zip(qids, Q)],
                                "query_id string, values array<double>")
    hits = retrieval.topk(vdf, qdf, k=4, vectors_per_block=37, queries_per_block=5).collect()
    got = {}
    for r in sorted(hits, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.id, r.score))
    want = _brute(V.astype(np.float64), ids, Q, qids, 4)
    assert got == want
    # tie test: a query equal to v010 ranks v010 before v011
    tq = spark.createDataFrame([("t", V[10].astype(float).tolist())], "query_id string, values array<double>")
    top2 = [r.id for r in retrieval.topk(vdf, tq, k=2).orderBy("rank").collect()]
    assert top2 == ["v010", "v011"]


def test_centroids(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [5.0, 5.0])],
                               "g string, values array<float>")
    got = {r.query_id: r["values"] for r in retrieval.centroids(df, "g", 2).collect()}
    assert got == {"a": [2.0, 3.0], "b": [5.0, 5.0]}


def test_context_and_search(spark):
    hits = spark.createDataFrame([("q", "c1", 0.9, 1)], "query_id string, id string, score double, rank int")
    chunks = spark.createDataFrame([("c1", "d1", 0, "text one")],
                                   "id string, document_id string, chunk_index int, content string")
    docs = spark.createDataFrame([("d1", "Title")], "id string, title string")
    r = retrieval.context(hits, chunks, docs).first()
    assert (r.chunk_id, r.title, r.chunk_content) == ("c1", "Title", "text one")
    d = spark.createDataFrame([("x", "apple pie, apple tart"), ("y", "pear")], "id string, content string")
    terms = spark.createDataFrame([("apple",), ("pear",), ("plum",)], "t string")
    got = sorted((r.id, r.term, r.hits) for r in retrieval.search(d, terms).collect())
    assert got == [("x", "apple", 2), ("y", "pear", 1)]


def test_search_accepts_a_term_list(spark):
    d = spark.createDataFrame([("x", "Apple, apple!")], "id string, content string")
    got = sorted((r.term, r.hits) for r in retrieval.search(d, ["Apple", "apple", "!"]).collect())
    assert got == [("!", 1), ("Apple", 1), ("apple", 1)]


def test_search_ignore_case(spark):
    d = spark.createDataFrame([("x", "Apple, apple!")], "id string, content string")
    got = sorted((r.term, r.hits) for r in retrieval.search(d, ["APPLE"], ignore_case=True).collect())
    assert got == [("apple", 2)]


def test_sliced_scoring_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    V = np.round(rng.normal(size=(97, 5)), 1)   # coarse values: many exact ties
    Q = np.round(rng.normal(size=(6, 5)), 1)
    ids = np.array([f"v{i:03d}" for i in range(97)], dtype=object)
    monkeypatch.setattr(retrieval, "MAX_SCORE_CELLS", 30)   # 5 vectors per slice
    best = [[] for _ in range(6)]
    retrieval._score_into(best, Q, V, ids, 4)
    want = _brute(V, list(ids), Q, list(range(6)), 4)
    assert [[(i, s) for s, i in b] for b in best] == [want[q] for q in range(6)]


def test_context_broadcasts_bounded_hits(spark):
    hits = spark.createDataFrame([("q", "c1", 0.9, 1), ("q", "c9", 0.5, 2)],
                                 "query_id string, id string, score double, rank int")
    chunks = spark.range(50).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("d"), (F.col("id") % 2 + 1).cast("string")).alias("document_id"),
        F.col("id").cast("int").alias("chunk_index"), F.lit("text").alias("content"))
    docs = spark.createDataFrame([("d1", "Title"), ("d2", "Other")], "id string, title string")
    df = retrieval.context(hits, chunks, docs, hits_max_rows=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # hits -> chunks (twice: once pruned to the ids), semi join for titles, left join
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 6
    got = sorted((r.chunk_id, r.title, r.rank) for r in df.collect())
    assert got == [("c1", "Other", 1), ("c9", "Other", 2)]
    unbounded = sorted((r.chunk_id, r.title, r.rank) for r in retrieval.context(hits, chunks, docs).collect())
    assert unbounded == got


def test_cogroup_blocks_sized_by_value_budget(spark, monkeypatch):
    rng = np.random.default_rng(11)
    V = rng.normal(size=(120, 8)).astype(np.float32)
    Q = rng.normal(size=(9, 8))
    ids = [f"v{i:03d}" for i in range(120)]
    vdf = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, V)], "id string, values array<float>")
    qdf = spark.createDataFrame([(f"q{i}", q.tolist()) for i, q in enumerate(Q)],
                                "query_id string, values array<double>")
    monkeypatch.setattr(retrieval, "BLOCK_CELLS", 8 * 25)   # 25 vectors / queries per block
    hits = retrieval.topk(vdf, qdf, k=3, broadcast_max=0).collect()
    got = {}
    for r in sorted(hits, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.id, r.score))
    assert got == _brute(V.astype(np.float64), ids, Q, [f"q{i}" for i in range(9)], 3)
