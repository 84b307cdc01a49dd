"""Top-k over blocks equals the full scan, and skips what it can."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsync.operators import retrieval, vector_blocks
from quillsync.plans import fixtures as fx
from quillsync.schemas import VECTORS

SF = "/root/testdata/sf0.001"


def clustered(spark, n=3000, dim=12, groups=20):
    rng = np.random.default_rng(1)
    centres = 3 * rng.normal(size=(groups, dim))
    g = rng.integers(0, groups, n)
    x = centres[g] + 0.2 * rng.normal(size=(n, dim))
    return spark.createDataFrame(
        [("n", f"v{i}", [float(c) for c in v], (f"d{k}", i, 1)) for i, (v, k) in enumerate(zip(x, g))], VECTORS)


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in df.collect())


def queries_of(v):
    return v.where(F.col("metadata.chunk_index") % 20 == 0).select(F.col("id").alias("query_id"), "values")


def test_equals_the_full_scan_and_skips_blocks(spark, scratch, monkeypatch):
    v = clustered(spark)
    index = vector_blocks.build(v, scratch, blocks=20)
    hits, seen = vector_blocks.topk(index, queries_of(v), k=5)
    want = rows_of(retrieval.topk(v, queries_of(v), k=5))
    assert rows_of(hits) == want and len(want) == 150 * 5
    assert seen["pairs"] == 150 * 3000 and seen["skipped"] > 0.7
    again = vector_blocks.open_index(spark, scratch)
    monkeypatch.setattr(vector_blocks, "QUERIES_MAX", 40)
    assert rows_of(vector_blocks.topk(again, queries_of(v), k=5)[0]) == want


def test_unclustered_vectors(spark, scratch):
    v = fx.labelled_vectors(spark, SF)
    index = vector_blocks.build(v, scratch, blocks=8)
    hits, seen = vector_blocks.topk(index, queries_of(v), k=7)
    assert rows_of(hits) == rows_of(retrieval.topk(v, queries_of(v), k=7)) and 0 <= seen["skipped"] < 1


def test_predicate_and_partitions(spark, scratch):
    v = clustered(spark, n=600)
    index = vector_blocks.build(v, scratch, blocks=10)
    spec = {"document_id": {"$in": ["d1", "d2"]}, "chunk_index": {"$gte": 100}}
    hits, _ = vector_blocks.topk(index, queries_of(v), k=4, where=spec)
    assert rows_of(hits) == rows_of(retrieval.topk(v, queries_of(v), k=4, where=spec))
    one, seen = vector_blocks.topk(index, queries_of(v).limit(1), k=2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*block#\d+ (IN \(|INSET|=)", plan)
    assert "Exchange hashpartitioning(block" not in plan and one.count() == 2 and seen["skipped"] > 0


def test_few_rows_ties_and_nulls(spark, scratch):
    rows = [("n", f"v{i}", None if i == 3 else [1.0, 0.0], ("d", i, 1)) for i in range(6)]
    v = spark.createDataFrame(rows, VECTORS)
    index = vector_blocks.build(v, scratch + "/a", blocks=4)
    q = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None)], "query_id string, values array<double>")
    hits, _ = vector_blocks.topk(index, q, k=10)
    assert [(r.query_id, r.id) for r in hits.orderBy("rank").collect()] == [("q", f"v{i}") for i in (0, 1, 2, 4, 5)]
    nothing = vector_blocks.build(v.limit(0), scratch + "/b")
    assert vector_blocks.topk(nothing, q)[0].collect() == []
    with pytest.raises(ValueError):
        vector_blocks.build(v, scratch + "/c", blocks=0)
