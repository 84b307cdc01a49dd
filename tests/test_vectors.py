from pyspark.sql import functions as F

from quillsync.operators import embed, vectors

EMB_SCHEMA = "id string, document_id string, chunk_index string, token_count string, embedding array<float>"


def test_validation_splits_valid_and_rejects(spark):
    df = spark.createDataFrame([
        ("a", "d", "0", "5", [0.1, 0.2]),
        (None, "d", "1", "5", [0.1]),         # missing id
        ("", "d", "2", "5", [0.1]),           # empty id
        ("b", "d", "3", "5", None),           # failed embedding
        ("c", "d", "4", "5", []),             # empty embedding
        ("e", "d", "x", "5", [0.3]),          # index not an int
        ("f", "d", "6", None, [0.3]),         # null token count
    ], EMB_SCHEMA)
    valid, rejects = vectors.to_vectors(df)
    v = valid.collect()
    assert [r.id for r in v] == ["a"]
    assert v[0].metadata.asDict() == {"document_id": "d", "chunk_index": 0, "token_count": 5}
    assert v[0].namespace == "__default__"
    errs = sorted(r.error.split("]: ")[1] for r in rejects.collect())
    assert errs == sorted(["no_chunk_id"] * 2 + ["no_embedding"] * 2
                          + ["bad_chunk_index", "bad_token_count"])


def test_missing_token_count_column_means_zero(spark):
    df = spark.createDataFrame([("a", "d", 0, [1.0])],
                               "id string, document_id string, chunk_index int, embedding array<float>")
    valid, rejects = vectors.to_vectors(df)
    assert valid.first().metadata.token_count == 0 and rejects.count() == 0


def _vec(spark, rows):
    return spark.createDataFrame(
        [(ns, i, v, (d, c, 1)) for ns, i, v, d, c in rows],
        "namespace string, id string, values array<float>, "
        "metadata struct<document_id:string,chunk_index:int,token_count:int>")


def test_upsert_replaces_by_key_and_dedupes_batch(spark):
    old = _vec(spark, [("n", "a", [1.0], "d1", 0), ("n", "b", [2.0], "d1", 1), ("m", "a", [9.0], "x", 0)])
    new = _vec(spark, [("n", "a", [5.0], "d2", 3), ("n", "a", [6.0], "d2", 2), ("n", "c", [7.0], "d2", 4)])
    got = {(r.namespace, r.id): r["values"][0] for r in vectors.upsert(old, new).collect()}
    assert got == {("n", "a"): 5.0, ("n", "b"): 2.0, ("m", "a"): 9.0, ("n", "c"): 7.0}


def test_fetch_clear_delete(spark):
    rows = [("__default__", f"v{i:02d}", [1.0], "d1" if i < 15 else "d2", i) for i in range(20)]
    v = _vec(spark, rows + [("other", "z", [1.0], "d1", 0)])
    assert [r.id for r in vectors.vectors_of(v, "d1", limit=3).collect()] == ["v00", "v01", "v02"]
    ids = spark.createDataFrame([("d1",), ("d2",)], "d string")
    got = vectors.vectors_for(v, ids, limit=4).groupBy(F.col("metadata.document_id")).count().collect()
    assert sorted((r[0], r[1]) for r in got) == [("d1", 4), ("d2", 4)]
    assert [r.id for r in vectors.clear_namespace(v).collect()] == ["z"]
    assert vectors.delete_vectors(v, ["d1"]).count() == 6
    assert vectors.delete_vectors(v, ["d1"], "other").count() == 20


def test_hashing_embedder_unit_length_and_deterministic(spark):
    df = spark.createDataFrame([("a", "hello world hello"), ("b", ""), ("c", "x y z")],
                               "id string, content string")
    ok, bad = embed.embed(df.withColumn("document_id", F.lit("d")))
    rows = {r.id: r.embedding for r in ok.collect()}
    assert set(rows) == {"a", "c"} and bad.count() == 1
    for v in rows.values():
        assert len(v) == embed.EMBED_DIM
        assert abs(sum(x * x for x in v) - 1.0) < 1e-5
    import hashlib
    import math
    b = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 64 for t in ["hello", "world", "hello"]]
    counts = [b.count(i) for i in range(64)]
    norm = math.sqrt(sum(c * c for c in counts))
    assert all(abs(x - c / norm) < 1e-6 for x, c in zip(rows["a"], counts))


def test_pandas_embedder_failures_become_rejects(spark):
    def model(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("batch failed")
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([("a", "ok text"), ("b", "boom"), ("c", "fine")],
                               "id string, content string").withColumn("document_id", F.lit("d"))
    ok, bad = embed.embed(df, embedder=embed.pandas_embedder(model, dim=2))
    assert sorted(r.id for r in ok.collect()) == ["a", "c"]
    assert [r.error for r in bad.collect()] == [
        "no_embedding [doc=d | chunk=b]"]


def test_group_by_document(spark):
    df = spark.createDataFrame([("d", 0, 3), ("d", 1, 4), ("d", 3, 1), ("e", 0, 2)],
                               "document_id string, chunk_index int, token_count int")
    got = {r.document_id: (r.chunks, r.first_index, r.last_index, r.tokens, r.index_gaps)
           for r in embed.group_by_document(df).collect()}
    assert got == {"d": (3, 0, 3, 8, 1), "e": (1, 0, 0, 2, 0)}


def test_both_counting_paths_give_the_same_vectors(spark):
    df = spark.createDataFrame([("a", "one two two three, three three! Ünï 42")], "id string, content string")
    fast = df.select(embed.hashing_embedder()(F.col("content"))).first()[0]
    arrays = df.select(embed._hashing_embedder_arrays(64)(F.col("content"))).first()[0]
    assert fast == arrays and len(fast) == 64


def test_upsert_materialized_batch_gives_the_same_store(spark):
    old = _vec(spark, [("n", "a", [1.0], "d1", 0), ("n", "b", [2.0], "d1", 1)])
    new = _vec(spark, [("n", "a", [5.0], "d2", 3), ("n", "c", [7.0], "d2", 4)])
    lazy = sorted((r.id, r["values"][0]) for r in vectors.upsert(old, new).collect())
    mat = sorted((r.id, r["values"][0]) for r in vectors.upsert(old, new, materialize=True).collect())
    assert lazy == mat == [("a", 5.0), ("b", 2.0), ("c", 7.0)]


def test_fetch_has_no_limit_unless_asked(spark):
    v = _vec(spark, [("__default__", f"v{i:05d}", [1.0], "d", i) for i in range(1500)])
    ids = spark.createDataFrame([("d",)], "d string")
    assert vectors.vectors_for(v, ids).count() == vectors.vectors_of(v, "d").count() == 1500


def test_reconcile_goes_by_side_not_by_null_document_ids(spark):
    from quillsync.operators.audit import reconcile
    chunks = spark.createDataFrame([("a", None), ("b", "d"), ("c", "d")], "id string, document_id string")
    v = _vec(spark, [("__default__", "a", [1.0], "d", 0), ("__default__", "b", [1.0], None, 0),
                     ("__default__", "z", [1.0], None, 0)])
    got = {r.id: r.status for r in reconcile(chunks, v).collect()}
    assert got == {"a": "ok", "b": "ok", "c": "missing_vector", "z": "orphan_vector"}


def test_rejects_of_several_lines_come_back_as_written(spark, tmp_path):
    from quillsync.sources.rejects import read_rejects, write_rejects
    rows = [("t", "f", 'line one\nline "two", three'), ("t", "g", "plain")]
    write_rejects(spark.createDataFrame(rows, "timestamp string, filename string, error string"), str(tmp_path / "r"))
    assert sorted(map(tuple, read_rejects(spark, str(tmp_path / "r")).collect())) == sorted(rows)


def test_conform_raises_on_bad_values_and_nulls(spark):
    import pytest
    from quillsync.schemas import DOCUMENTS, conform
    for row in [("i", "t", "not-a-date"), (None, "t", None)]:
        df = spark.createDataFrame([row], "id string, title string, created_at string")
        with pytest.raises(Exception, match="not-a-date|null in column id"):
            conform(df, DOCUMENTS).collect()
