"""Odd values: id parts with the separator, control characters in docx, vectors without values."""

from pyspark.sql import functions as F

from quillsync.functions.text import stable_id
from quillsync.operators import retrieval, vectors
from quillsync.sources import docx


def test_id_parts_do_not_run_together(spark):
    rows = [("a", "r1"), ("a|r1", ""), ("a\\", "|r1"), ("a\\|", "r1"), ("a|", "r1"), ("a", "|r1")]
    df = spark.createDataFrame(rows, "x string, y string")
    ids = {r.i for r in df.select(stable_id("x", "y").alias("i")).collect()}
    one = df.limit(1).select(stable_id(F.lit("a|r1")).alias("i")).first().i
    assert len(ids | {one}) == len(rows) + 1


def test_control_characters_do_not_stop_the_reader(spark):
    df = spark.createDataFrame([("a.docx", "one\x0btwo\x00\ttab\nthree ￾ end")], "name string, content string")
    ok, bad = docx.extract_docx(docx.to_docx(df))
    assert [r.content for r in ok.collect()] == ["onetwo\ttab\nthree  end"] and bad.count() == 0


def test_vectors_that_cannot_be_scored(spark):
    rows = [("a", [1.0, 2.0]), ("b", [1.0, None]), ("c", [float("nan"), 1.0]), ("d", [1.0]), ("e", []), ("f", None)]
    df = spark.createDataFrame(rows, "id string, embedding array<double>").select(
        "id", "embedding", F.lit("d").alias("document_id"), F.lit(0).alias("chunk_index"), F.lit(1).alias("token_count"))
    valid, bad = vectors.to_vectors(df, dim=2)
    assert [r.id for r in valid.collect()] == ["a"]
    reasons = {r.error.split("chunk=")[1][0]: r.error.split(": ")[1] for r in bad.collect()}
    assert reasons == {"b": "bad_embedding", "c": "bad_embedding", "d": "bad_dimension", "e": "no_embedding",
                       "f": "no_embedding"}
    store = spark.createDataFrame([("a", [1.0, 2.0]), ("n", None), ("e", [])], "id string, values array<double>")
    asked = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None)], "query_id string, values array<double>")
    assert [(r.query_id, r.id, r.score) for r in retrieval.topk(store, asked, k=3).collect()] == [("q", "a", 1.0)]
