from pyspark.sql import functions as F

from quillsync.operators import audit, chunking, matching, retrieval, vectors
from quillsync.plans import sync as pipeline
from quillsync.schemas import CHUNKS, DOCUMENTS, SOURCE_FILES, VECTORS, empty
from quillsync.sources import listing


def test_null_and_blank_content_give_no_chunks(spark):
    docs = spark.createDataFrame([("a", None), ("b", ""), ("c", " \n\t "), ("d", "Real text.")],
                                 "id string, content string")
    got = [(r.document_id, r.content) for r in chunking.make_chunks(docs).collect()]
    assert got == [("d", "Real text.")]


def test_null_content_in_source_and_store(spark):
    src = spark.createDataFrame([("t1", None), ("t2", "x")], "title string, content string")
    st = spark.createDataFrame([("i1", "t1", None, None, None), ("i2", "t2", None, None, None)],
                               "id string, title string, content string, created_at timestamp, "
                               "updated_at timestamp")
    got = {r.title: r.status for r in matching.match_documents(src, st).collect()}
    assert got == {"t1": "same", "t2": "changed"}


def test_every_operator_accepts_empty_inputs(spark):
    d, c, v = empty(spark, DOCUMENTS), empty(spark, CHUNKS), empty(spark, VECTORS)
    man = empty(spark, SOURCE_FILES)
    r = pipeline.sync(man, d, c, v, all=True)
    assert r.documents.count() == r.chunks.count() == r.vectors.count() == 0
    assert {x.metric: x.value for x in r.report.collect()}["files_listed"] == 0
    d2, c2, v2, rep = pipeline.cleanup(d, c, v, [])
    assert d2.count() == 0 and rep.count() == 4
    assert audit.reconcile(c, v).count() == 0
    q = spark.createDataFrame([], "query_id string, values array<double>")
    assert retrieval.topk(v, q, k=3).count() == 0


def test_duplicate_source_names_land_once(spark):
    files = spark.createDataFrame([
        ("f1", "Report.docx", "x", 1, "old"),
        ("f2", "Report", "x", 5, "new"),
        ("f3", "Report.pdf", "x", 3, "mid"),
    ], "file_id string, name string, mime_type string, position long, content string")
    landed = listing.land_names(files).collect()
    assert [(r.landed_name, r.file_id, r.content) for r in landed] == [("Report.docx", "f2", "new")]


def test_namespaces_are_separate(spark):
    schema = ("namespace string, id string, values array<float>, "
              "metadata struct<document_id:string,chunk_index:int,token_count:int>")
    old = spark.createDataFrame([("a", "x", [1.0], ("d", 0, 1)), ("b", "x", [2.0], ("d", 0, 1))], schema)
    new = spark.createDataFrame([("a", "x", [3.0], ("d", 0, 1))], schema)
    got = {(r.namespace, r["values"][0]) for r in vectors.upsert(old, new).collect()}
    assert got == {("a", 3.0), ("b", 2.0)}
    assert [r.namespace for r in vectors.clear_namespace(old, "a").collect()] == ["b"]
