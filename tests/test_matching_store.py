import datetime as dt

from pyspark.sql import functions as F

from quillsync.operators import matching, store

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
DOC_SCHEMA = "id string, title string, content string, created_at timestamp, updated_at timestamp"


def _store(spark):
    return spark.createDataFrame([
        ("i3", "dup", "late", T1, T1),
        ("i2", "dup", "early-b", T0, T0),
        ("i1", "dup", "early-a", T0, T0),
        ("i0", "dup", "no-time", None, None),
        ("k1", "keep", "same text", T0, T0),
        ("c1", "chg", "old text", T0, T0),
    ], DOC_SCHEMA)


def test_first_match_orders_by_created_then_id_nulls_last(spark):
    got = {r.title: r.id for r in matching.first_match(_store(spark)).collect()}
    assert got == {"dup": "i1", "keep": "k1", "chg": "c1"}


def test_match_statuses_and_mapped(spark):
    src = spark.createDataFrame(
        [("dup", "x"), ("keep", "same text"), ("chg", "new text"), ("fresh", "hello")],
        "title string, content string")
    m = {r.title: (r.id, r.status) for r in matching.match_documents(src, _store(spark)).collect()}
    assert m == {"dup": ("i1", "changed"), "keep": ("k1", "same"), "chg": ("c1", "changed"),
                 "fresh": (None, "new")}
    new = [r.title for r in matching.new_documents(src, _store(spark)).collect()]
    assert new == ["fresh"]
    mapped = {r.title: r for r in matching.mapped(src, _store(spark)).collect()}
    ids = {r.title: r.id for r in matching.mapped(src, _store(spark)).collect()}
    fresh_id = spark.range(1).select(matching.document_id(F.lit("fresh"))).first()[0]
    assert ids["fresh"] == fresh_id and ids["keep"] == "k1"
    assert mapped["chg"].content == "new text"
    skipped = {r.title for r in matching.mapped(src, _store(spark), skip_unchanged=True).collect()}
    assert skipped == {"dup", "chg", "fresh"}


def test_lookups(spark):
    st = _store(spark)
    assert [r.id for r in store.document_by_title(st, "dup").collect()] == ["i1"]
    assert store.document_by_title(st, "nope").count() == 0
    assert sorted(r.id for r in store.ids_by_titles(st, ["dup", "nope"]).collect()) == ["i0", "i1", "i2", "i3"]
    assert store.ids_by_titles(st, []).count() == 0
    got = {r.title: r.id for r in store.documents_by_titles(st, ["dup", "nope"]).collect()}
    assert got == {"dup": "i1", "nope": None}


def test_insert_and_delete_documents_cascade(spark):
    st = _store(spark)
    chunks = spark.createDataFrame(
        [("c-a", "k1", 0, "x", 1), ("c-b", "c1", 0, "y", 1), ("c-c", "c1", 1, "z", 1)],
        "id string, document_id string, chunk_index int, content string, token_count int")
    new = spark.createDataFrame([("fresh", "hello")], "title string, content string")
    nxt = store.insert_documents(st, new, F.lit(T1))
    assert nxt.count() == 7 and nxt.where("title = 'fresh'").first().created_at == T1
    docs2, chunks2 = store.delete_documents(nxt, chunks, ["c1"])
    assert docs2.where("id = 'c1'").count() == 0 and docs2.count() == 6
    assert sorted(r.id for r in chunks2.collect()) == ["c-a"]


def test_insert_chunks_modes(spark):
    old = store.with_chunk_ids(spark.createDataFrame(
        [("d1", 0, "a"), ("d2", 0, "b")], "document_id string, chunk_index int, content string"))
    new = spark.createDataFrame([("d1", 0, "a2", None), ("d1", 1, "a3", 2)],
                                "document_id string, chunk_index int, content string, token_count int")
    rep = store.insert_chunks(old, new, mode="replace")
    assert sorted((r.document_id, r.content, r.token_count) for r in rep.collect()) == [
        ("d1", "a2", 0), ("d1", "a3", 2), ("d2", "b", 0)]
    # replace is a fixed point
    again = store.insert_chunks(rep, new, mode="replace")
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in rep.collect())
    app = store.insert_chunks(rep, new, mode="append", run_id="r2")
    assert app.count() == 5 and app.select("id").distinct().count() == 5


def test_chunks_of_ordered(spark):
    chunks = spark.createDataFrame([("x", "d", 2), ("y", "d", 0), ("z", "d", 1), ("w", "e", 0)],
                                   "id string, document_id string, chunk_index int")
    assert [r.chunk_index for r in store.chunks_of(chunks, "d").collect()] == [0, 1, 2]
    assert [r.id for r in store.chunks_for(chunks, ["e", "d"]).collect()] == ["y", "z", "x", "w"]
