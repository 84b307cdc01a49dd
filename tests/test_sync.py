import datetime as dt
import os

from pyspark.sql import functions as F

from quillsync.operators.audit import reconcile
from quillsync.plans import fixtures as fx
from quillsync.plans import sync as pipeline
from quillsync.schemas import CHUNKS, DOCUMENTS, VECTORS, empty

SF = "/root/testdata/sf0.001"


def TS1():
    return F.lit(dt.datetime(2025, 1, 1))


def TS2():
    return F.lit(dt.datetime(2025, 2, 1))


def _empty_stores(spark):
    return empty(spark, DOCUMENTS), empty(spark, CHUNKS), empty(spark, VECTORS)


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_sync_into_empty_stores_then_again_is_fixed_point(spark):
    manifest = fx.manifest(spark, SF)
    d0, c0, v0 = _empty_stores(spark)
    r1 = pipeline.sync(manifest, d0, c0, v0, all=True, run_ts=TS1())
    docs1, chunks1, vec1 = (r1.documents.cache(), r1.chunks.cache(), r1.vectors.cache())
    n_docs = fx.table(spark, SF, "documents").count()
    assert docs1.count() == n_docs
    assert chunks1.count() == vec1.count() > n_docs
    # reconcile after a sync finds no drift
    assert reconcile(chunks1, vec1).where(F.col("status") != "ok").count() == 0
    # second run in replace mode changes nothing but timestamps
    r2 = pipeline.sync(manifest, docs1, chunks1, vec1, all=True, run_ts=TS2())
    assert _ids(r2.documents) == _ids(docs1)
    assert _ids(r2.chunks) == _ids(chunks1)
    assert _ids(r2.vectors) == _ids(vec1)
    report = {r.metric: r.value for r in r2.report.collect()}
    assert report["documents_same"] == n_docs and report["documents_new"] == 0


def test_append_mode_duplicates_chunks(spark):
    manifest = fx.manifest(spark, SF)
    d0, c0, v0 = _empty_stores(spark)
    cfg = pipeline.SyncConfig(mode="append", run_id="first")
    r1 = pipeline.sync(manifest, d0, c0, v0, all=True, cfg=cfg, run_ts=TS1())
    docs1, chunks1, vec1 = r1.documents.cache(), r1.chunks.cache(), r1.vectors.cache()
    cfg2 = pipeline.SyncConfig(mode="append", run_id="second")
    r2 = pipeline.sync(manifest, docs1, chunks1, vec1, all=True, cfg=cfg2, run_ts=TS2())
    assert r2.chunks.count() == 2 * chunks1.count()
    assert r2.vectors.count() == 2 * vec1.count()
    assert r2.documents.count() == docs1.count()


def test_replace_updates_changed_content(spark):
    manifest = fx.manifest(spark, SF)
    st = fx.store(spark, SF)
    r = pipeline.sync(manifest, st, fx.chunk_store(spark, SF), fx.vector_store(spark, SF),
                      all=True, run_ts=TS1())
    src = fx.source(spark, SF).select("title", F.col("content").alias("src_content"))
    joined = r.documents.join(src, "title")
    assert joined.count() == src.count()
    assert joined.where(F.col("content") != F.col("src_content")).count() == 0
    changed_ids = [x.id for x in r.mapped.where("status = 'changed'").collect()]
    assert changed_ids
    upd = r.documents.where(F.col("id").isin(changed_ids)).select("updated_at").distinct().collect()
    assert [u.updated_at for u in upd] == [dt.datetime(2025, 1, 1)]
    assert reconcile(r.chunks, r.vectors).where(F.col("status") != "ok").count() == 0


def test_selective_sync_and_cleanup_restores_prior_state(spark):
    manifest = fx.manifest(spark, SF)
    d0, c0, v0 = _empty_stores(spark)
    titles = [r.title for r in fx.requested_titles(spark, SF).collect()][:5]
    r = pipeline.sync(manifest, d0, c0, v0, titles=titles, all=False, run_ts=TS1())
    assert sorted(x.title for x in r.documents.collect()) == sorted(titles)
    names = [t + ".docx" for t in titles]
    docs2, chunks2, vec2, report = pipeline.cleanup(r.documents, r.chunks, r.vectors, names)
    assert docs2.count() == chunks2.count() == vec2.count() == 0
    rep = {x.metric: x.value for x in report.collect()}
    assert rep["ids_found"] == 5 and rep["documents_deleted"] == 5


def test_empty_requests_select_nothing(spark):
    manifest = fx.manifest(spark, SF)
    d0, c0, v0 = _empty_stores(spark)
    r = pipeline.sync(manifest, d0, c0, v0, titles=[], all=False, run_ts=TS1())
    assert r.documents.count() == 0 and r.chunks.count() == 0 and r.vectors.count() == 0


def test_sync_writes_snapshots(spark, scratch):
    manifest = fx.manifest(spark, SF)
    d0, c0, v0 = _empty_stores(spark)
    r = pipeline.sync(manifest, d0, c0, v0, all=True, run_ts=TS1(), out=scratch, version=1)
    import os
    for t in ("documents", "chunks", "vectors", "mapped"):
        assert os.path.isdir(os.path.join(scratch, t, "v=1"))
    assert r.vectors.count() == r.chunks.count()
    assert reconcile(r.chunks, r.vectors).where(F.col("status") != "ok").count() == 0


def test_sync_appends_rejects_to_the_error_log(spark, scratch):
    from quillsync.operators import embed
    from quillsync.sources.rejects import read_rejects

    def model(texts):
        return [None if len(t) % 2 else [1.0, 0.0] for t in texts]   # odd lengths fail

    manifest = fx.manifest(spark, SF)
    d0, c0, v0 = _empty_stores(spark)
    cfg = pipeline.SyncConfig(embedder=embed.pandas_embedder(model, dim=2))
    path = os.path.join(scratch, "errors")
    r = pipeline.sync(manifest, d0, c0, v0, all=True, cfg=cfg, run_ts=TS1(), rejects_path=path)
    back = read_rejects(spark, path)
    assert back.count() == r.rejects.count() > 0
    assert r.vectors.count() + back.count() == r.chunks.count()


def test_sync_with_own_splitter_then_written_cleanup(spark, tmp_path):
    manifest = fx.manifest(spark, SF).where("file_id IN ('doc-1', 'doc-2')") \
        .withColumn("content", F.lit("one;two;three"))
    cfg = pipeline.SyncConfig(max_tokens=1, overlap=0, splitter=lambda c: F.split(c, ";"))
    r = pipeline.sync(manifest, *_empty_stores(spark), all=True, cfg=cfg, run_ts=TS1())
    assert sorted(x.content for x in r.chunks.collect()) == sorted(["one", "two", "three"] * 2)
    name = manifest.orderBy("file_id").first().name
    *stores, report = pipeline.cleanup(r.documents, r.chunks, r.vectors, [name],
                                       out=str(tmp_path), version=7)
    assert [df.count() for df in stores] == [1, 3, 3]
    assert all(os.path.isdir(tmp_path / t / "v=7") for t in ("documents", "chunks", "vectors"))
    assert {x.metric: x.value for x in report.collect()}["chunks_deleted"] == 3
    r.unpersist()
