"""Registered queries: one per operator of the inventory, over the driver tables.

Every query takes ``(spark, sf_dir)``, reads whole tables through
:mod:`quillsync.plans.fixtures` and returns a DataFrame whose columns match
the SQL twin in :mod:`quillsync.plans.oracle` (integers as BIGINT, scores
rounded to 6 decimals).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsync.functions.text import (
    docx_name, is_blank, join_paragraphs, paragraphs, sentences, title_of, token_count)
from quillsync.operators import (
    audit, chunking, embed, matching, postings, retrieval, store, vector_blocks, vectors)
from quillsync.plans import fixtures as fx
from quillsync.plans import incremental
from quillsync.plans import sync as pipeline
from quillsync.schemas import DEFAULT_NAMESPACE, DOCUMENTS, conform
from quillsync.session import cut_lineage, scratch_dir
from quillsync.sources import docx, folder, listing, rejects

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOPK = 5
CONTEXT_K = 3
SMALL_MAX, SMALL_OVERLAP = 40, 10     # second packing configuration
FETCH_PER_LABEL = 10
SEARCH_K = 10
QUERY_EVERY = 20                      # similarity queries: rows whose vec_id is divisible by this
VECTOR_FILTER = {"document_id": {"$in": ["label-1", "label-3", "label-8"]},
                 "$or": [{"chunk_index": {"$lt": 200}}, {"chunk_index": {"$gte": 300}}]}
DOCUMENT_FILTER = {"lang": {"$in": ["en", "de"]}, "$not": {"n_chars": {"$gt": 20000}}}


def query(name: str):
    def reg(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return reg


def _long(c: str) -> F.Column:
    return F.col(c).cast("long").alias(c)


def _docs(spark, d):
    return fx.table(spark, d, "documents")


def _doc_rows(spark, d):
    """documents as (id, content) with the numeric id."""
    return _docs(spark, d).select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


# --- scalar functions -------------------------------------------------------

@query("title_from_name")
def q_title_from_name(spark, d):
    return fx.manifest(spark, d).select("file_id", "name", title_of("name").alias("title"))


@query("docx_name")
def q_docx_name(spark, d):
    return fx.manifest(spark, d).select("file_id", docx_name("name").alias("landed_name"))


@query("is_blank")
def q_is_blank(spark, d):
    lines = F.split(F.col("text"), "\n")
    return _docs(spark, d).select(
        "doc_id", is_blank("text").alias("blank"),
        F.size(F.filter(lines, lambda l: is_blank(l))).cast("long").alias("blank_lines"))


@query("split_sentences")
def q_split_sentences(spark, d):
    s = sentences("text")
    return _docs(spark, d).select(
        "doc_id", F.size(s).cast("long").alias("n_sentences"),
        F.md5(F.array_join(s, "\u0002")).alias("sentences_md5"))


@query("count_tokens")
def q_count_tokens(spark, d):
    return _docs(spark, d).select("doc_id", token_count("text").cast("long").alias("n_tokens"))


@query("new_id")
def q_new_id(spark, d):
    return fx.source(spark, d).select("doc_id", matching.document_id(F.col("title")).alias("id"))


# --- listing, selection, filters -------------------------------------------

@query("source_listing")
def q_source_listing(spark, d):
    return listing.list_source(fx.manifest(spark, d)).select("file_id", "name", "mime_type")


@query("select_files")
def q_select_files(spark, d):
    files = listing.list_source(fx.manifest(spark, d))
    return listing.select_files(files, fx.requested_titles(spark, d), all=False).select(
        "file_id", "name")


@query("select_files_raw")
def q_select_files_raw(spark, d):
    """D7, the code's rule: the request list holds file names, compared raw."""
    files = listing.list_source(fx.manifest(spark, d))
    names = fx.requested_titles(spark, d).select(F.concat("title", F.lit(".docx")).alias("n"))
    return listing.select_files(files, names, all=False, match=listing.RAW).select("file_id", "name")


@query("fetch_documents")
def q_fetch_documents(spark, d):
    landed = listing.fetch(fx.manifest(spark, d), fx.requested_titles(spark, d), all=False)
    return landed.select("landed_name", "file_id")


@query("last_write_wins")
def q_last_write_wins(spark, d):
    return listing.land_names(fx.conversation_manifest(spark, d)).select(
        "landed_name", "file_id", _long("position"))


@query("filter_requested")
def q_filter_requested(spark, d):
    landed = listing.fetch(fx.manifest(spark, d), all=True)
    names = fx.requested_titles(spark, d).select(F.concat("title", F.lit(".docx")).alias("n"))
    return listing.filter_requested(landed, names).select("landed_name", "file_id")


@query("filter_blank_documents")
def q_filter_blank_documents(spark, d):
    lines = _docs(spark, d).select(
        "doc_id", F.posexplode(F.split(F.col("text"), "\n")).alias("line_no", "content"))
    return pipeline.drop_blank(lines).select("doc_id", _long("line_no"))


@query("filter_blank_paragraphs")
def q_filter_blank_paragraphs(spark, d):
    p = paragraphs("text")
    return _docs(spark, d).select(
        "doc_id", F.size(p).cast("long").alias("n_paragraphs"),
        F.md5(join_paragraphs(p)).alias("text_md5"))


@query("table_schemas")
def q_table_schemas(spark, d):
    return conform(fx.store(spark, d), DOCUMENTS).select("id", "title", "content")


# --- matching ---------------------------------------------------------------

def _src(spark, d):
    return fx.source(spark, d).select("title", "content")


@query("match_documents")
def q_match_documents(spark, d):
    return matching.match_documents(_src(spark, d), fx.store(spark, d)).select(
        "title", "id", "status")


@query("new_documents")
def q_new_documents(spark, d):
    return matching.new_documents(_src(spark, d), fx.store(spark, d)).select("title")


@query("changed_documents")
def q_changed_documents(spark, d):
    return matching.changed_documents(_src(spark, d), fx.store(spark, d)).select("id", "title")


@query("union_mapped")
def q_union_mapped(spark, d):
    return matching.mapped(_src(spark, d), fx.store(spark, d), fx.run_ts()).select(
        "id", "title", "status")


@query("first_match")
def q_first_match(spark, d):
    return matching.first_match(fx.conversation_store(spark, d)).select("title", "id")


@query("read_document_by_title")
def q_read_document_by_title(spark, d):
    return store.documents_by_titles(fx.store(spark, d), fx.requested_titles(spark, d)).select(
        "title", "id")


@query("read_ids_by_titles")
def q_read_ids_by_titles(spark, d):
    return store.ids_by_titles(fx.store(spark, d), fx.requested_titles(spark, d))


# --- titles under a collation -------------------------------------------------

def _shouted(title):
    """English documents arrive under titles in capitals."""
    return F.when(F.col("lang") == "en", F.upper(title)).otherwise(title)


@query("collated_match")
def q_collated_match(spark, d):
    src = _docs(spark, d).select(_shouted(fx.doc_title()).alias("title"), F.col("text").alias("content"))
    return matching.match_documents(src, fx.store(spark, d), matching.CASELESS).select("title", "id", "status")


@query("collated_first_match")
def q_collated_first_match(spark, d):
    """Turns of a conversation whose titles differ in case are one title."""
    turns = fx.conversation_store(spark, d).withColumn(
        "title", F.when(F.col("id") < "8", F.upper("title")).otherwise(F.col("title")))
    return matching.first_match(turns, matching.CASELESS).select("title", "id")


@query("collated_lookup")
def q_collated_lookup(spark, d):
    asked = fx.requested_titles(spark, d)
    both = asked.unionByName(asked.select(F.upper("title").alias("title")))
    return store.documents_by_titles(fx.store(spark, d), both, matching.CASELESS).select("title", "id")


@query("collated_cleanup")
def q_collated_cleanup(spark, d):
    out = os.path.join(scratch_dir(spark, "cleanup"), uuid.uuid4().hex)
    names = fx.cleanup_names(spark, d).select(F.concat(F.upper(title_of("name")), F.lit(".docx")).alias("name"))
    docs, chunks, vecs, _ = pipeline.cleanup(fx.store(spark, d), fx.chunk_store(spark, d), fx.vector_store(spark, d),
                                             names, out=out, version=1, collation=matching.CASELESS)
    return (docs.select(F.lit("documents").alias("store"), "id")
            .unionByName(chunks.select(F.lit("chunks").alias("store"), "id"))
            .unionByName(vecs.select(F.lit("vectors").alias("store"), "id")))


@query("collated_sync")
def q_collated_sync(spark, d):
    """Every English file is listed twice, the later one in capitals: one document each."""
    man = fx.manifest(spark, d)
    again = man.where(F.col("mime_type") == fx.GDOC_MIME).select(
        F.concat("file_id", F.lit("-again")).alias("file_id"),
        F.concat(F.upper(title_of("name")), F.lit(".docx")).alias("name"), "mime_type",
        (F.col("position") + 1).alias("position"), F.concat("content", F.lit(" Again.")).alias("content"))
    cfg = pipeline.SyncConfig(run_id="run-1", collation=matching.CASELESS)
    docs = pipeline.sync(man.unionByName(again), fx.store(spark, d), fx.chunk_store(spark, d),
                         fx.vector_store(spark, d), all=True, cfg=cfg, run_ts=fx.run_ts()).documents
    return docs.select("id", "title", F.md5("content").alias("content_md5"))


# --- chunking ---------------------------------------------------------------

def _chunk_cols(df):
    return df.select(_long("document_id"), _long("chunk_index"), "content", _long("token_count"))


@query("pack_chunks")
def q_pack_chunks(spark, d):
    r = chunking.chunk_ranges(_doc_rows(spark, d))
    return r.select(_long("document_id"), _long("chunk_index"),
                    _long("first_sentence"), _long("last_sentence"))


@query("make_chunks")
def q_make_chunks(spark, d):
    return _chunk_cols(chunking.make_chunks(_doc_rows(spark, d)))


@query("chunk_index")
def q_chunk_index(spark, d):
    c = chunking.make_chunks(_doc_rows(spark, d), SMALL_MAX, SMALL_OVERLAP)
    return c.select(_long("document_id"), _long("chunk_index"), _long("token_count"))


@query("project_chunk")
def q_project_chunk(spark, d):
    c = chunking.make_chunks(fx.store(spark, d, whole=True).select("id", "content"))
    return c.select("document_id", _long("chunk_index"), "content", _long("token_count"))


@query("chunks_per_document")
def q_chunks_per_document(spark, d):
    return audit.chunks_per_document(fx.chunk_store(spark, d, whole=True)).select(
        "document_id", _long("chunks"))


@query("process_documents")
def q_process_documents(spark, d):
    landed = listing.landed_documents(listing.fetch(fx.manifest(spark, d), all=True))
    _, chunks = pipeline.process(landed, fx.store(spark, d), run_ts=fx.run_ts())
    return chunks.select("document_id", _long("chunk_index"), "content", _long("token_count"))


# --- document and chunk stores ---------------------------------------------

def _new_chunks(spark, d):
    """Chunks of the run's mapped documents (source text)."""
    m = matching.mapped(_src(spark, d), fx.store(spark, d), fx.run_ts())
    return chunking.make_chunks(m.select("id", "content"))


@query("insert_documents")
def q_insert_documents(spark, d):
    st = fx.store(spark, d)
    new = matching.new_documents(_src(spark, d), st)
    return store.insert_documents(st, new, fx.run_ts()).select("id", "title", "content")


@query("insert_chunks")
def q_insert_chunks(spark, d):
    c = store.with_chunk_ids(_new_chunks(spark, d), fx.run_ts())
    return c.select("id", "document_id", _long("chunk_index"), _long("token_count"))


@query("append_mode")
def q_append_mode(spark, d):
    nxt = store.insert_chunks(fx.chunk_store(spark, d), _new_chunks(spark, d),
                              mode=store.APPEND, run_ts=fx.run_ts(), run_id="run-1")
    return nxt.select("id", "document_id", _long("chunk_index"))


@query("replace_mode")
def q_replace_mode(spark, d):
    nxt = store.insert_chunks(fx.chunk_store(spark, d), _new_chunks(spark, d),
                              mode=store.REPLACE, run_ts=fx.run_ts())
    return nxt.select("id", "document_id", _long("chunk_index"))


def _requested_ids(spark, d):
    return store.ids_by_titles(fx.store(spark, d), fx.requested_titles(spark, d))


@query("read_chunks_by_document")
def q_read_chunks_by_document(spark, d):
    c = store.chunks_for(fx.chunk_store(spark, d), _requested_ids(spark, d))
    return c.select("document_id", _long("chunk_index"), "id")


@query("order_chunks")
def q_order_chunks(spark, d):
    w = Window.partitionBy("document_id").orderBy("chunk_index")
    c = fx.chunk_store(spark, d, whole=True).orderBy("document_id", "chunk_index")
    return c.select("document_id", _long("chunk_index"),
                    F.lag("chunk_index").over(w).cast("long").alias("prev_index"))


# --- embeddings and vectors --------------------------------------------------

def _embedded_store(spark, d, whole=True):
    e, _ = embed.embed(fx.chunk_store(spark, d, whole), run_ts=fx.run_ts())
    return e


@query("embed_chunks")
def q_embed_chunks(spark, d):
    e = _embedded_store(spark, d)
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double"))
    return e.select("id", F.size("embedding").cast("long").alias("dims"),
                    F.round(total, 6).alias("value_sum"),
                    F.round(F.array_max("embedding").cast("double"), 6).alias("value_max"))


@query("drop_failed_embeddings")
def q_drop_failed_embeddings(spark, d):
    ok, bad = embed.embed(fx.chunk_store(spark, d, whole=True), run_ts=fx.run_ts(), materialize=True)
    return audit.metric_rows({"embedded": audit.count_of(ok), "failed": audit.count_of(bad)})


@query("embedding_rejects")
def q_embedding_rejects(spark, d):
    """An embedder that fails for one chunk in sixteen."""
    def failing(text):
        return F.when(F.substring(F.md5(text), 1, 1) != "0", embed.hashing_embedder()(text))

    _, bad = embed.embed(fx.chunk_store(spark, d, whole=True), failing, run_ts=fx.run_ts())
    return bad.select("filename", "error")


@query("validate_vectors")
def q_validate_vectors(spark, d):
    valid, bad = vectors.to_vectors(cut_lineage(_embedded_store(spark, d)), run_ts=fx.run_ts())
    return audit.metric_rows({"valid": audit.count_of(valid), "rejected": audit.count_of(bad)})


@query("project_metadata")
def q_project_metadata(spark, d):
    v = fx.vector_store(spark, d, whole=True)
    return v.select("id", F.col("metadata.document_id").alias("document_id"),
                    F.col("metadata.chunk_index").cast("long").alias("chunk_index"),
                    F.col("metadata.token_count").cast("long").alias("token_count"))


def _store_vectors(spark, d, whole=True):
    valid, _ = vectors.to_vectors(_embedded_store(spark, d, whole), run_ts=fx.run_ts())
    return valid


@query("vector_upsert")
def q_vector_upsert(spark, d):
    nxt = vectors.upsert(fx.vector_store(spark, d), _store_vectors(spark, d, whole=False))
    return nxt.select("namespace", "id", F.col("metadata.document_id").alias("document_id"),
                      F.col("metadata.chunk_index").cast("long").alias("chunk_index"))


@query("vector_sync")
def q_vector_sync(spark, d):
    nxt, upserted, bad = vectors.sync_vectors(fx.vector_store(spark, d),
                                              cut_lineage(_embedded_store(spark, d)))
    return audit.metric_rows({"upserted": audit.count_of(upserted),
                              "rejected": audit.count_of(bad),
                              "store_size": audit.count_of(nxt)})


@query("vector_fetch")
def q_vector_fetch(spark, d):
    v = vectors.vectors_for(fx.vector_store(spark, d), _requested_ids(spark, d))
    return v.select("id", F.col("metadata.document_id").alias("document_id"))


@query("limit_vectors")
def q_limit_vectors(spark, d):
    lab = fx.labelled_vectors(spark, d)
    groups = lab.select(F.col("metadata.document_id").alias("g")).distinct()
    v = vectors.vectors_for(lab, groups, limit=FETCH_PER_LABEL, namespace=fx.LABELLED_NS)
    return v.select("id", F.col("metadata.document_id").alias("document_id"))


@query("vector_clear")
def q_vector_clear(spark, d):
    both = fx.vector_store(spark, d).unionByName(fx.labelled_vectors(spark, d))
    return vectors.clear_namespace(both, DEFAULT_NAMESPACE).select("namespace", "id")


# --- cleanup ------------------------------------------------------------------

def _cleanup_ids(spark, d):
    return pipeline.cleanup_ids(fx.store(spark, d), fx.cleanup_names(spark, d))


@query("resolve_cleanup_ids")
def q_resolve_cleanup_ids(spark, d):
    return _cleanup_ids(spark, d)


@query("delete_documents")
def q_delete_documents(spark, d):
    docs, _ = store.delete_documents(fx.store(spark, d), fx.chunk_store(spark, d),
                                     _cleanup_ids(spark, d))
    return docs.select("id")


@query("cascade_delete")
def q_cascade_delete(spark, d):
    _, chunks = store.delete_documents(fx.store(spark, d), fx.chunk_store(spark, d),
                                       _cleanup_ids(spark, d))
    return chunks.select("id", "document_id")


@query("delete_chunks")
def q_delete_chunks(spark, d):
    changed = matching.changed_documents(_src(spark, d), fx.store(spark, d))
    return store.delete_chunks(fx.chunk_store(spark, d),
                               changed.select(F.col("id").alias("document_id"))).select("id")


@query("delete_vectors")
def q_delete_vectors(spark, d):
    ids = _cleanup_ids(spark, d).select(F.col("id").alias("_doc"))
    return vectors.delete_vectors(fx.vector_store(spark, d), ids).select("id")


@query("delete_vectors_namespaced")
def q_delete_vectors_namespaced(spark, d):
    """The same documents in two namespaces; one of them loses vectors."""
    ids = _cleanup_ids(spark, d).select(F.col("id").alias("_doc"))
    v = fx.vector_store(spark, d)
    both = v.unionByName(v.withColumn("namespace", F.lit(fx.SECOND_NS)))
    return vectors.delete_vectors(both, ids, fx.SECOND_NS).select("namespace", "id")


@query("delete_report")
def q_delete_report(spark, d):
    return audit.delete_report(_cleanup_ids(spark, d), fx.store(spark, d),
                               fx.chunk_store(spark, d), fx.vector_store(spark, d))


@query("cleanup")
def q_cleanup(spark, d):
    out = os.path.join(scratch_dir(spark, "cleanup"), uuid.uuid4().hex)
    docs, chunks, vecs, _ = pipeline.cleanup(fx.store(spark, d), fx.chunk_store(spark, d),
                                             fx.vector_store(spark, d), fx.cleanup_names(spark, d),
                                             out=out, version=1)
    return (docs.select(F.lit("documents").alias("store"), "id")
            .unionByName(chunks.select(F.lit("chunks").alias("store"), "id"))
            .unionByName(vecs.select(F.lit("vectors").alias("store"), "id")))


# --- audit ----------------------------------------------------------------------

@query("group_chunks_by_document")
def q_group_chunks_by_document(spark, d):
    g = embed.group_by_document(_embedded_store(spark, d))
    return g.select("document_id", _long("chunks"), _long("first_index"), _long("last_index"),
                    _long("tokens"), _long("index_gaps"))


@query("reconcile_stores")
def q_reconcile_stores(spark, d):
    return audit.reconcile(fx.chunk_store(spark, d), fx.vector_store(spark, d))


def _sync(spark, d, **kw):
    cfg = pipeline.SyncConfig(run_id="run-1")
    return pipeline.sync(fx.manifest(spark, d), fx.store(spark, d), fx.chunk_store(spark, d),
                         fx.vector_store(spark, d), all=True, cfg=cfg, run_ts=fx.run_ts(), **kw)


@query("sync_report")
def q_sync_report(spark, d):
    return _sync(spark, d).report


@query("sync_append")
def q_sync_append(spark, d):
    """D1, the code's behaviour: append mode inserts new documents and leaves
    changed ones with their stored content."""
    cfg = pipeline.SyncConfig(run_id="run-1", mode="append")
    r = pipeline.sync(fx.manifest(spark, d), fx.store(spark, d), fx.chunk_store(spark, d),
                      fx.vector_store(spark, d), all=True, cfg=cfg, run_ts=fx.run_ts())
    return r.documents.select("id", "title", F.md5("content").alias("content_md5"))


@query("sync")
def q_sync(spark, d):
    docs = _sync(spark, d).documents
    return docs.select("id", "title", F.md5("content").alias("content_md5"))


# --- retrieval ------------------------------------------------------------------

def _vector_queries(vecs):
    """Every row whose vec_id is divisible by QUERY_EVERY, as a query on all rows."""
    return vecs.where(F.col("metadata.chunk_index") % QUERY_EVERY == 0).select(F.col("id").alias("query_id"), "values")


@query("similarity_topk")
def q_similarity_topk(spark, d):
    lab = fx.labelled_vectors(spark, d)
    hits = retrieval.topk(lab, _vector_queries(lab), k=TOPK, namespace=fx.LABELLED_NS)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), "score")


@query("pruned_topk")
def q_pruned_topk(spark, d):
    """The same by an index of blocks, of which those that cannot reach the k-th score are skipped."""
    lab = fx.labelled_vectors(spark, d)
    path = os.path.join(scratch_dir(spark, "blocks"), uuid.uuid4().hex)
    hits, _ = vector_blocks.topk(vector_blocks.build(lab, path), _vector_queries(lab), k=TOPK)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), "score")


@query("centroid_topk")
def q_centroid_topk(spark, d):
    lab = fx.labelled_vectors(spark, d)
    queries = retrieval.centroids(lab.withColumn("g", F.col("metadata.document_id")), "g",
                                  embed.EMBED_DIM)
    hits = retrieval.topk(lab, queries, k=TOPK, namespace=fx.LABELLED_NS)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), "score")


@query("retrieve_context")
def q_retrieve_context(spark, d):
    queries = fx.table(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"),
        embed.hashing_embedder()(F.col("text")).alias("values"))
    hits, bound = retrieval.topk_bounded(_store_vectors(spark, d), queries, k=CONTEXT_K,
                                         namespace=DEFAULT_NAMESPACE)
    ctx = retrieval.context(hits, fx.chunk_store(spark, d, whole=True), fx.store(spark, d, whole=True),
                            hits_max_rows=bound)
    return ctx.select("query_id", F.col("rank").cast("long").alias("rank"), "score", "chunk_id",
                      "document_id", "title", _long("chunk_index"))


@query("retrieve_stale_context")
def q_retrieve_stale_context(spark, d):
    """Hits on the vector store before a sync: those on stale vectors stay, without text."""
    queries = fx.table(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"),
        embed.hashing_embedder()(F.col("text")).alias("values"))
    hits, bound = retrieval.topk_bounded(fx.vector_store(spark, d, whole=True), queries, k=CONTEXT_K,
                                         namespace=DEFAULT_NAMESPACE)
    ctx = retrieval.context(hits, fx.chunk_store(spark, d, whole=True), fx.store(spark, d, whole=True),
                            hits_max_rows=bound)
    return ctx.select("query_id", F.col("rank").cast("long").alias("rank"), "chunk_id",
                      F.col("chunk_content").isNull().alias("stale"))


@query("search_documents")
def q_search_documents(spark, d):
    terms = fx.table(spark, d, "benchmark").select(
        F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), 0)).alias("term"))
    hits = retrieval.search(_doc_rows(spark, d), terms)
    return hits.groupBy(F.col("id").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("matched_terms"), F.sum("hits").cast("long").alias("hits"))


@query("filtered_topk")
def q_filtered_topk(spark, d):
    """R1 within a metadata predicate: vectors of some documents and a range of indexes."""
    lab = fx.labelled_vectors(spark, d)
    hits = retrieval.topk(lab, _vector_queries(lab), k=TOPK, namespace=fx.LABELLED_NS, where=VECTOR_FILTER)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), "score")


@query("filtered_search")
def q_filtered_search(spark, d):
    """R3 within a predicate on the documents' columns."""
    terms = fx.table(spark, d, "benchmark").select(F.explode(postings.terms_of("text", False)).alias("term"))
    hits = retrieval.search(_docs(spark, d), terms, id_col="doc_id", text_col="text", where=DOCUMENT_FILTER)
    return hits.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("matched_terms"), F.sum("hits").cast("long").alias("hits"))


def _benchmark_queries(spark, d):
    return fx.table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")


@query("search_ranked")
def q_search_ranked(spark, d):
    """R3 by the inverted index: the best documents for every benchmark text."""
    docs = _doc_rows(spark, d)
    size = postings.corpus_size(docs.select(F.size(postings.terms_of("content")).alias("n_tokens")))
    found = postings.search(postings.postings_of(docs), _benchmark_queries(spark, d), size, k=SEARCH_K)
    return found.select("query_id", _long("rank"), F.col("document_id").cast("long").alias("doc_id"),
                        _long("matched_terms"), F.round("score", 4).alias("score"))


@query("search_phrases")
def q_search_phrases(spark, d):
    """Documents that hold a whole benchmark text, token by token, by the index's positions."""
    found = postings.phrases(postings.postings_of(_doc_rows(spark, d)), _benchmark_queries(spark, d))
    return found.select("query_id", F.col("document_id").cast("long").alias("doc_id"), _long("hits"))


# --- bucketed stores ------------------------------------------------------------------

def _bucketed(spark, d):
    stores = incremental.open_stores(spark, os.path.join(scratch_dir(spark, "stores"), uuid.uuid4().hex),
                                     buckets=16, postings_buckets=32)
    incremental.load(stores, fx.store(spark, d), fx.chunk_store(spark, d), fx.vector_store(spark, d))
    return stores


def _all_rows(stores, version=None):
    """Every store's rows in one frame, vectors with their values."""
    docs = stores.read("documents", version).select(
        F.lit("documents").alias("store"), "id", "title", F.md5("content").alias("content_md5"),
        F.lit(None).cast("string").alias("document_id"), F.lit(None).cast("long").alias("chunk_index"),
        F.lit(None).cast("double").alias("value_sum"))
    chunks = stores.read("chunks", version).select(
        F.lit("chunks").alias("store"), "id", F.lit(None).cast("string").alias("title"),
        F.md5("content").alias("content_md5"), "document_id", _long("chunk_index"),
        F.lit(None).cast("double").alias("value_sum"))
    # every value enters, each weighted by its place
    total = F.aggregate(F.transform("values", lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    vecs = stores.read("vectors", version).select(
        F.lit("vectors").alias("store"), "id", F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("content_md5"), F.col("metadata.document_id").alias("document_id"),
        F.col("metadata.chunk_index").cast("long").alias("chunk_index"), F.round(total, 5).alias("value_sum"))
    return docs.unionByName(chunks).unionByName(vecs)


@query("incremental_sync")
def q_incremental_sync(spark, d):
    """The whole manifest synced into bucketed stores; all rows of the three stores."""
    stores = _bucketed(spark, d)
    incremental.sync(stores, fx.manifest(spark, d), all=True, cfg=pipeline.SyncConfig(run_id="run-1"),
                     run_ts=fx.run_ts())
    return _all_rows(stores)


@query("incremental_requested")
def q_incremental_requested(spark, d):
    """The requested documents only; the others' rows stay as they are."""
    stores = _bucketed(spark, d)
    incremental.sync(stores, fx.manifest(spark, d), fx.requested_titles(spark, d),
                     cfg=pipeline.SyncConfig(run_id="run-1"), run_ts=fx.run_ts())
    return _all_rows(stores)


@query("incremental_cleanup")
def q_incremental_cleanup(spark, d):
    stores = _bucketed(spark, d)
    incremental.cleanup(stores, fx.cleanup_names(spark, d), run="clean")
    return _all_rows(stores)


@query("store_as_of")
def q_store_as_of(spark, d):
    """The first version, read after a cleanup made another."""
    stores = _bucketed(spark, d)
    incremental.cleanup(stores, fx.cleanup_names(spark, d), run="clean")
    return _all_rows(stores, version=0)


@query("incremental_report")
def q_incremental_report(spark, d):
    """The observed counters of a sync and of a cleanup after it."""
    stores = _bucketed(spark, d)
    done = incremental.sync(stores, fx.manifest(spark, d), all=True, cfg=pipeline.SyncConfig(run_id="run-1"),
                            run_ts=fx.run_ts())
    clean = incremental.cleanup(stores, fx.cleanup_names(spark, d), run="clean")
    return done.report.unionByName(clean.report)


# --- sources and sinks ------------------------------------------------------------

@query("docx_extract")
def q_docx_extract(spark, d):
    files = docx.to_docx(fx.manifest(spark, d).where(F.col("mime_type") != fx.HTML_MIME))
    ok, _ = docx.extract_docx(files)
    return ok.select(F.col("name"), F.col("content"))


def _docx_folder(spark, d):
    """The manifest as files of a folder: its documents as Word files, its pages as files that are none."""
    path = os.path.join(scratch_dir(spark, "folder"), uuid.uuid4().hex)
    man = fx.manifest(spark, d)
    page = F.col("mime_type") == fx.HTML_MIME
    folder.write_folder(docx.to_docx(man.where(~page)), path)
    folder.write_folder(man.where(page).select(F.concat("file_id", F.lit(".docx")).alias("name"),
                                               F.encode("content", "UTF-8").alias("content")), path)
    return path


@query("folder_source")
def q_folder_source(spark, d):
    return folder.manifest(folder.read_folder(spark, _docx_folder(spark, d))).select("name", "content", "error")


@query("folder_sync")
def q_folder_sync(spark, d):
    """A folder synced into bucketed stores: every document, and the rejects of files that are no Word files."""
    stores = _bucketed(spark, d)
    done = incremental.sync(stores, folder.manifest(folder.read_folder(spark, _docx_folder(spark, d))), all=True,
                            cfg=pipeline.SyncConfig(run_id="run-1"), run_ts=fx.run_ts())
    docs = stores.read("documents").select("title", F.md5("content").alias("content_md5"),
                                           F.lit(None).cast("string").alias("error"))
    return docs.unionByName(done.rejects.select(F.col("filename").alias("title"),
                                                F.lit(None).cast("string").alias("content_md5"), "error"))


@query("error_sink")
def q_error_sink(spark, d):
    pages = fx.manifest(spark, d).where(F.col("mime_type") == fx.HTML_MIME).select(
        F.concat("file_id", F.lit(".docx")).alias("name"),
        F.encode("content", "UTF-8").alias("content"))
    _, bad = docx.extract_docx(pages, on_error="reject")
    path = os.path.join(scratch_dir(spark, "rejects"), uuid.uuid4().hex)
    rejects.write_rejects(bad, path)
    return rejects.read_rejects(spark, path).select("filename", "error")


# --- streaming --------------------------------------------------------------------

@query("sync_stream")
def q_sync_stream(spark, d):
    """The manifest lands as two batches of files (one file each, if small); an availableNow file
    stream syncs them batch by batch into the stores (initially the fixture stores)."""
    from quillsync.streaming import sync_stream as ss
    base = os.path.join(scratch_dir(spark, "stream"), uuid.uuid4().hex)
    landing, stores, ckpt = (os.path.join(base, x) for x in ("landing", "stores", "checkpoint"))
    man = fx.manifest(spark, d)
    each = ss.land(man.where(F.col("mime_type") != fx.HTML_MIME), landing, files=2)
    ss.init_stores(stores, fx.store(spark, d), fx.chunk_store(spark, d), fx.vector_store(spark, d),
                   buckets=16, postings_buckets=32)
    out = ss.run_available(spark, landing, stores, ckpt, max_files_per_trigger=each,
                           cfg=pipeline.SyncConfig(run_id="stream"))
    return out["chunks"].select("id", "document_id", _long("chunk_index"), _long("token_count"))


def _two_landings(spark, d):
    """The manifest, then a later one: English documents edited, toxic ones deleted by name."""
    first = fx.manifest(spark, d).withColumn("op", F.lit(None).cast("string"))
    edits = first.where(F.col("mime_type") == fx.GDOC_MIME).withColumn("content", F.concat("content", F.lit(" Again.")))
    gone = fx.cleanup_names(spark, d).select(
        F.concat(F.lit("del-"), F.col("name")).alias("file_id"), "name", F.lit(None).cast("string").alias("mime_type"),
        F.lit(None).cast("string").alias("content"), F.lit("delete").alias("op"))
    later = edits.withColumn("position", F.col("position") * 2 + 1) \
        .unionByName(gone.withColumn("position", F.lit(1 << 40)))
    return first, later


@query("stream_match")
def q_stream_match(spark, d):
    """Two landings matched by keyed state, each by a run of its own: the second goes on from the first's checkpoint."""
    from quillsync.streaming import sync_stream as ss
    from quillsync.streaming import title_state
    base = os.path.join(scratch_dir(spark, "stream"), uuid.uuid4().hex)
    landing, out, ckpt = (os.path.join(base, x) for x in ("landing", "out", "checkpoint"))
    for rows in _two_landings(spark, d):
        ss.land(rows, landing, files=4)
        events = title_state.events(spark.readStream.schema(ss.EVENT_FILES).parquet(landing))
        title_state.run_available(events, title_state.known_titles(fx.store(spark, d)), out, ckpt)
    return spark.read.schema(title_state.DECISIONS).parquet(out).select(
        "title", "id", "status", "position", F.md5("content").alias("content_md5"))


@query("sync_stream_keyed")
def q_sync_stream_keyed(spark, d):
    """The same two landings synced into the stores: every document left, with its numbers of chunks and tokens."""
    from quillsync.streaming import sync_stream as ss
    base = os.path.join(scratch_dir(spark, "stream"), uuid.uuid4().hex)
    landing, stores, ckpt = (os.path.join(base, x) for x in ("landing", "stores", "checkpoint"))
    ss.init_stores(stores, fx.store(spark, d), fx.chunk_store(spark, d), fx.vector_store(spark, d),
                   buckets=16, postings_buckets=32)
    for rows in _two_landings(spark, d):
        ss.land(rows, landing, files=4)
        out = ss.run_available(spark, landing, stores, ckpt, keyed=True, cfg=pipeline.SyncConfig(run_id="keyed"))
    chunks = out["chunks"].groupBy(F.col("document_id").alias("id")).agg(
        F.count(F.lit(1)).alias("chunks"), F.sum(F.col("token_count").cast("long")).alias("tokens"))
    return out["documents"].select("id", "title", F.md5("content").alias("content_md5")).join(chunks, "id")
