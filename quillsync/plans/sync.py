"""End-to-end pipelines: process, sync, cleanup.

``sync`` is one lazy plan per store; when ``out`` is given, every store's
next state is written as a snapshot in the order documents -> chunks ->
vectors (so chunks always exist before their vectors), and later stages
read the written tables instead of recomputing the plan.  Without ``out``,
the two intermediates every output shares (the mapped documents and the
embedded chunks) are persisted (memory and disk) until ``unpersist()``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.functions.text import is_blank, title_of
from quillsync.operators.audit import delete_report, sync_report
from quillsync.operators.chunking import MAX_TOKENS, OVERLAP_TOKENS, make_chunks
from quillsync.operators.embed import compute_once, hashing_embedder, split_embedded
from quillsync.operators.matching import NEW, SAME, mapped
from quillsync.operators.store import (APPEND, REPLACE, keys_of, delete_chunks, delete_documents,
                                       ids_by_titles, with_chunk_ids, write_snapshot)
from quillsync.operators.vectors import delete_vectors, to_vectors, upsert
from quillsync.schemas import CHUNKS, DEFAULT_NAMESPACE, DOCUMENTS, conform
from quillsync.session import cut_lineage
from quillsync.sources.listing import TITLE, fetch, landed_documents, list_source
from quillsync.sources.rejects import write_rejects


@dataclass
class SyncConfig:
    max_tokens: int = MAX_TOKENS
    overlap: int = OVERLAP_TOKENS
    mode: str = REPLACE
    skip_unchanged: bool = False
    namespace: str = DEFAULT_NAMESPACE
    match: str = TITLE
    collation: str | None = None
    embedder: Callable[[Column], Column] | None = None
    splitter: Callable[[Column], Column] | None = None
    counter: Callable[[Column], Column] | None = None
    sentence_counter: Callable[[Column], Column] | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def chunks(self, docs: DataFrame) -> DataFrame:
        """Chunks of ``docs`` (id, content) under these limits and plug-ins."""
        return make_chunks(docs.select("id", "content"), self.max_tokens, self.overlap,
                           splitter=self.splitter, counter=self.counter,
                           sentence_counter=self.sentence_counter)


@dataclass
class SyncResult:
    documents: DataFrame
    chunks: DataFrame
    vectors: DataFrame
    rejects: DataFrame
    report: DataFrame
    mapped: DataFrame
    persisted: list = field(default_factory=list)

    def unpersist(self) -> None:
        """Release the run's persisted intermediates (lazy mode)."""
        for df in self.persisted:
            df.unpersist()


def drop_blank(docs: DataFrame, col: str = "content") -> DataFrame:
    return docs.where(~is_blank(F.col(col)))


def process(src: DataFrame, store: DataFrame, cfg: SyncConfig | None = None,
            run_ts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Source documents (title, content) + store -> (mapped documents, chunks)."""
    cfg = cfg or SyncConfig()
    m = mapped(drop_blank(src), store, run_ts, cfg.skip_unchanged, cfg.collation)
    return m, cfg.chunks(m)


def next_documents(store: DataFrame, m: DataFrame, mode: str,
                   run_ts: Column | None = None) -> DataFrame:
    """Document store after a run: new rows inserted; in ``replace`` mode the
    changed rows also get the new content and ``updated_at``.

    An anti join on the touched ids plus a union: the ids of a small run are
    broadcast and the store is scanned in place.  ``m`` (``mapped``) is read
    twice, so callers hold it written or persisted."""
    ts = run_ts if run_ts is not None else F.current_timestamp()
    touched = m.where(F.col("status") == NEW) if mode == APPEND else \
        m.where(F.col("status") != SAME)
    rows = touched.select(
        "id", "title", "content",
        F.when(F.col("status") == NEW, ts).otherwise(F.col("created_at")).alias("created_at"),
        ts.alias("updated_at"))
    kept = conform(store, DOCUMENTS).join(touched.select("id"), "id", "left_anti")
    return kept.unionByName(conform(rows, DOCUMENTS))


def sync(manifest: DataFrame, docs: DataFrame, chunks: DataFrame, vectors: DataFrame,
         titles=None, all: bool = False, cfg: SyncConfig | None = None,
         run_ts: Column | None = None, out: str | None = None,
         version: str | int | None = None, rejects_path: str | None = None) -> SyncResult:
    """Full sync: list -> select -> land -> match -> insert -> chunk -> embed -> upsert.

    ``rejects_path``: append the run's rejects (failed embeddings, invalid
    vectors) to that CSV folder once the vectors are written.
    """
    cfg = cfg or SyncConfig()
    # one time for the whole run: current_timestamp() would differ from job to job
    ts = run_ts if run_ts is not None else F.lit(manifest.sparkSession.range(1).select(
        F.current_timestamp()).first()[0])
    listed = list_source(manifest)
    landed = fetch(manifest, titles, all, cfg.match, cfg.collation)
    src = landed_documents(landed)
    m, new_chunks = process(src, docs, cfg, ts)
    ver = version if version is not None else cfg.run_id
    persisted = []
    if not out:
        # the mapped set feeds the document store, the chunking, the deletes
        # and the report: keep it instead of re-running landing + match for
        # each (recomputed from lineage if an executor is lost)
        m = m.persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(m)
        new_chunks = cfg.chunks(m)

    if out:
        # the mapped set first: the document store and the chunks read it
        m = write_snapshot(m, out, "mapped", ver)
        new_chunks = cfg.chunks(m)
    next_docs = next_documents(docs, m, cfg.mode, ts)
    if out:
        next_docs = write_snapshot(next_docs, out, "documents", ver)

    stored = with_chunk_ids(new_chunks, ts, cfg.run_id if cfg.mode == APPEND else None)
    old_chunks = conform(chunks, CHUNKS)
    touched = m.select(F.col("id").alias("document_id"))
    if cfg.mode == REPLACE:
        old_chunks = delete_chunks(old_chunks, touched)
    next_chunks = old_chunks.unionByName(conform(stored, CHUNKS))
    if out:
        next_chunks = write_snapshot(next_chunks, out, "chunks", ver)
        stored = next_chunks.join(touched, "document_id", "left_semi") \
            if cfg.mode == REPLACE else stored

    emb_all = compute_once(stored, "embedding", (cfg.embedder or hashing_embedder())(F.col("content")))
    if out:
        # one embedding pass, written once: vectors, rejects and report read it
        emb_all = write_snapshot(emb_all, out, "embedded", ver)
    else:
        emb_all = emb_all.persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(emb_all)
    embedded, emb_rejects = split_embedded(emb_all, ts)
    valid, vec_rejects = to_vectors(embedded, cfg.namespace, ts)
    base_vectors = vectors
    if cfg.mode == REPLACE:
        base_vectors = delete_vectors(vectors, touched, cfg.namespace)
    next_vectors = upsert(base_vectors, valid)
    if out:
        next_vectors = write_snapshot(next_vectors, out, "vectors", ver)

    rejects = emb_rejects.unionByName(vec_rejects)
    if rejects_path:
        write_rejects(rejects, rejects_path)
    report = sync_report(listed, landed, m, emb_all)
    return SyncResult(next_docs, next_chunks, next_vectors, rejects, report, m, persisted)


def cleanup_ids(store: DataFrame, names, collation: str | None = None) -> DataFrame:
    """File names -> titles -> ids of every store row with such a title."""
    n = keys_of(store.sparkSession, names, "name")
    return ids_by_titles(store, n.select(title_of(F.col("name")).alias("title")), collation)


def cleanup(docs: DataFrame, chunks: DataFrame, vectors: DataFrame, names,
            namespace: str = DEFAULT_NAMESPACE, out: str | None = None,
            version: str | int | None = None, collation: str | None = None
            ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Delete the named documents, their chunks (cascade) and their vectors in ``namespace``.

    Returns the three next states and the delete report.  The ids are resolved
    once, into a reliable checkpoint.  With ``out`` and ``version`` the states
    are written as snapshots in the order documents -> chunks -> vectors and
    read back.
    """
    if out and version is None:
        raise ValueError("a written cleanup needs a version")
    ids = cut_lineage(cleanup_ids(docs, names, collation))
    report = delete_report(ids, docs, chunks, vectors, namespace)
    docs2, chunks2 = delete_documents(docs, chunks, ids)
    vectors2 = delete_vectors(vectors, ids.select(F.col("id").alias("_doc")), namespace)
    if out:
        docs2, chunks2, vectors2 = (
            write_snapshot(df, out, table, version) for df, table in
            ((docs2, "documents"), (chunks2, "chunks"), (vectors2, "vectors")))
    return docs2, chunks2, vectors2, report
