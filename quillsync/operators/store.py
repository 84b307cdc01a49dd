"""Document and chunk stores as DataFrames: lookups, inserts, deletes, snapshots.

A mutation never rewrites what it reads: it returns the next state of the
table, which :func:`write_snapshot` writes to a new versioned folder.  The
write's job commit is the atomic unit (the reference's single transaction).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsync.functions.text import stable_id
from quillsync.operators.matching import document_id, first_match, title_key
from quillsync.schemas import CHUNKS, DOCUMENTS, conform

REPLACE, APPEND = "replace", "append"

# Python lists above this many entries are not broadcast; they go through a
# normal (AQE-planned) join instead.
BROADCAST_LIST_MAX = 100_000


def keys_frame(spark: SparkSession, values, name: str) -> DataFrame:
    """A one-column DataFrame from a Python list, broadcast-hinted when small."""
    df = spark.createDataFrame([(v,) for v in (values or [])], f"{name} string")
    return F.broadcast(df) if len(values or []) <= BROADCAST_LIST_MAX else df


def keys_of(spark: SparkSession, keys, name: str) -> DataFrame:
    if isinstance(keys, DataFrame):
        return keys.select(F.col(keys.columns[0]).alias(name)) if name not in keys.columns \
            else keys.select(name)
    return keys_frame(spark, list(keys), name)


# --- lookups ---------------------------------------------------------------

def document_by_title(store: DataFrame, title: str, collation: str | None = None) -> DataFrame:
    """First store row with this title (``(created_at, id)`` order), or none."""
    return first_match(store.where(title_key("title", collation) == title_key(F.lit(title), collation)), collation)


def documents_by_titles(store: DataFrame, titles, collation: str | None = None) -> DataFrame:
    """Bulk form of :func:`document_by_title`: every requested title, with its
    first store row's columns (null when the title is unknown).  Under a ``collation`` every
    requested spelling is a row; the title is the requested one."""
    t = keys_of(store.sparkSession, titles, "title").distinct()
    if collation is not None:
        t = t.withColumn("_title", title_key("title", collation))
        held = store.withColumn("_title", title_key("title", collation)).join(t.select("_title"), "_title", "left_semi")
        first = first_match(held.drop("_title"), collation).withColumn("_title", title_key("title", collation))
        return t.join(first.drop("title"), "_title", "left").drop("_title")
    # only rows with a requested title enter the aggregation
    return t.join(first_match(store.join(t, "title", "left_semi")), "title", "left")


def chunks_of(chunks: DataFrame, doc_id: str) -> DataFrame:
    """Chunks of one document ordered by ``chunk_index``."""
    return chunks.where(F.col("document_id") == F.lit(doc_id)).orderBy("chunk_index")


def chunks_for(chunks: DataFrame, doc_ids) -> DataFrame:
    """Chunks of many documents, sorted by ``(document_id, chunk_index)``."""
    ids = keys_of(chunks.sparkSession, doc_ids, "document_id").distinct()
    return (chunks.join(ids, "document_id", "left_semi")
            .orderBy("document_id", "chunk_index"))


def ids_by_titles(store: DataFrame, titles, collation: str | None = None) -> DataFrame:
    """Ids of every store row whose title is listed (all rows, not the first)."""
    t = keys_of(store.sparkSession, titles, "title")
    if collation is not None:
        keyed = store.select("id", title_key("title", collation).alias("_title"))
        return keyed.join(t.select(title_key("title", collation).alias("_title")), "_title", "left_semi").select("id")
    return store.join(t, "title", "left_semi").select("id")


# --- inserts ---------------------------------------------------------------

def insert_documents(store: DataFrame, new: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Next document store: ``store`` plus ``new`` (title, content) with ids and times."""
    ts = run_ts if run_ts is not None else F.current_timestamp()
    rows = new.select(
        (F.col("id") if "id" in new.columns else document_id(F.col("title"))).alias("id"),
        "title", "content", ts.alias("created_at"), ts.alias("updated_at"))
    return conform(store, DOCUMENTS).unionByName(conform(rows, DOCUMENTS))


def chunk_id(document_id_col: Column, chunk_index: Column, content: Column,
             run_id: str | None = None) -> Column:
    """Chunk id from (document, index, content) and, in append mode, the run."""
    parts = [document_id_col, chunk_index, content]
    if run_id is not None:
        parts.append(F.lit(run_id))
    return stable_id(*parts)


def with_chunk_ids(chunks: DataFrame, run_ts: Column | None = None,
                   run_id: str | None = None) -> DataFrame:
    """Chunk rows as stored: id added, missing token count -> 0, creation time."""
    ts = run_ts if run_ts is not None else F.current_timestamp()
    tok = (F.coalesce(F.col("token_count").cast("int"), F.lit(0))
           if "token_count" in chunks.columns else F.lit(0))
    return chunks.select(
        chunk_id(F.col("document_id"), F.col("chunk_index"), F.col("content"), run_id).alias("id"),
        F.col("document_id").cast("string").alias("document_id"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        "content", tok.alias("token_count"), ts.alias("created_at"))


def insert_chunks(store: DataFrame, chunks: DataFrame, mode: str = REPLACE,
                  run_ts: Column | None = None, run_id: str | None = None) -> DataFrame:
    """Next chunk store.

    ``replace``: the documents in ``chunks`` lose their old chunks first, so a
    re-sync is a fixed point.  ``append``: old rows stay and new rows get
    run-specific ids (the reference's behaviour with random ids).
    """
    if mode not in (REPLACE, APPEND):
        raise ValueError(f"mode must be {REPLACE!r} or {APPEND!r}")
    new = with_chunk_ids(chunks, run_ts, run_id if mode == APPEND else None)
    old = conform(store, CHUNKS)
    if mode == REPLACE:
        old = delete_chunks(old, chunks.select("document_id").distinct())
    return old.unionByName(conform(new, CHUNKS))


# --- deletes ---------------------------------------------------------------

def delete_chunks(chunks: DataFrame, ids) -> DataFrame:
    """Chunks whose document is not listed (``ids``: DataFrame or list)."""
    k = keys_of(chunks.sparkSession, ids, "document_id")
    return chunks.join(k, "document_id", "left_anti")


def delete_documents(docs: DataFrame, chunks: DataFrame, ids) -> tuple[DataFrame, DataFrame]:
    """Delete documents by id; their chunks go with them (the cascade)."""
    k = keys_of(docs.sparkSession, ids, "id")
    return docs.join(k, "id", "left_anti"), delete_chunks(chunks, k.select(F.col("id").alias("document_id")))


# --- snapshots -------------------------------------------------------------

def read_snapshot(spark: SparkSession, base: str, table: str, version: int | str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, table, f"v={version}"))


def write_snapshot(df: DataFrame, base: str, table: str, version: int | str) -> DataFrame:
    """Write the next state of ``table`` to ``base/table/v=<version>`` and read it back.

    A version is derived only from earlier versions, so re-running the same
    version (a retried streaming batch) overwrites it with the same rows."""
    path = os.path.join(base, table, f"v={version}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
