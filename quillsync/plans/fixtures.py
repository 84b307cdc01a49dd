"""Stores derived from the driver tables, so every registered query runs on them.

All derivations are joins and projections over whole tables:

* **manifest** (source listing): every ``documents`` row as a Word file
  ``<source>-<doc_id>.docx`` (native online document when ``lang = 'en'``,
  uploaded Word file otherwise) plus every ``pages`` row as an HTML file named
  after its host.
* **source**: the landed documents, ``title = <source>-<doc_id>``.
* **store** (document store before the run): the documents that ``labels``
  covers, i.e. the ones synced earlier; the ones labelled ``quality = 0``
  were edited since, so the store holds their older text (`` Old.`` appended).
* **requested titles**: the ``quality = 1`` documents; **cleanup names**: the
  ``toxic = 1`` documents' file names.
* **chunk store**: the store's documents packed into chunks.
* **vector store**: vectors of the chunks of the ``toxic = 0`` labelled
  documents computed from their current text, so reconciling it against the
  chunk store finds real drift (chunks without vectors, stale vectors).
* ``whole=True``: the store, its chunks and its vectors of all documents, for the queries on
  stores that stay as they are; only matching, deletes, upserts and reconciling need a partial one.
* **labelled vectors**: ``embeddings`` as vectors in their own namespace.
* **conversation store**: ``conversations`` turns as documents titled
  ``conv-<conv_id>`` (many rows per title, for first-match and landing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsync.operators.chunking import make_chunks, spread
from quillsync.operators.embed import embed
from quillsync.operators.matching import document_id
from quillsync.operators.store import with_chunk_ids
from quillsync.operators.vectors import to_vectors
from quillsync.schemas import DEFAULT_NAMESPACE, DOCX_MIME, GDOC_MIME

# Fixed values of the derivation (shared with the SQL oracle).
EPOCH_2024 = 1704067200          # store rows were created from 2024-01-01 on
RUN_TS = "2025-01-01 00:00:00"   # the run's timestamp
OLD_SUFFIX = " Old."             # text the edited documents had before
LABELLED_NS = "labelled"
SECOND_NS = "second"
HTML_MIME = "text/html"


# The text tables are read spread over the cores: each driver file holds one
# row group, which would otherwise be a single task of CPU-heavy text work.
TEXT_TABLES = ("documents", "pages")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def run_ts() -> F.Column:
    return F.lit(RUN_TS).cast("timestamp")


def doc_title() -> F.Column:
    return F.concat(F.col("source"), F.lit("-"), F.col("doc_id").cast("string"))


def manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("file_id"),
        F.concat(doc_title(), F.lit(".docx")).alias("name"),
        F.when(F.col("lang") == "en", F.lit(GDOC_MIME)).otherwise(F.lit(DOCX_MIME)).alias("mime_type"),
        F.col("doc_id").alias("position"),
        F.col("text").alias("content"))
    pages = table(spark, d, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("file_id"),
        F.regexp_extract(F.col("url"), r"^[a-z]+://([^/?#]+)", 1).alias("name"),
        F.lit(HTML_MIME).alias("mime_type"),
        F.col("page_id").alias("position"),
        F.col("html").alias("content"))
    return docs.unionByName(pages)


def source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        doc_title().alias("title"), F.col("text").alias("content"), "doc_id")


def _labelled(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left" if whole else "inner")


def store(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    ts = F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("doc_id"))
    return _labelled(spark, d, whole).select(
        document_id(doc_title()).alias("id"),
        doc_title().alias("title"),
        F.when(F.col("quality") == 0, F.concat(F.col("text"), F.lit(OLD_SUFFIX)))
        .otherwise(F.col("text")).alias("content"),
        ts.alias("created_at"), ts.alias("updated_at"))


def requested_titles(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).where(F.col("quality") == 1).select(doc_title().alias("title"))


def cleanup_names(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).where(F.col("toxic") == 1).select(
        F.concat(doc_title(), F.lit(".docx")).alias("name"))


def chunk_store(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    return with_chunk_ids(make_chunks(store(spark, d, whole).select("id", "content")), run_ts())


def vector_store(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    docs = _labelled(spark, d, whole)
    current = (docs if whole else docs.where(F.col("toxic") == 0)).select(
        document_id(doc_title()).alias("id"), F.col("text").alias("content"))
    chunks = with_chunk_ids(make_chunks(current), run_ts())
    embedded, _ = embed(chunks)
    vectors, _ = to_vectors(embedded, DEFAULT_NAMESPACE, run_ts())
    return vectors


def labelled_vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.lit(LABELLED_NS).alias("namespace"),
        F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("id"),
        F.col("embedding").cast("array<float>").alias("values"),
        F.struct(F.concat(F.lit("label-"), F.col("label").cast("string")).alias("document_id"),
                 F.col("vec_id").cast("int").alias("chunk_index"),
                 F.size("embedding").alias("token_count")).alias("metadata"))


def conversation_store(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"))
    # two turns share a creation time, so the id settles the first match
    ts = F.timestamp_seconds(F.lit(EPOCH_2024) + F.floor(F.col("turn") / 2) * 60)
    return table(spark, d, "conversations").select(
        document_id(F.concat(t, F.lit("#"), F.col("turn").cast("string"))).alias("id"),
        t.alias("title"), F.col("text").alias("content"),
        ts.alias("created_at"), ts.alias("updated_at"))


def conversation_manifest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select(
        F.concat(F.lit("turn-"), F.col("conv_id").cast("string"), F.lit("-"),
                 F.col("turn").cast("string")).alias("file_id"),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit(".docx")).alias("name"),
        F.lit(DOCX_MIME).alias("mime_type"),
        F.col("turn").alias("position"),
        F.col("text").alias("content"))
