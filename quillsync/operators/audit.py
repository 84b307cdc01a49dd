"""Reports and store reconciliation.

Reports are long-format ``(metric, value)`` frames built from one-pass
aggregations, so they stay distributed until the last (tiny) result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsync.schemas import DEFAULT_NAMESPACE

OK, MISSING_VECTOR, ORPHAN_VECTOR = "ok", "missing_vector", "orphan_vector"


def chunks_per_document(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunks"))


def reconcile(chunks: DataFrame, vectors: DataFrame,
              namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Chunk store vs vector store by id: ``ok``, ``missing_vector`` (a chunk
    without vector, e.g. a failed embedding) or ``orphan_vector`` (a vector
    without chunk, e.g. a failed vector delete)."""
    c = chunks.select(F.col("id"), F.col("document_id").alias("chunk_document_id"),
                      F.lit(True).alias("_chunk"))
    v = (vectors.where(F.col("namespace") == F.lit(namespace))
         .select("id", F.col("metadata.document_id").alias("vector_document_id"),
                 F.lit(True).alias("_vector")))
    j = c.join(v, "id", "full_outer")
    # by a mark of each side: a document_id may be null on either
    status = (F.when(F.col("_chunk").isNull(), F.lit(ORPHAN_VECTOR))
              .when(F.col("_vector").isNull(), F.lit(MISSING_VECTOR))
              .otherwise(F.lit(OK)))
    return j.select("id", F.coalesce("chunk_document_id", "vector_document_id").alias("document_id"),
                    status.alias("status"))


def metric_rows(named: dict[str, DataFrame]) -> DataFrame:
    """``{metric: one-row one-column frame}`` -> ``(metric, value)`` rows."""
    frames = [df.select(F.lit(name).alias("metric"),
                        F.col(df.columns[0]).cast("long").alias("value"))
              for name, df in named.items()]
    return reduce(DataFrame.unionByName, frames)


def count_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _stacked(df: DataFrame, metrics: dict[str, F.Column]) -> DataFrame:
    """One aggregation pass over ``df`` -> one ``(metric, value)`` row per metric."""
    one = df.agg(*[c.cast("long").alias(f"m{i}") for i, c in enumerate(metrics.values())])
    pairs = ", ".join(f"'{name}', m{i}" for i, name in enumerate(metrics))
    return one.select(F.expr(f"stack({len(metrics)}, {pairs}) AS (metric, value)"))


def sync_report(listed: DataFrame, landed: DataFrame, mapped_docs: DataFrame,
                embedded_all: DataFrame) -> DataFrame:
    """The run's counters, one aggregation pass per input.

    ``embedded_all``: the run's chunk rows with their ``embedding`` column
    (null where embedding failed), before the split into vectors/rejects.
    """
    from quillsync.operators.vectors import reject_reason
    ok = reject_reason(embedded_all.columns).isNull()
    one = F.lit(1)
    return reduce(DataFrame.unionByName, [
        _stacked(listed, {"files_listed": F.count(one)}),
        _stacked(landed, {"files_landed": F.count(one)}),
        _stacked(mapped_docs, {
            "documents_mapped": F.count(one),
            "documents_new": F.count(F.when(F.col("status") == "new", 1)),
            "documents_changed": F.count(F.when(F.col("status") == "changed", 1)),
            "documents_same": F.count(F.when(F.col("status") == "same", 1))}),
        _stacked(embedded_all, {
            "chunks": F.count(one),
            "chunked_documents": F.countDistinct("document_id"),
            "chunk_tokens": F.sum("token_count"),
            "embedded_documents": F.countDistinct(F.when(ok, F.col("document_id"))),
            "vectors_upserted": F.count(F.when(ok, 1)),
            "rejects": F.count(F.when(~ok, 1))}),
    ])


def delete_report(ids: DataFrame, docs: DataFrame, chunks: DataFrame,
                  vectors: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Ids found and the rows each store loses when those ids are deleted
    (counted on the semi-join side, before the delete)."""
    k = ids.select(F.col(ids.columns[0]).cast("string").alias("_id")).distinct()
    d = docs.join(k, docs["id"] == k["_id"], "left_semi")
    c = chunks.join(k, chunks["document_id"] == k["_id"], "left_semi")
    v = vectors.where(F.col("namespace") == F.lit(namespace)).join(k, F.col("metadata.document_id") == k["_id"], "left_semi")
    return metric_rows({
        "ids_found": count_of(k),
        "documents_deleted": count_of(d),
        "chunks_deleted": count_of(c),
        "vectors_deleted": count_of(v),
    })
