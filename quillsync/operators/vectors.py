"""Vector store operators: validate, project, upsert, fetch, clear, delete.

A vector row is ``(namespace, id, values, metadata)`` with ``metadata`` a
struct of ``document_id, chunk_index, token_count`` (the chunk text is not
stored; retrieval joins back to the chunk store).  Upsert is a keyed
anti join + union into the next state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.schemas import DEFAULT_NAMESPACE


def _reject(reason: Column, document_id: Column, chunk_id: Column) -> Column:
    return F.concat(F.lit("[doc="), F.coalesce(document_id, F.lit("")),
                    F.lit(" | chunk="), F.coalesce(chunk_id, F.lit("")),
                    F.lit("]: "), reason)


def _index() -> Column:
    return F.col("chunk_index").try_cast("int")


def _tokens(cols) -> Column:
    return F.col("token_count").try_cast("int") if "token_count" in cols else F.lit(0)


def reject_reason(cols, dim: int | None = None) -> Column:
    """Why an embedded chunk cannot become a vector (null when it can)."""
    cid = F.col("id").cast("string")
    emb = F.col("embedding")
    return (F.when(cid.isNull() | (cid == ""), F.lit("no_chunk_id"))
            .when(emb.isNull() | (F.size(emb) == 0), F.lit("no_embedding"))
            .when(F.exists(emb, lambda x: x.isNull() | F.isnan(x.cast("double"))), F.lit("bad_embedding"))
            .when(F.size(emb) != (F.size(emb) if dim is None else F.lit(dim)), F.lit("bad_dimension"))
            .when(_index().isNull(), F.lit("bad_chunk_index"))
            .when(_tokens(cols).isNull(), F.lit("bad_token_count")))


def to_vectors(embedded: DataFrame, namespace: str = DEFAULT_NAMESPACE,
               run_ts: Column | None = None, dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Embedded chunks -> (valid vectors, rejects).

    A chunk is rejected when its id is missing or empty, its embedding is
    missing or empty, holds a null or NaN or is not of ``dim`` values (where given), or its index / token count cannot be read as an int.
    A *missing* ``token_count`` column means 0; a null one is rejected.
    """
    idx, tok = _index(), _tokens(embedded.columns)
    emb = F.col("embedding")
    cid = F.col("id").cast("string")
    doc = F.col("document_id").cast("string")
    checked = embedded.withColumn("_reason", reject_reason(embedded.columns, dim))
    valid = checked.where(F.col("_reason").isNull()).select(
        F.lit(namespace).alias("namespace"),
        cid.alias("id"),
        emb.cast("array<float>").alias("values"),
        F.struct(doc.alias("document_id"), idx.alias("chunk_index"),
                 tok.alias("token_count")).alias("metadata"))
    ts = run_ts if run_ts is not None else F.current_timestamp()
    rejects = checked.where(F.col("_reason").isNotNull()).select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        doc.alias("filename"),
        _reject(F.col("_reason"), doc, cid).alias("error"))
    return valid, rejects


def upsert(old: DataFrame, new: DataFrame, keys=("namespace", "id"),
           materialize: bool = False) -> DataFrame:
    """Next state: every key of ``new`` replaces the old row; one row per key.

    Of duplicate keys inside ``new`` the last write wins: the largest
    ``(chunk_index, document_id, values)``, a total order, via a partial aggregation.

    An anti join rather than one full outer join: when the batch is small,
    AQE broadcasts its keys and the (large) old store is never shuffled.  The
    batch is read twice (keys and rows): ``materialize=True`` first writes it
    with a reliable ``checkpoint()`` to the shared checkpoint folder, so an
    expensive lazy batch (chunking + embedding) is computed once.
    """
    keys = list(keys)
    if materialize:
        from quillsync.session import cut_lineage
        new = cut_lineage(new)
    order = F.struct("metadata.chunk_index", "metadata.document_id", "values")
    row = F.struct(*[c for c in old.columns if c not in keys])
    deduped = new.groupBy(*keys).agg(F.max_by(row, order).alias("_row")) \
        .select(*keys, "_row.*").select(*old.columns)
    return old.join(deduped.select(*keys), keys, "left_anti").unionByName(deduped)


def sync_vectors(old: DataFrame, embedded: DataFrame, namespace: str = DEFAULT_NAMESPACE,
                 materialize: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validate + upsert all documents' vectors at once -> (store, upserted, rejects)."""
    valid, rejects = to_vectors(embedded, namespace)
    if materialize:
        from quillsync.session import cut_lineage
        valid = cut_lineage(valid)
    return upsert(old, valid), valid, rejects


def vectors_of(vectors: DataFrame, doc_id: str, limit: int | None = None,
               namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Vectors of one document (metadata filter); with ``limit`` the first by id."""
    found = vectors.where((F.col("namespace") == namespace)
                          & (F.col("metadata.document_id") == F.lit(doc_id)))
    return found if limit is None else found.orderBy("id").limit(limit)


def vectors_for(vectors: DataFrame, doc_ids: DataFrame, limit: int | None = None,
                namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Bulk fetch: all vectors of each listed document, or the first ``limit`` by id.

    The limit is a ``row_number`` filter over the ids alone, taken before the
    join with the listed documents, so Spark cuts it before the shuffle
    (a partial ``WindowGroupLimit``): a hot document sends at most ``limit``
    ids per map partition.  The values come by a semi join on the kept ids.
    """
    from pyspark.sql import Window
    ids = doc_ids.select(F.col(doc_ids.columns[0]).cast("string").alias("_doc")).distinct()
    v = vectors.where(F.col("namespace") == namespace).withColumn("_doc", F.col("metadata.document_id"))
    if limit is None:
        return v.join(ids, "_doc", "left_semi").drop("_doc")
    w = Window.partitionBy("_doc").orderBy("id")
    first = (v.select("_doc", "id").withColumn("_rn", F.row_number().over(w))
             .where(F.col("_rn") <= limit).join(ids, "_doc", "left_semi").select("_doc", "id"))
    return v.join(first, ["_doc", "id"], "left_semi").drop("_doc")


def clear_namespace(vectors: DataFrame, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Next state with every vector of ``namespace`` removed."""
    return vectors.where(F.col("namespace") != F.lit(namespace))


def delete_vectors(vectors: DataFrame, doc_ids, namespace: str = DEFAULT_NAMESPACE) -> DataFrame:
    """Next state without the vectors of ``namespace`` whose ``metadata.document_id`` is
    listed; other namespaces keep theirs."""
    from quillsync.operators.store import keys_of
    k = keys_of(vectors.sparkSession, doc_ids, "_doc")
    # null (never equal) for vectors of other namespaces
    doc = F.when(F.col("namespace") == F.lit(namespace), F.col("metadata.document_id"))
    return vectors.withColumn("_doc", doc).join(k, "_doc", "left_anti").drop("_doc")
