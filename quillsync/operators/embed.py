"""Embedding stage: one vector per chunk, failures become rejects.

The embedder is a plug-in ``Column(string) -> Column(array<float>)``:

* :func:`hashing_embedder` (default) is feature hashing on Spark SQL
  functions only: tokens -> md5 bucket -> bucket counts -> L2 normalised.
  Deterministic, JVM-side, and reproducible by any SQL engine with md5.
* :func:`pandas_embedder` wraps a batch function (``list[str] ->
  list[list[float] | None]``, e.g. a local model) as an Arrow-batched pandas
  UDF.  A failing batch is retried row by row; a failing row gives null.

A null embedding is a failed call: the chunk goes to the rejects.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.functions.text import TOKEN_PATTERN

EMBED_DIM = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and bind it to the lambda variable of ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def token_buckets(text: Column, dim: int = EMBED_DIM) -> Column:
    """Tokens of ``text`` hashed to ``[0, dim)`` by their md5 (first 32 bits)."""
    toks = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)
    return F.transform(
        toks, lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long"),
                               F.lit(dim)))


def _normalise(cs: Column) -> Column:
    """Counts -> L2-normalised float vector; null when all counts are zero."""
    norm = F.sqrt(F.aggregate(cs, F.lit(0.0).cast("double"),
                              lambda a, c: a + (c * c).cast("double")))
    return let(norm, lambda nrm: F.when(
        nrm > 0, F.transform(cs, lambda c: (c / nrm).cast("float"))))


_MARK_BASE = 48  # bucket b is written as the ASCII character 48 + b
_SIXTY_FOUR = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _marks(text: Column, dim: int) -> tuple[Column, list[str]]:
    """One ASCII character per token of ``text``, and the character of each bucket.

    Of 64 buckets a token's bucket is the low 6 bits of the fourth byte of its md5, which base64 writes as the last
    character of bytes 2 to 4: no number is made of the digits, token by token."""
    if dim == 64:
        toks = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)
        marks = F.transform(toks, lambda t: F.substring(F.base64(F.unhex(F.substring(F.md5(t), 3, 6))), 4, 1))
        return F.array_join(marks, ""), list(_SIXTY_FOUR)
    marks = F.transform(token_buckets(text, dim), lambda b: F.char(b + _MARK_BASE))
    return F.array_join(marks, ""), [chr(b + _MARK_BASE) for b in range(dim)]


def hashing_embedder(dim: int = EMBED_DIM) -> Callable[[Column], Column]:
    """Feature-hashing embedder on built-in functions (no Python worker).

    Bucket counts are taken on a string with one character per token
    (``octet_length(s) - octet_length(replace(s, c, ''))`` per bucket: native byte scans)
    rather than per-bucket array copies, which box every element.
    """
    if dim + _MARK_BASE > 127:
        return _hashing_embedder_arrays(dim)

    def embed(text: Column) -> Column:
        marks, of = _marks(text, dim)

        def from_marks(m: Column) -> Column:
            counts = F.transform(
                F.array(*[F.lit(c) for c in of]),
                lambda c: F.octet_length(m) - F.octet_length(F.replace(m, c, F.lit(""))))
            return let(counts, _normalise)
        return let(marks, from_marks)
    return embed


def _hashing_embedder_arrays(dim: int) -> Callable[[Column], Column]:
    """Same vectors for any ``dim``, counting on the bucket array."""
    def embed(text: Column) -> Column:
        def from_buckets(bs: Column) -> Column:
            counts = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)).cast("array<long>"),
                                 lambda b: F.size(bs) - F.size(F.array_remove(bs, b)))
            return let(counts, _normalise)
        return let(token_buckets(text, dim), from_buckets)
    return embed


def pandas_embedder(fn: Callable[[list], list], dim: int | None = None):
    """Wrap a batch embedding function as an Arrow pandas UDF -> array<float>."""

    @F.pandas_udf("array<float>")
    def _embed(texts: pd.Series) -> pd.Series:
        items = texts.tolist()
        try:
            out = list(fn(items))
        except Exception:  # noqa: BLE001 - one bad row must not fail the batch
            out = []
            for t in items:
                try:
                    out.append(fn([t])[0])
                except Exception:  # noqa: BLE001
                    out.append(None)
        if dim is not None:
            out = [v if v is not None and len(v) == dim else None for v in out]
        return pd.Series(out, dtype=object)

    return _embed


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` plus column ``name`` evaluated exactly once per row.

    A plain ``withColumn`` + ``where`` lets the optimizer push the filter
    below the projection with the expression inlined, so an expensive value
    (an embedding, a model call) would be computed twice.  A one-row
    ``inline_outer`` generator is a boundary filters cannot cross.
    """
    return df.select("*", F.inline_outer(F.array(F.struct(value.alias(name)))))


def embed(chunks: DataFrame, embedder: Callable[[Column], Column] | None = None,
          text_col: str = "content", run_ts: Column | None = None,
          materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Chunks -> (chunks with ``embedding``, rejects for failed embeddings).

    ``materialize=True`` writes the embedded chunks with a reliable checkpoint
    first, so reading both outputs runs the embedder once."""
    fn = embedder or hashing_embedder()
    out = compute_once(chunks, "embedding", fn(F.col(text_col)))
    if materialize:
        from quillsync.session import cut_lineage
        out = cut_lineage(out)
    return split_embedded(out, run_ts)


def split_embedded(out: DataFrame, run_ts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with an ``embedding`` column -> (embedded rows, rejects where it is null)."""
    ts = run_ts if run_ts is not None else F.current_timestamp()
    ok = out.where(F.col("embedding").isNotNull())
    bad = out.where(F.col("embedding").isNull()).select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("document_id").cast("string").alias("filename"),
        F.concat(F.lit("no_embedding [doc="),
                 F.coalesce(F.col("document_id").cast("string"), F.lit("")),
                 F.lit(" | chunk="), F.coalesce(F.col("id").cast("string"), F.lit("")),
                 F.lit("]")).alias("error"))
    return ok, bad


def group_by_document(embedded: DataFrame) -> DataFrame:
    """Per-document summary of the embedded chunks (the grouped form, without
    collecting a document's chunks into one row): count, index range, gaps in
    the index sequence, token total."""
    return (embedded.groupBy(F.col("document_id").cast("string").alias("document_id"))
            .agg(F.count(F.lit(1)).alias("chunks"),
                 F.min("chunk_index").alias("first_index"),
                 F.max("chunk_index").alias("last_index"),
                 F.sum("token_count").alias("tokens"))
            .withColumn("index_gaps",
                        F.col("last_index") - F.col("first_index") + 1 - F.col("chunks")))
