"""Sentence packing: documents -> overlapping chunks under a token limit.

Greedy rule, per document with sentence token counts ``t[0..n-1]``:

* sentences are added to the open chunk while its token sum stays
  ``<= max_tokens``;
* when sentence ``i`` would overflow it, the open chunk (if it holds
  anything) is emitted, and the next chunk starts with the shortest
  whole-sentence tail of it worth at least ``overlap`` tokens (all of it when
  no tail is enough), followed by sentence ``i`` without a further check;
* the last open chunk is emitted at the end.

The state machine is one ``aggregate`` over the sentence positions of a row,
so packing is a narrow, map-only step: documents never leave their
partition and no Python worker is involved.  State per step is
``(s, cur, cuts)`` (chunk start, its token sum, emitted ranges); the tail
search is an inner ``aggregate`` over the open chunk only, so a document
costs O(sentences + chunk-size * chunks).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.functions.text import sentences as default_splitter
from quillsync.functions.text import token_count as default_counter

CUTS_TYPE = "array<struct<s:int,e:int>>"

# The reference's chunk limits (the minimum size is declared
# there but never applied, so it has no parameter here).
MAX_TOKENS = 800
OVERLAP_TOKENS = 80


def _cut(s: Column, e: Column) -> Column:
    return F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"))


def pack(tokens: Column | str, max_tokens: int = MAX_TOKENS,
         overlap: int = OVERLAP_TOKENS) -> Column:
    """Token counts (array<int>) -> inclusive sentence ranges (array<struct<s,e>>)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.size(t)
    mx = F.lit(int(max_tokens))
    ov = int(overlap)

    def state(s: Column, cur: Column, cuts: Column) -> Column:
        return F.struct(s.cast("int").alias("s"), cur.cast("int").alias("cur"),
                        cuts.alias("cuts"))

    def split(a: Column, i: Column) -> Column:
        ti = t[i]
        # i > s always holds here except at i == 0 (empty buffer).
        emitted = F.concat(a["cuts"], F.array(_cut(a["s"], i - 1)))
        if ov <= 0:
            return F.when(i > a["s"], state(i, ti, emitted)).otherwise(state(i, ti, a["cuts"]))
        tail = F.aggregate(
            F.sequence(i - 1, a["s"], F.lit(-1)),
            F.struct(F.lit(0).alias("sum"), i.alias("j")),
            lambda p, j: F.when(
                p["sum"] < F.lit(ov),
                F.struct((p["sum"] + t[j]).alias("sum"), j.alias("j")),
            ).otherwise(p),
            lambda p: state(p["j"], p["sum"] + ti, emitted),
        )
        return F.when(i > a["s"], tail).otherwise(state(a["s"], ti, a["cuts"]))

    def step(a: Column, i: Column) -> Column:
        ti = t[i]
        return F.when(a["cur"] + ti > mx, split(a, i)).otherwise(
            state(a["s"], a["cur"] + ti, a["cuts"]))

    packed = F.aggregate(
        F.sequence(F.lit(0), n - 1),
        state(F.lit(0), F.lit(0), F.array().cast(CUTS_TYPE)),
        step,
        lambda a: F.concat(a["cuts"], F.array(_cut(a["s"], n - 1))),
    )
    return F.when(n > 0, packed).otherwise(F.array().cast(CUTS_TYPE))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition of a *file scan* that arrives in fewer
    partitions than both the cores and the shuffle partitions (e.g. a big
    file with one row group).  Large scans already arrive in many splits and
    are left alone.

    Use it where data is read, not on a plan with shuffles: counting the
    partitions of an adaptive plan runs its shuffle stages."""
    spark = df.sparkSession
    try:
        target = spark.sparkContext.defaultParallelism
        target = min(target, int(spark.conf.get("spark.sql.shuffle.partitions")))
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave as is
        return df
    return df.repartition(target) if have < target else df


def _packed(docs: DataFrame, max_tokens: int, overlap: int, id_col: str, text_col: str,
            splitter, per_sentence) -> DataFrame:
    """``document_id, _sents, _cuts``.  The token counts are their own column:
    ``pack`` reads them many times inside its lambdas, and an attribute is read,
    where an inlined expression would be recomputed on every access."""
    sents = docs.select(F.col(id_col).alias("document_id"),
                        splitter(F.col(text_col)).alias("_sents"))
    toks = sents.withColumn("_toks", per_sentence(F.col("_sents")))
    return toks.select("document_id", "_sents", "_toks",
                       pack(F.col("_toks"), max_tokens, overlap).alias("_cuts"))


def make_chunks(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    overlap: int = OVERLAP_TOKENS,
    id_col: str = "id",
    text_col: str = "content",
    splitter: Callable[[Column], Column] | None = None,
    counter: Callable[[Column], Column] | None = None,
    sentence_counter: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Documents -> chunk rows ``(document_id, chunk_index, content, token_count)``.

    ``splitter`` maps text to ``array<string>``; ``counter`` maps a string to
    an int token count and must be built from Spark functions (it runs inside
    ``transform``).  A counter that is a Python/pandas UDF cannot run inside a
    lambda: pass it as ``counter`` for the final recount and give
    ``sentence_counter`` (``array<string> -> array<int>``) for the sentences.

    Chunk text is the sentences joined by one space; ``token_count`` is
    recounted on that text.  Blank documents give no chunk.
    """
    split_fn = splitter or default_splitter
    count_fn = counter or default_counter
    per_sentence = sentence_counter or (lambda arr: F.transform(arr, count_fn))
    packed = _packed(docs, max_tokens, overlap, id_col, text_col, split_fn, per_sentence)

    additive = counter is None and sentence_counter is None

    def chunk_of(c: Column) -> Column:
        n = c["e"] - c["s"] + 1
        text = F.array_join(F.slice("_sents", c["s"] + 1, n), " ")
        if additive:
            # the default counter is additive over the sentences of a chunk
            # (tokens never span white space), so the recount is their sum
            tokens = F.aggregate(F.slice("_toks", c["s"] + 1, n), F.lit(0), lambda a, x: a + x)
        else:
            tokens = F.lit(None).cast("int")
        return F.struct(text.alias("content"), tokens.cast("int").alias("token_count"))

    # Chunk text is built inside the row, so the explode below carries only
    # the chunks, not the document's sentence array into every output row.
    # posexplode_outer, not posexplode: the inner form makes the optimizer infer
    # a size(...) > 0 filter that re-evaluates the packing per reference.
    texts = packed.select("document_id", F.transform("_cuts", chunk_of).alias("_chunks"))
    out = (texts
           .select("document_id", F.posexplode_outer("_chunks").alias("chunk_index", "_c"))
           .where(F.col("_c").isNotNull())
           .select("document_id", F.col("chunk_index").cast("int").alias("chunk_index"),
                   F.col("_c.content").alias("content"), F.col("_c.token_count").alias("token_count")))
    if not additive:
        # a custom counter (possibly a pandas UDF) recounts the joined text,
        # outside any lambda
        out = out.withColumn("token_count", count_fn(F.col("content")).cast("int"))
    return out


def chunk_ranges(docs: DataFrame, max_tokens: int = MAX_TOKENS,
                 overlap: int = OVERLAP_TOKENS, id_col: str = "id",
                 text_col: str = "content") -> DataFrame:
    """Documents -> ``(document_id, chunk_index, first_sentence, last_sentence)``."""
    packed = _packed(docs, max_tokens, overlap, id_col, text_col, default_splitter,
                     lambda arr: F.transform(arr, default_counter))
    return (packed
            .select("document_id", F.posexplode_outer("_cuts").alias("chunk_index", "_cut"))
            .where(F.col("_cut").isNotNull())
            .select("document_id", F.col("chunk_index").cast("int").alias("chunk_index"),
                    F.col("_cut.s").alias("first_sentence"),
                    F.col("_cut.e").alias("last_sentence")))
