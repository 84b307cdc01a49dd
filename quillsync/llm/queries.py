"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def crc_part(doc_id: str, n: int):
    """crc32 of the id as text, modulo n (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


@query
def op1_katz(spark, d):
    from quillsync.llm import katz
    return katz.scores(_table(spark, d, "documents"), crc_part("doc_id", 10) == 0)


@query
def op2_licences(spark, d):
    from quillsync.llm import licences
    return licences.scan(_table(spark, d, "documents"))


@query
def op3_packing(spark, d):
    from quillsync.llm import packing
    return packing.pack(_table(spark, d, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op4_jaccard(spark, d):
    from quillsync.llm import jaccard
    return jaccard.components(_table(spark, d, "documents"))


@query
def op5_bpe_counts(spark, d):
    from quillsync.llm import bpe
    return bpe.token_counts(_table(spark, d, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op6_decontamination(spark, d):
    from quillsync.llm import decontam
    return decontam.contaminated(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


@query
def op7_secrets(spark, d):
    from quillsync.llm import secret_scan
    return secret_scan.scan(_table(spark, d, "documents"))


@query
def op8_quality(spark, d):
    from quillsync.llm import quality
    docs = _table(spark, d, "documents").select("doc_id", "text")
    labels = _table(spark, d, "labels").where(crc_part("doc_id", 5) != 0)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", (crc_part("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op9_fingerprints(spark, d):
    from quillsync.llm import sketch
    return sketch.with_edited(_table(spark, d, "documents"))


@query
def op10_chat(spark, d):
    from quillsync.llm import chat
    extra = spark.createDataFrame(
        [(-1, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string")
    rows = _table(spark, d, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    turns = chat.canonical(chat.as_records(rows), "payload", ["conv_id", "turn"])
    return chat.read_back(chat.formatted(turns))


@query
def op11_topk(spark, d):
    from quillsync.llm import threshold_topk
    rows = _table(spark, d, "embeddings")
    return threshold_topk.topk(rows, rows.where("vec_id % 50 = 0"), 5)


@query
def op12_periodic_runs(spark, d):
    from quillsync.llm import periodic
    return periodic.digests(periodic.runs(periodic.planted(_table(spark, d, "documents")), "id"))


@query
def op13_hard_negatives(spark, d):
    from quillsync.llm import hard_negatives
    rows = _table(spark, d, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, label=label)


def _sql():
    from quillsync.llm import licences
    SQL["op2_licences"] = licences.oracle_sql()
    # vectors without a null or non-finite component, on the integer lattice
    lattice = """SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
    SQL["op11_topk"] = f"""WITH r AS ({lattice}),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
              FROM r q JOIN r c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5"""
    SQL["op13_hard_negatives"] = f"""WITH r AS (
            SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM ({lattice}) WHERE label IS NOT NULL),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                     CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
              FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
               AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10"""


_sql()
