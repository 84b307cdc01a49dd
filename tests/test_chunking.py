import random

import pytest
from pyspark.sql import functions as F

from quillsync.functions.text import sentences, token_count
from quillsync.operators.chunking import chunk_ranges, make_chunks, pack

# FIXTURES C (MAX 10, OVERLAP 3): token counts -> inclusive sentence ranges
GOLDEN = [
    ([5, 5], [(0, 1)]),
    ([5, 6], [(0, 0), (0, 1)]),
    ([4, 3, 3, 2], [(0, 2), (2, 3)]),
    ([4, 2, 2, 2, 5], [(0, 3), (2, 4)]),
    ([12, 2], [(0, 0), (0, 1)]),
    ([12, 2, 2, 2], [(0, 0), (0, 1), (0, 2), (1, 3)]),
    ([2, 9], [(0, 0), (0, 1)]),
    ([], []),
]


def closed_form(t, mx, ov):
    """Brute force from the prefix-sum statement: split at i when
    P[i+1]-P[s] > mx; next start = last j in [s, i-1] with P[i]-P[j] >= ov."""
    n = len(t)
    P = [0]
    for x in t:
        P.append(P[-1] + x)
    cuts, s = [], 0
    for i in range(n):
        if P[i + 1] - P[s] > mx:
            if i > s:
                cuts.append((s, i - 1))
            if ov <= 0:
                s = i
            elif i > s:
                tails = [j for j in range(s, i) if P[i] - P[j] >= ov]
                s = max(tails) if tails else s
    if n:
        cuts.append((s, n - 1))
    return cuts


def run_pack(spark, arrays, mx, ov):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "k int, t array<int>")
    rows = df.select("k", pack("t", mx, ov).alias("c")).orderBy("k").collect()
    return [[(x.s, x.e) for x in r.c] for r in rows]


def test_golden_cases(spark):
    got = run_pack(spark, [g[0] for g in GOLDEN], 10, 3)
    assert got == [g[1] for g in GOLDEN]
    assert [closed_form(t, 10, 3) for t, _ in GOLDEN] == [g[1] for g in GOLDEN]


def test_exact_max_does_not_split(spark):
    assert run_pack(spark, [[10], [3, 7], [3, 7, 1]], 10, 3) == [[(0, 0)], [(0, 1)], [(0, 1), (1, 2)]]


def test_overlap_zero(spark):
    assert run_pack(spark, [[4, 3, 3, 2], [12, 2]], 10, 0) == [[(0, 2), (3, 3)], [(0, 0), (1, 1)]]


@pytest.mark.parametrize("mx,ov", [(10, 3), (20, 5), (7, 0), (50, 49), (5, 10)])
def test_random_against_closed_form(spark, mx, ov):
    rng = random.Random(mx * 100 + ov)
    arrays = [[rng.randint(1, 15) for _ in range(rng.randint(0, 40))] for _ in range(150)]
    got = run_pack(spark, arrays, mx, ov)
    for t, g in zip(arrays, got):
        assert g == closed_form(t, mx, ov), t


def test_properties_on_documents(spark):
    docs = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select(F.col("doc_id").alias("id"), F.col("text").alias("content")))
    mx, ov = 40, 10
    r = chunk_ranges(docs, mx, ov).collect()
    toks = {row.id: row.t for row in docs.select(
        "id", F.transform(sentences("content"), token_count).alias("t")).collect()}
    by_doc = {}
    for x in r:
        by_doc.setdefault(x.document_id, []).append((x.chunk_index, x.first_sentence, x.last_sentence))
    for doc, t in toks.items():
        cuts = [(s, e) for _, s, e in sorted(by_doc.get(doc, []))]
        assert cuts == closed_form(t, mx, ov)
        if t:
            assert cuts[0][0] == 0 and cuts[-1][1] == len(t) - 1          # every sentence covered
            assert all(a[1] < b[1] for a, b in zip(cuts, cuts[1:]))       # ends strictly increase
            assert all(a[0] <= b[0] for a, b in zip(cuts, cuts[1:]))      # starts never decrease
            for a, b in zip(cuts, cuts[1:]):
                # the carried tail [b.s, a.e] is worth >= overlap tokens,
                # unless the whole previous chunk is carried
                assert b[0] == a[0] or sum(t[b[0]:a[1] + 1]) >= ov
                assert b[0] <= a[1] + 1                                   # no gap between chunks


def test_make_chunks_text_and_counts(spark):
    docs = spark.createDataFrame(
        [("d1", "Short doc. Fits."), ("d2", "   "), ("d3", "A b c. D e f. G h i. J k l.")],
        "id string, content string")
    rows = sorted(make_chunks(docs, 7, 3).collect(), key=lambda r: (r.document_id, r.chunk_index))
    got = [(r.document_id, r.chunk_index, r.content, r.token_count) for r in rows]
    assert got == [
        ("d1", 0, "Short doc. Fits.", 5),
        ("d3", 0, "A b c.", 4),
        ("d3", 1, "A b c. D e f.", 8),
        ("d3", 2, "D e f. G h i.", 8),
        ("d3", 3, "G h i. J k l.", 8),
    ]


def test_document_under_max_is_one_chunk(spark):
    docs = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select(F.col("doc_id").alias("id"), F.col("text").alias("content"),
                    token_count("text").alias("n")))
    small = docs.where(F.col("n") <= 800)
    chunks = make_chunks(small)
    per_doc = chunks.groupBy("document_id").count()
    assert per_doc.where(F.col("count") != 1).count() == 0
    assert per_doc.count() == small.count()
    # recounted token_count of the single chunk equals the document's count
    joined = chunks.join(small, chunks.document_id == small.id)
    assert joined.where(F.col("token_count") != F.col("n")).count() == 0


def test_no_inferred_filter_on_cuts(spark):
    docs = spark.createDataFrame([("d", "A. B.")], "id string, content string")
    plan = make_chunks(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "size(_cuts" not in plan


def test_custom_counter_recounts_outside_lambdas(spark):
    import pandas as pd

    @F.pandas_udf("int")
    def chars(s: pd.Series) -> pd.Series:
        return s.str.len().astype("int32")

    @F.pandas_udf("array<int>")
    def chars_each(a: pd.Series) -> pd.Series:
        return pd.Series([[len(x) for x in v] for v in a])

    docs = spark.createDataFrame([("d", "Aaaa. Bbbbbb. Cc.")], "id string, content string")
    rows = sorted(make_chunks(docs, 12, 3, counter=chars, sentence_counter=chars_each).collect(),
                  key=lambda r: r.chunk_index)
    assert [(r.content, r.token_count) for r in rows] == [
        ("Aaaa. Bbbbbb.", 13), ("Bbbbbb. Cc.", 11)]
