"""Work and memory of steps that grew faster than their input."""

import numpy as np
import pyarrow as pa

from quillsync.operators import postings


def test_postings_are_grouped_in_bounded_slices(monkeypatch):
    texts = [["a", "b", "a"], [], ["c"] * 9, ["b"], ["a", "a"], [], ["d", "a"]]
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(len(texts))]),
                                        pa.array(texts, pa.list_(pa.string()))], ["document_id", "terms"])
    rows = lambda batches: [tuple(r.values()) for b in batches for r in b.to_pylist()]
    whole = rows(postings._group([batch]))
    monkeypatch.setattr(postings, "GROUP_TOKENS", 4)
    made = list(postings._group([batch.slice(1), batch.slice(0, 1)]))
    assert sorted(rows(made)) == sorted(whole) and len(whole) == 7
    assert len(made) > 3 and all(sum(b.column("tf").to_pylist()) <= 9 for b in made)
    for d, t in enumerate(texts):
        for term in set(t):
            want = [i for i, x in enumerate(t) if x == term]
            got = next(r for r in whole if r[:2] == (term, str(d)))
            assert list(np.cumsum(got[3])) == want and got[2] == len(want) and got[4] == len(t)


def test_phrase_places_come_from_the_rarest_term(spark, monkeypatch):
    rows = [(str(i), "a b " * 200 + ("rare a b" if i < 3 else "c")) for i in range(40)]
    asked = [("q", "a b rare a b"), ("none", "a b missing"), ("one", "rare")]
    made = []
    cut = postings.cut_lineage
    monkeypatch.setattr(postings, "cut_lineage", lambda df: made.append(cut(df)) or made[-1])
    found = postings.phrases(postings.postings_of(spark.createDataFrame(rows, "id string, content string")),
                             spark.createDataFrame(asked, "query_id string, text string"))
    assert sorted(map(tuple, found.collect())) == sorted((q, str(i), 1) for q in ("q", "one") for i in range(3))
    assert max(df.count() for df in made) <= 6


def test_old_postings_are_removed_by_document(spark, scratch, monkeypatch):
    """One key per changed document, not one per term of its text."""
    from pyspark.sql import functions as F

    from quillsync.operators import bucketed
    from quillsync.plans import incremental as inc
    from quillsync.plans.sync import SyncConfig
    from quillsync.schemas import CHUNKS, DOCX_MIME, SOURCE_FILES, VECTORS, empty

    ts = F.timestamp_seconds(F.lit(1704067200))
    old = [(f"i{i}", f"t{i}", " ".join(f"w{i}x{j}" for j in range(50)) + " shared") for i in range(6)]
    docs = spark.createDataFrame(old, "id string, title string, content string") \
        .withColumn("created_at", ts).withColumn("updated_at", ts)
    stores = inc.open_stores(spark, scratch, buckets=4, postings_buckets=8)
    inc.load(stores, docs, empty(spark, CHUNKS), empty(spark, VECTORS))
    asked = {}
    without = bucketed._without

    def seen(rows, gone, on):
        asked[tuple(sorted(on.values()))] = gone.count()
        return without(rows, gone, on)

    monkeypatch.setattr(bucketed, "_without", seen)
    files = [(f"f{i}", f"t{i}.docx", DOCX_MIME, i, f"shared now{i}") for i in range(2)]
    man = spark.createDataFrame(files, "file_id string, name string, mime_type string, position long, content string") \
        .select(*SOURCE_FILES.names)
    inc.sync(stores, man, all=True, cfg=SyncConfig(run_id="r"), run_ts=ts)
    assert asked["document_id",] == 2
    want = {(f"i{i}", t) for i in range(2) for t in ("shared", f"now{i}")} | \
        {(i, t) for i, _, text in old[2:] for t in text.split()}
    read = lambda: {(r.document_id, r.term) for r in stores.read("postings").collect()}
    assert read() == want
    inc.cleanup(stores, ["t1.docx", "t5.docx"], run="c")
    assert asked["document_id",] == 2 and read() == {x for x in want if x[0] not in ("i1", "i5")}


def test_word_files_are_parsed_in_bounded_slices(monkeypatch):
    import pandas as pd

    from quillsync.sources import docx

    monkeypatch.setattr(docx, "SLICE_BYTES", 2500)
    files = [docx._build_docx([f"paragraph {i}", "x"]) for i in range(12)] + [docx._build_docx(["y" * 9000])]
    pdf = pd.DataFrame({"name": [str(i) for i in range(13)], "content": files})
    made = list(docx._extractor("raise")([pdf, pdf.iloc[:0]]))
    assert len(made) > 4 and pd.concat(made)["name"].tolist() == pdf["name"].tolist()
    assert [p[0] for m in made for p in m["paragraphs"]][:12] == [f"paragraph {i}" for i in range(12)]


def test_landed_files_are_bounded_in_text(spark, scratch, monkeypatch):
    import os

    from quillsync.streaming import sync_stream as ss

    rows = [(f"f{i}", f"t{i}.docx", "m", i, "x" * 1000) for i in range(40)]
    man = spark.createDataFrame(rows, "file_id string, name string, mime_type string, position long, content string")
    assert ss.land(man, f"{scratch}/small", files=2) == 1
    monkeypatch.setattr(ss, "LAND_BYTES", 4000)
    assert ss.land(man, f"{scratch}/large", files=2) == 5
    for folder, files in (("small", 2), ("large", 10)):
        found = [f for f in os.listdir(f"{scratch}/{folder}") if f.endswith(".parquet")]
        assert len(found) == files and spark.read.parquet(f"{scratch}/{folder}").count() == 40


def test_scoring_holds_few_scores_at_once(monkeypatch):
    from quillsync.operators import retrieval

    rng = np.random.default_rng(0)
    q, v = rng.normal(size=(4096, 8)), rng.normal(size=(2000, 8))
    held = []
    merge = retrieval._merge_topk
    monkeypatch.setattr(retrieval, "_merge_topk", lambda best, s, ids, k: held.append(s.nbytes) or merge(best, s, ids, k))
    best = [[] for _ in q]
    retrieval._score_into(best, q, v, np.array([f"v{i:04d}" for i in range(2000)], dtype=object), 3)
    assert max(held) <= 8 << 20
    want = np.round(q[:20] @ v.T, retrieval.SCORE_DECIMALS)
    assert [[s for s, _ in b] for b in best[:20]] == np.sort(want, axis=1)[:, :-4:-1].tolist()


def test_a_large_change_cuts_the_terms_of_some_documents_only(spark, scratch, monkeypatch):
    """Where the first documents' terms lie in every bucket, the others' are not looked up; else all are."""
    from pyspark.sql import functions as F

    from quillsync.plans import incremental as inc
    from quillsync.schemas import CHUNKS, VECTORS, empty

    ts = F.timestamp_seconds(F.lit(1704067200))
    texts = [(f"i{i}", f"t{i}", " ".join(f"w{i}x{j}" for j in range(5))) for i in range(12)] + [("one", "one", "alone")]
    docs = spark.createDataFrame(texts, "id string, title string, content string") \
        .withColumn("created_at", ts).withColumn("updated_at", ts)
    monkeypatch.setattr(inc, "FIRST_DOCUMENTS", 4)
    cut = []
    keys = inc.postings.keys_of
    monkeypatch.setattr(inc.postings, "keys_of", lambda df, *a: cut.append(df.count()) or keys(df, *a))
    for folder, buckets, calls in (("few", 2, 1), ("many", 64, 2)):
        stores = inc.open_stores(spark, f"{scratch}/{folder}", buckets=2, postings_buckets=buckets)
        inc.load(stores, docs, empty(spark, CHUNKS), empty(spark, VECTORS))
        cut.clear()
        inc.cleanup(stores, [f"t{i}.docx" for i in range(12)], run="c")
        assert len(cut) == calls and cut[0] < 12 and cut[calls - 1] == (cut[0] if calls == 1 else 12)
        assert [r.document_id for r in stores.read("postings").collect()] == ["one"]


def test_buckets_of_tokens_are_read_from_base64(spark):
    """Every bucket, and no number made of the digits of each token's md5."""
    from pyspark.sql import functions as F

    from quillsync.operators import embed

    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(600)] + ["é", "数据", "🙂", "+", "/", "="]
    rows = [(" ".join(rng.choice(words, n)),) for n in (1, 5, 700, 3000)] + [(" ".join(words),), (" ",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    made = df.select(embed.hashing_embedder()(F.col("t")).alias("v"))
    want = df.select(embed._hashing_embedder_arrays(64)(F.col("t")).alias("v"))
    assert [r.v for r in made.collect()] == [r.v for r in want.collect()]
    assert min(made.collect()[4].v) > 0 and made.collect()[5].v is None
    assert "conv(" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_clean_paragraphs_are_not_translated():
    from quillsync.sources import docx

    asked = []

    class Text(str):
        def translate(self, table):
            asked.append(str(self))
            return super().translate(table)

    plain = ["one & <two>", "tab\tend", "^-]\\ é \U0001f642"]
    assert docx._paragraph_texts(docx._build_docx([Text(p) for p in plain])) == plain and not asked
    bad = [f"a{chr(c)}b" for c in docx.NOT_XML]
    assert docx._paragraph_texts(docx._build_docx([*bad, "c"])) == ["ab"] * len(bad) + ["c"]
