"""Stages of ``corpus_pipeline`` and the registration of the llm queries."""

import pyarrow.parquet as pq

import __spark_entry__ as entry
import corpus_pipeline
from quillsync.llm import secret_scan
from quillsync.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert sorted(docs.columns) == sorted(columns)
            seen.append({r.doc_id: r.text for r in docs.collect()})
    _, _, single, clean, safe = seen
    assert all(set(b) <= set(a) for a, b in zip(seen, seen[1:]))
    assert len(set(single.values())) == len(single)               # no exact copy is left
    assert not any(x in t for t in clean.values() for x in items)
    assert set(safe) == set(clean) and not any(secret_scan.base_spans(t) for t in safe.values())
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(safe)


def test_stages_act_by_row(spark, tmp_path):
    item = pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()[0]
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcde"}
    rows = [(1, texts["a"]), (1, texts["b"]), (2, texts["a"]), (1, texts["a"]), (None, texts["c"]), (None, texts["c"]),
            (None, texts["d"]), (3, texts["d"]), (4, texts["e"]), (4, "so it said: " + item), (None, item + " it was")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    once = [(1, texts["a"]), (1, texts["b"]), (None, texts["c"]), (3, texts["d"]), *rows[8:]]
    got = corpus_pipeline.jaccard_stage(spark, docs, SF)
    # the two rows with the item are near copies of each other; one of them is left
    assert sorted(map(str, got.where(~got.text.contains(item)).collect())) == sorted(
        map(str, docs.sparkSession.createDataFrame(once[:5], docs.schema).collect()))
    clean = corpus_pipeline.decontam_stage(spark, docs, SF).collect()
    assert sorted(map(str, clean)) == sorted(
        map(str, docs.sparkSession.createDataFrame(rows[:9], docs.schema).collect()))
