"""What Python workers keep between tasks: they wait beside their executor's JVM, in stages without Python, too."""

import re

import numpy as np
import pyarrow as pa
import pytest

from quillsync.llm import packing, text
from quillsync.llm.queries import tokenizer


def own_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\s+(\d+)", f.read()).group(1)) / 1024


def test_freed_memory_goes_back_when_a_task_ends():
    kept = []

    def run(batches):
        held = [np.ones(8000) for _ in range(2000)]          # too small to be mapped one by one
        kept.append(np.ones(8000))                           # above them, so the heap cannot shrink by itself
        kept.append(own_mb())
        for b in batches:
            held.append(b)
            yield b

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["a"])
    assert list(text.released(run)(iter([batch, batch]))) == [batch, batch]
    assert own_mb() < kept[1] - 100


def test_memory_goes_back_when_a_task_fails(monkeypatch):
    calls = []
    monkeypatch.setattr(text, "release_memory", lambda: calls.append(1))

    def run(batches):
        yield from batches
        raise ValueError("a bad row")

    with pytest.raises(ValueError, match="a bad row"):
        list(text.released(run)(iter([])))
    assert calls == [1]


def test_workers_keep_no_words_of_packed_texts(spark):
    rows = [(i, " ".join(f"word{i}x{j}" for j in range(300))) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert packing.pack(docs, tokenizer("byte_bpe_50k.json")).count()

    def held(batches):
        from quillsync.llm import packing
        n = sum(len(e.cache) + len(e.old) for e in packing._ENCODERS.values())
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    assert {r.n for r in docs.select("doc_id").mapInArrow(held, "n long").collect()} == {0}
