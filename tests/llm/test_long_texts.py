"""Decontamination of long texts: time in proportion, words cut as by a plain split and trim."""

import random
import re
import time

import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillsync.llm import decontam


def plain_words(text):
    return [regex.sub(r"^[^\p{L}\p{N}+-]+|[^\p{L}\p{N}%]+$", "", w) for w in re.split(r"[ \t-\r]+", text) if w]


def test_words_are_cut_as_by_split_and_trim(spark):
    rng = random.Random(2)
    texts = ["", " ", "a", "...", "+-", "%", "+%.", ".%", "a%.", "(Tom's)  12.5kg,\t-3% \n«É»  x..y", "-", "--x--"]
    texts += ["".join(rng.choice("aZ9é+-%.,'( \t\n\x0b") for _ in range(rng.randint(1, 40))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.word for r in df.select("id", F.regexp_extract_all("text", F.lit(decontam._WORD), 1).alias("word"))
           .collect()}
    assert got == {i: plain_words(t) for i, t in enumerate(texts)}


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="ab +-%.9\n", max_size=60))
def test_the_word_pattern_in_another_engine(text):
    assert regex.findall(decontam._WORD, text) == plain_words(text)


def test_doubled_windows_are_all_windows(spark):
    rows = [(n, [f"w{i % 9}" for i in range(n)], [f"v{i % 5}" for i in range(n)]) for n in range(20)]
    df = spark.createDataFrame(rows, "id long, word array<string>, tpl array<string>")
    seen = {}
    for r in decontam._doubled(df, ["id", "word", "tpl"], a="word", b="tpl").collect():
        for words, hashes in ((r.word, r.a), (r.tpl, r.b)):
            windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
            assert len(hashes) == len(windows)
            for w, h in zip(windows, hashes):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_end(spark):
    item = "how many red apples does the farmer sell on monday if he has forty of them"
    texts = ["x" + "." * 100_000 + "x", " ".join(f"w{i % 7919} Word{i} {i}" for i in range(67_000)) + " " + item,
             ("- " * 50_000) + item, "A" * 200_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    decontam.contaminated(docs.limit(0), bench).collect()       # the plan's code is compiled
    began = time.time()
    got = decontam.contaminated(docs, bench).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1)] and time.time() - began < 30
