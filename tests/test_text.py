import os
import re
import uuid

from pyspark.sql import functions as F

from quillsync.functions import text as tx

# FIXTURES D: name -> title
NAMES = {
    "a.docx": "a", "v1.2 notes": "v1", ".docx": ".docx", "..a.b": "..a", "a..docx": "a.",
    "plain": "plain", "a.": "a", "a.b.docx": "a.b", "...": "...", "Ünï.docx": "Ünï",
}


def test_title_of_fixture_names(spark):
    df = spark.createDataFrame([(k,) for k in NAMES], "name string")
    got = {r.name: r.t for r in df.select("name", tx.title_of("name").alias("t")).collect()}
    assert got == NAMES
    # the rule is the one of os.path.splitext
    assert all(os.path.splitext(k)[0] == v for k, v in NAMES.items())


def test_docx_name(spark):
    df = spark.createDataFrame([("x.pdf",), ("report",), ("a.b.c",)], "name string")
    got = [r[0] for r in df.select(tx.docx_name("name")).collect()]
    assert got == ["x.docx", "report.docx", "a.b.docx"]


def test_is_blank_matches_python_strip(spark):
    samples = ["", " ", "\t\n", " 　 ", "x", " a ", "\x0b\x1c", None, ".", "​"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(tx.is_blank("s")).collect()]
    want = [True if s is None else not s.strip() for s in samples]
    assert got == want


def test_strip_space_matches_python(spark):
    samples = ["  a b  ", "\n\tx　", "none", "   "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert [r[0] for r in df.select(tx.strip_space("s")).collect()] == [s.strip() for s in samples]


def test_sentences(spark):
    rows = [
        ("One. Two!  Three?\nFour",),
        ("  leading and trailing.  ",),
        ("no end mark",),
        ("3.14 is pi. e.g. this",),
        ("line one\nline two. next",),
        ("",),
        ("   \n ",),
    ]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(tx.sentences("t")).collect()]
    assert got == [
        ["One.", "Two!", "Three?", "Four"],
        ["leading and trailing."],
        ["no end mark"],
        ["3.14 is pi.", "e.g.", "this"],   # rule based: abbreviations split (a trained model would not)
        ["line one\nline two.", "next"],
        [],
        [],
    ]


def test_token_count(spark):
    rows = [("Hello, world!",), ("déjà vu 42x",), ("",), ("a-b c",), ("日本語 テキスト",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(tx.token_count("t")).collect()]
    assert got == [4, 3, 0, 4, 2]


def test_token_count_matches_python_regex(spark):
    # Python's `regex` module reads the pattern like Java does
    import regex
    py = re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: "\\U%08x" % int(m.group(1), 16),
                tx.TOKEN_PATTERN)
    pat = regex.compile(py)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.n for r in docs.select("doc_id", tx.token_count("text").alias("n")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == len(pat.findall(r.text))


def test_paragraphs(spark):
    df = spark.createDataFrame([("a\n\n  \nb\n",)], "t string")
    r = df.select(tx.paragraphs("t").alias("p"), tx.join_paragraphs(tx.paragraphs("t")).alias("j")).first()
    assert r.p == ["a", "b"] and r.j == "a\nb"


def test_stable_id_is_uuid_shaped_and_deterministic(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "x string, y int")
    ids = [r[0] for r in df.select(tx.stable_id("x", "y")).collect()]
    assert ids[0] == ids[1] != ids[2]
    for i in ids:
        assert str(uuid.UUID(i)) == i
    assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", ids[0])
    import hashlib
    h = hashlib.md5(b"a|1").hexdigest()
    assert ids[0].replace("-", "") == h
