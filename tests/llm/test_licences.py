import duckdb
import pytest

from quillsync.llm import licences

TEXTS = {i: t for i, kind, t in reversed(licences.KNOWN) if kind == "text"}
MIT = TEXTS["MIT"].replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
HEADER = [t for i, kind, t in licences.KNOWN if kind == "header" and i == "Apache-2.0"][0]


def wrap(text, width, mark=""):
    lines, now = [], ""
    for w in text.split():
        if len(now) + len(w) >= width:
            lines.append(now)
            now = w
        else:
            now = f"{now} {w}".strip()
    return "\n".join(mark + x for x in [*lines, now])


CASES = [
    (1, "Copyright (c) Microsoft Corporation.\n\n" + MIT, "MIT"),
    (2, "Copyright The Authors 2020\n" + MIT, "MIT"),
    (3, "# Copyright 2020 X\n#\n" + wrap(TEXTS["BSD-3-Clause"], 70, "# "), "BSD-3-Clause"),
    (4, "// Copyright (c) 2021 Y\n" + MIT, "MIT"),
    (5, "/*\n * Copyright 2020 Z. All rights reserved.\n *\n" + wrap(TEXTS["BSD-2-Clause"], 60, " * ") + "\n */", "BSD-2-Clause"),
    (6, "(c) 1999 W\n" + TEXTS["Unlicense"], "Unlicense"),
    (7, "© Somebody\n" + TEXTS["BSL-1.0"].upper(), "BSL-1.0"),
    (8, "SPDX-FileCopyrightText: 2020 A\n" + HEADER, "Apache-2.0"),
    (9, "Copyright law is hard\n" + MIT, None),
    (10, "(c) You must retain this\n" + MIT, None),
    (11, MIT + " And more.", None),
    (12, "", None), (13, None, None), (None, "x", None), (14, "Copyright", None), (15, "#\n\n\t\r\n", None),
    (16, "Copyright\nCopyright notice\nCopyright, patent\ncopyright  <holder>\ncopyrighted 2020\ncopyright2020 x\n(c)2020 y", None),
    (17, "licence licence licenced sub licence per cent cent non commercial per cent", None),
    (17, "licence licence licenced sub licence per cent cent non commercial per cent", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    wide = [(20 + w, "Copyright 2020 A\n\n" + wrap(TEXTS[i], w), i) for i in TEXTS for w in range(12, 90, 9)]
    rows = CASES + [(100 * n + r[0], r[1], r[2]) for n, r in enumerate(wide)]
    rows += [(5000, "Some code.\n\n" + MIT + "\n\nMore code.\n\n" + wrap(HEADER, 70, "# ") + "\n\nEnd.", None),
             (5001, "para\n\n" * 3000 + MIT, None), (5002, "w" * 300_000, None), (5003, "word " * 60_000, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, want string")


def test_copyright_lines_wrapping_and_new_texts(docs):
    rows, df = docs
    got = {}
    for r in licences.scan(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, _, want in rows:
        assert {r.license_id for r in got[i]} == {want}, i
    assert got[5000][0].notices == "Apache-2.0,MIT" and got[5000][0].n_notices == 2
    assert got[5001][0].notices == "MIT"


def test_equals_the_sql(docs):
    rows, df = docs
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    names = ["doc_id", "digest", "license_id", "notices", "n_notices"]
    got = licences.scan(df.withColumnRenamed("want", "digest")).select(names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(licences.oracle_sql()).fetchall()))


def test_own_table_and_no_row_doubles(spark):
    texts = spark.createDataFrame([("A", "One two."), ("B", "one  TWO"), ("B", None), (None, "three"), ("C", "three\nfour")],
                                  "license_id string, text string")
    docs = spark.createDataFrame([(1, "one two"), (2, "x\n\none two\n\ny"), (2, "three"), (None, "three\n\nfour")],
                                 "doc_id long, text string")
    got = licences.scan(docs, table=licences.digests(texts)).collect()
    assert sorted((r.doc_id or 0, r.license_id or "", r.notices, r.n_notices) for r in got) == [
        (0, "C", "C", 1), (1, "A OR B", "A OR B", 1), (2, "", "", 0), (2, "", "A OR B", 1)]
    assert licences.scan(docs.limit(0)).count() == 0
    doubled = licences.digests(texts.where("license_id = 'A'")).unionByName(licences.digests(texts.where("license_id = 'B'")))
    assert licences.scan(docs, table=doubled).count() == 4
