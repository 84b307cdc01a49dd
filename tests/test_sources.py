import os

import pytest
from pyspark.sql import functions as F

from quillsync.schemas import DOCX_MIME, GDOC_MIME
from quillsync.sources import docx, listing, rejects


def _manifest(spark):
    return spark.createDataFrame([
        ("1", "a.docx", DOCX_MIME, 1, "A"),
        ("2", "a", GDOC_MIME, 2, "A2"),
        ("3", "b.docx", DOCX_MIME, 3, "B"),
        ("4", "c.pdf", "application/pdf", 4, "C"),
    ], "file_id string, name string, mime_type string, position long, content string")


def test_listing_and_selection(spark):
    m = _manifest(spark)
    assert sorted(r.file_id for r in listing.list_source(m).collect()) == ["1", "2", "3"]
    files = listing.list_source(m)
    assert listing.select_files(files, None, all=True).count() == 3
    assert listing.select_files(files, [], all=False).count() == 0
    assert listing.select_files(files, None, all=False).count() == 0
    by_title = sorted(r.file_id for r in listing.select_files(files, ["a"], all=False).collect())
    assert by_title == ["1", "2"]
    raw = sorted(r.file_id for r in listing.select_files(files, ["a"], all=False, match="raw").collect())
    assert raw == ["2"]


def test_land_names_last_write_wins(spark):
    landed = listing.fetch(_manifest(spark), all=True)
    got = {r.landed_name: r.file_id for r in landed.collect()}
    assert got == {"a.docx": "2", "b.docx": "3"}
    assert listing.filter_requested(landed, []).count() == 2
    assert [r.file_id for r in listing.filter_requested(landed, ["b.docx"]).collect()] == ["3"]


def test_docx_round_trip_and_blank_paragraphs(spark):
    docs = spark.createDataFrame([("x.docx", "first line\n   \nsecond <&> line\n"), ("y.docx", "\n\n")],
                                 "name string, content string")
    ok, bad = docx.extract_docx(docx.to_docx(docs))
    got = {r.name: r.content for r in ok.collect()}
    assert got == {"x.docx": "first line\nsecond <&> line", "y.docx": ""}
    assert bad.count() == 0


def test_binary_folder_scan(spark, scratch):
    folder = os.path.join(scratch, "landing")
    os.makedirs(folder)
    for name, text in [("one.docx", "Hello.\nWorld."), ("two.docx", "Two"), ("skip.txt", "x")]:
        with open(os.path.join(folder, name), "wb") as f:
            f.write(docx._build_docx(text.split("\n")) if name.endswith(".docx") else b"x")
    files = listing.scan_folder(spark, folder)
    assert sorted(r.name for r in files.select("name").collect()) == ["one.docx", "two.docx"]
    ok, _ = docx.extract_docx(files)
    assert {r.name: r.content for r in ok.collect()} == {"one.docx": "Hello.\nWorld.", "two.docx": "Two"}


def test_unreadable_file_raises_or_rejects(spark, scratch):
    bad_files = spark.createDataFrame([("bad.docx", bytearray(b"not a zip"))], "name string, content binary")
    with pytest.raises(Exception):
        docx.extract_docx(bad_files)[0].collect()
    ok, bad = docx.extract_docx(bad_files, on_error="reject")
    assert ok.count() == 0
    path = os.path.join(scratch, "errors")
    rejects.write_rejects(bad, path)
    rejects.write_rejects(bad, path)
    back = rejects.read_rejects(spark, path).collect()
    assert len(back) == 2 and back[0].filename == "bad.docx"
    assert back[0].error == "BadZipFile: File is not a zip file"


def test_paragraph_text_rules(spark):
    import io
    import zipfile
    W = docx.W_NS
    body = (
        '<w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/><w:t>c</w:t><w:noBreakHyphen/></w:r>'
        '<w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink>'
        '<w:ins><w:r><w:t>tracked</w:t></w:r></w:ins>'
        '<w:r><w:br w:type="page"/><w:t>d</w:t></w:r></w:p>'
        '<w:tbl><w:tr><w:tc><w:p><w:r><w:t>in table</w:t></w:r></w:p></w:tc></w:tr></w:tbl>'
        '<w:p><w:r><w:t xml:space="preserve">  </w:t></w:r></w:p>'
        '<w:p><w:r><w:t>last</w:t></w:r></w:p>')
    xml = f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr(docx.DOCUMENT_PART, xml)
    assert docx._paragraph_texts(buf.getvalue()) == ["a\tb\nc-linkd", "  ", "last"]
    files = spark.createDataFrame([("x.docx", bytearray(buf.getvalue()))], "name string, content binary")
    ok, _ = docx.extract_docx(files)
    assert ok.first().content == "a\tb\nc-linkd\nlast"
