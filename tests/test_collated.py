import pytest
from pyspark.sql import functions as F

from quillsync.operators import matching, store
from quillsync.plans import incremental
from quillsync.plans.sync import SyncConfig, cleanup_ids
from quillsync.sources import listing

C = matching.CASELESS
STORE = "id string, title string, content string, created_at timestamp, updated_at timestamp"


@pytest.fixture
def held(spark):
    rows = [("1", "Report", "a", "2024-01-02"), ("2", "REPORT", "b", "2024-01-01"), ("3", "straße", "c", "2024-01-01"),
            ("4", "Éclair", "d", None), ("5", None, "e", "2024-01-01")]
    return spark.createDataFrame(rows, "id string, title string, content string, t string").select(
        "id", "title", "content", F.to_timestamp("t").alias("created_at"), F.to_timestamp("t").alias("updated_at"))


def test_match_keeps_the_stored_spelling(spark, held):
    src = spark.createDataFrame([("rePort", "b"), ("ÉCLAIR", "x"), ("Other", "y"), ("eclair", "z"), (None, "n"),
                                 ("report", "q")], "title string, content string")
    got = sorted((r.title or "", r.id or "", r.content, r.status)
                 for r in matching.match_documents(src, held, C).collect())
    assert got == [("", "", "n", "new"), ("Other", "", "y", "new"), ("REPORT", "2", "b", "same"),
                   ("REPORT", "2", "q", "changed"), ("eclair", "", "z", "new"), ("Éclair", "4", "x", "changed")]
    assert {r.title for r in matching.new_documents(src, held, C).collect()} == {"Other", "eclair", None}
    assert {r.content for r in matching.changed_documents(src, held, C).collect()} == {"q", "x"}
    # byte by byte, nothing matches
    assert {r.status for r in matching.match_documents(src, held).collect()} == {"new"}


def test_lookups_and_cleanup(spark, held):
    assert [r.id for r in store.document_by_title(held, "rEPORT", C).collect()] == ["2"]
    got = store.documents_by_titles(held, ["report", "Report", "none", "STRASSE"], C).select("title", "id").collect()
    assert sorted((r.title, r.id or "") for r in got) == [("Report", "2"), ("STRASSE", ""), ("none", ""), ("report", "2")]
    assert sorted(r.id for r in store.ids_by_titles(held, ["report"], C).collect()) == ["1", "2"]
    assert sorted(r.id for r in cleanup_ids(held, ["RePort.docx", "éclair.docx"], C).collect()) == ["1", "2", "4"]
    assert cleanup_ids(held, ["report.docx"]).count() == 0
    empty = held.limit(0)
    assert store.documents_by_titles(empty, ["x"], C).select("id").collect()[0].id is None
    assert matching.first_match(empty, C).count() == 0


def test_names_that_differ_in_case_land_on_one_file(spark):
    files = spark.createDataFrame(
        [("f1", "Plan.docx", listing.DOCUMENT_MIME_TYPES[0], 1, "old"), ("f2", "PLAN.docx", listing.DOCUMENT_MIME_TYPES[0], 2, "new"),
         ("f3", "plan.b.docx", listing.DOCUMENT_MIME_TYPES[0], 3, "other")],
        "file_id string, name string, mime_type string, position long, content string")
    got = {(r.landed_name, r.content) for r in listing.fetch(files, all=True, collation=C).collect()}
    assert got == {("PLAN.docx", "new"), ("plan.b.docx", "other")}
    assert listing.fetch(files, all=True).count() == 3
    assert listing.fetch(files, ["pLAN"], collation=C).count() == 1
    assert listing.fetch(files, ["pLAN"]).count() == 0


def test_bucketed_stores_refuse_a_collation(spark, scratch):
    stores = incremental.open_stores(spark, scratch)
    with pytest.raises(ValueError, match="collation"):
        incremental.sync(stores, spark.range(0), cfg=SyncConfig(collation=C))


def test_the_plan_joins_on_the_collated_key(spark, held):
    src = spark.createDataFrame([("rePort", "b")], "title string, content string")
    plan = matching.match_documents(src, held, C)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
