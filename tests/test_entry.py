import os

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
# a representative slice of the catalog, compared with its SQL twin at sf0.001
FAST = ["make_chunks", "match_documents", "reconcile_stores", "vector_upsert", "cleanup",
        "similarity_topk", "retrieve_context", "sync_report", "docx_extract",
        "embedding_rejects", "delete_vectors_namespaced", "retrieve_stale_context", "stream_match",
        "collated_match", "collated_sync"]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "document_id", "chunk_index", "content", "token_count"]


def test_every_query_has_an_oracle_or_is_listed():
    q, s = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 58


def _duck(sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(sql)
    return [d[0] for d in rel.description], rel.fetchall()


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql_twin(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    cols, rows = _duck(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(cols, rows)


def test_python_worker_queries_run_from_any_directory(tmp_path):
    """Workers import the package from the shipped zip, not from the cwd."""
    import subprocess
    import sys
    code = (
        "import importlib.util\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "spec = importlib.util.spec_from_file_location('e', %r)\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "print('ROWS', m.queries()['docx_extract'](s, %r).count())\n"
    ) % (os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py"), SF)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS 200" in out.stdout, out.stderr[-2000:]
