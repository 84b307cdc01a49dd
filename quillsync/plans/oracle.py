"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

Written independently of the Spark plans: the packing is a recursive CTE
over split points (not the per-sentence state machine the Spark side
runs), prefix sums come from a window, the ids from ``md5``.  Only the fixed
values (patterns, constants) are shared.
"""

from __future__ import annotations

from quillsync.functions.text import (
    NON_SPACE_CLASS, SENTENCE_END, SPACE_CODE_POINTS, TITLE_PATTERN, TOKEN_PATTERN)
from quillsync.operators.chunking import MAX_TOKENS, OVERLAP_TOKENS
from quillsync.operators.embed import EMBED_DIM
from quillsync.plans import catalog as cat
from quillsync.plans import fixtures as fx
from quillsync.schemas import DEFAULT_NAMESPACE, DOCX_MIME, GDOC_MIME

SQL: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sid(*exprs: str) -> str:
    """The stable id: md5 of the '|'-joined parts ('|' and backslash escaped), as 8-4-4-4-12."""
    parts = ", ".join(rf"replace(replace(coalesce(CAST({e} AS VARCHAR), ''), '\', '\\'), '|', '\|')" for e in exprs)
    h = f"md5(concat_ws('|', {parts}))"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4)"
            f" || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


def doc_id_of(title: str) -> str:
    return sid("'document'", title)


def title_of(name: str) -> str:
    return f"regexp_replace({name}, {lit(TITLE_PATTERN)}, '\\1')"


def non_blank(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {lit(NON_SPACE_CLASS)}), false)"


SPACE_CHARS_SQL = " || ".join(f"chr({c})" for c in SPACE_CODE_POINTS)


def sents(x: str) -> str:
    body = f"trim(replace({x}, chr(1), ''), {SPACE_CHARS_SQL})"
    marked = f"regexp_replace({body}, {lit(SENTENCE_END)}, '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s_: s_ <> '')"


def ntok(x: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(TOKEN_PATTERN)}))"


def doc_title(a: str = "") -> str:
    p = f"{a}." if a else ""
    return f"({p}source || '-' || CAST({p}doc_id AS VARCHAR))"


# --- fixture CTEs ---------------------------------------------------------------

MANIFEST = f"""manifest AS (
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS file_id, {doc_title()} || '.docx' AS name,
         CASE WHEN lang = 'en' THEN {lit(GDOC_MIME)} ELSE {lit(DOCX_MIME)} END AS mime_type,
         doc_id AS position, text AS content
  FROM documents
  UNION ALL
  SELECT 'page-' || CAST(page_id AS VARCHAR), regexp_extract(url, '^[a-z]+://([^/?#]+)', 1),
         {lit(fx.HTML_MIME)}, page_id, html
  FROM pages)"""

LISTED = f"""listed AS (SELECT * FROM manifest
  WHERE mime_type IN ({lit(DOCX_MIME)}, {lit(GDOC_MIME)}))"""

SRC = f"src AS (SELECT {doc_title()} AS title, text AS content, doc_id FROM documents)"

LABELLED = """labelled AS (SELECT d.doc_id, d.source, d.text, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

# the same with all documents: those without labels are neither edited nor toxic
ALL_LABELLED = LABELLED.replace("JOIN labels", "LEFT JOIN labels")

STORE = f"""store AS (
  SELECT {doc_id_of(doc_title())} AS id, {doc_title()} AS title,
         CASE WHEN quality = 0 THEN text || {lit(fx.OLD_SUFFIX)} ELSE text END AS content,
         to_timestamp({fx.EPOCH_2024} + doc_id) AS created_at, doc_id, quality, toxic
  FROM labelled)"""

REQUESTED = f"requested AS (SELECT {doc_title()} AS title FROM labelled WHERE quality = 1)"
CLEANUP_NAMES = f"cleanup_names AS (SELECT {doc_title()} || '.docx' AS name FROM labelled WHERE toxic = 1)"

MATCHED = """matched AS (
  SELECT s.title, st.id, s.content, st.content AS stored_content,
         CASE WHEN st.id IS NULL THEN 'new'
              WHEN s.content IS NOT DISTINCT FROM st.content THEN 'same'
              ELSE 'changed' END AS status
  FROM src s LEFT JOIN store st ON s.title = st.title)"""

MAPPED = f"""mapped AS (
  SELECT coalesce(id, {doc_id_of('title')}) AS id, title, content, status FROM matched)"""


def chunk_ctes(p: str, docs: str, mx: int = MAX_TOKENS, ov: int = OVERLAP_TOKENS) -> str:
    """CTEs ending in ``{p}`` = (document_id, chunk_index, first_sentence,
    last_sentence, content, token_count) for ``docs`` (id, content).

    Recursion over split points: from chunk start ``s`` after split ``x``, the
    next split is the first sentence ``y > x`` whose prefix sum from ``s``
    exceeds the maximum; the next start is the last ``j`` whose tail sum up
    to ``y`` reaches the overlap.  ``pre[k + 1]`` is the sum of the first ``k``.
    """
    if ov > 0:
        new_s = (f"CASE WHEN q.nx > q.s THEN coalesce(list_max(list_filter(range(q.s, q.nx), "
                 f"lambda j: q.pre[q.nx + 1] - q.pre[j + 1] >= {ov})), q.s) ELSE q.s END")
    else:
        new_s = "q.nx"
    return f"""{p}_s AS (SELECT id AS document_id, {sents('content')} AS sents FROM {docs}),
{p}_t AS (SELECT document_id, sents, list_transform(sents, lambda x: {ntok('x')}) AS t,
             len(sents) AS n FROM {p}_s WHERE len(sents) > 0),
{p}_u AS (SELECT document_id, unnest(t) AS tk, unnest(range(len(t))) AS pos FROM {p}_t),
{p}_c AS (SELECT document_id, list(cum ORDER BY pos) AS cums FROM (
             SELECT document_id, pos, sum(tk) OVER (PARTITION BY document_id ORDER BY pos) AS cum
             FROM {p}_u) GROUP BY document_id),
{p}_b AS (SELECT t.document_id, t.sents, t.n, [0] || c.cums AS pre
          FROM {p}_t t JOIN {p}_c c ON t.document_id = c.document_id),
{p}_r(document_id, s, x, cs, ce) AS (
  SELECT document_id, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM {p}_b
  UNION ALL
  SELECT q.document_id, {new_s}, q.nx,
         CASE WHEN q.nx > q.s THEN q.s END, CASE WHEN q.nx > q.s THEN q.nx - 1 END
  FROM (SELECT r.document_id, r.s, b.pre,
               list_min(list_filter(range(r.x + 1, b.n),
                        lambda y: b.pre[y + 2] - b.pre[r.s + 1] > {mx})) AS nx
        FROM {p}_r r JOIN {p}_b b ON r.document_id = b.document_id) q
  WHERE q.nx IS NOT NULL),
{p}_k AS (
  SELECT document_id, cs, ce FROM {p}_r WHERE cs IS NOT NULL
  UNION ALL
  SELECT l.document_id, l.s, b.n - 1 FROM (
     SELECT document_id, arg_max(s, x) AS s FROM {p}_r GROUP BY document_id) l
  JOIN {p}_b b ON l.document_id = b.document_id),
{p}_x AS (SELECT k.document_id, row_number() OVER (PARTITION BY k.document_id ORDER BY k.ce) - 1
                 AS chunk_index, k.cs, k.ce,
                 array_to_string(b.sents[k.cs + 1 : k.ce + 1], ' ') AS content
          FROM {p}_k k JOIN {p}_b b ON k.document_id = b.document_id),
{p} AS (SELECT document_id, chunk_index, cs AS first_sentence, ce AS last_sentence, content,
               {ntok('content')} AS token_count FROM {p}_x)"""


def chunk_store_ctes(p: str, docs: str) -> str:
    """Chunks of ``docs`` with their stored ids: (id, document_id, chunk_index, content, token_count)."""
    return chunk_ctes(f"{p}_raw", docs) + f""",
{p} AS (SELECT {sid('document_id', 'chunk_index', 'content')} AS id, document_id, chunk_index,
               content, token_count FROM {p}_raw)"""


def embed_ctes(p: str, rows: str, text: str = "content", dim: int = EMBED_DIM) -> str:
    """``rows`` + ``vals`` (FLOAT[]) by md5 feature hashing; null when no token."""
    return f"""{p}_b AS (SELECT *, list_transform(regexp_extract_all({text}, {lit(TOKEN_PATTERN)}),
             lambda t: ('0x' || substr(md5(t), 1, 8))::BIGINT % {dim}) AS bs_ FROM {rows}),
{p}_c AS (SELECT *, list_transform(range({dim}), lambda b: len(list_filter(bs_, lambda y: y = b))) AS cs_
          FROM {p}_b),
{p}_n AS (SELECT *, sqrt(list_sum(list_transform(cs_, lambda c: c * c))) AS nrm_ FROM {p}_c),
{p} AS (SELECT * EXCLUDE (bs_, cs_, nrm_),
               CASE WHEN nrm_ > 0 THEN list_transform(cs_, lambda c: CAST(c / nrm_ AS FLOAT)) END AS vals
        FROM {p}_n)"""


STORE_DOCS = "store_docs AS (SELECT id, content FROM store)"
CHUNK_STORE = chunk_store_ctes("chunk_store", "store_docs")
CURRENT = f"""current_docs AS (SELECT {doc_id_of(doc_title())} AS id, text AS content
  FROM labelled WHERE toxic = 0)"""
CURRENT_ALL = CURRENT.replace(" WHERE toxic = 0", "")
VECTOR_STORE = chunk_store_ctes("vec_chunks", "current_docs") + ",\n" + embed_ctes(
    "vec_emb", "vec_chunks") + f""",
vector_store AS (SELECT {lit(DEFAULT_NAMESPACE)} AS namespace, id, vals, document_id,
                        chunk_index, token_count FROM vec_emb WHERE vals IS NOT NULL)"""
EMBEDDED_STORE = embed_ctes("store_emb", "chunk_store")
STORE_VECTORS = f"""store_vectors AS (SELECT {lit(DEFAULT_NAMESPACE)} AS namespace, id, vals,
  document_id, chunk_index, token_count FROM store_emb WHERE vals IS NOT NULL)"""
LABELLED_VECTORS = f"""labelled_vectors AS (
  SELECT {lit(fx.LABELLED_NS)} AS namespace, 'vec-' || CAST(vec_id AS VARCHAR) AS id,
         CAST(embedding AS FLOAT[]) AS vals, 'label-' || CAST(label AS VARCHAR) AS document_id,
         vec_id AS chunk_index, len(embedding) AS token_count
  FROM embeddings)"""
CLEANUP_IDS = f"""cleanup_ids AS (SELECT id FROM store
  WHERE title IN (SELECT {title_of('name')} FROM cleanup_names))"""
REQUESTED_IDS = "requested_ids AS (SELECT id FROM store WHERE title IN (SELECT title FROM requested))"
SRC_DOCS = "src_docs AS (SELECT doc_id AS id, text AS content FROM documents)"
MAPPED_DOCS = "mapped_docs AS (SELECT id, content FROM mapped)"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def reg(name: str, sql: str) -> None:
    SQL[name] = sql


# --- scalar ---------------------------------------------------------------------
reg("title_from_name", with_(MANIFEST) + f"SELECT file_id, name, {title_of('name')} AS title FROM manifest")
reg("docx_name", with_(MANIFEST) + f"SELECT file_id, {title_of('name')} || '.docx' AS landed_name FROM manifest")
reg("is_blank", f"""SELECT doc_id, NOT {non_blank('text')} AS blank,
  len(list_filter(string_split(text, chr(10)), lambda l: NOT {non_blank('l')})) AS blank_lines
  FROM documents""")
reg("split_sentences", f"""SELECT doc_id, len(s) AS n_sentences, md5(array_to_string(s, chr(2))) AS sentences_md5
  FROM (SELECT doc_id, {sents('text')} AS s FROM documents)""")
reg("count_tokens", f"SELECT doc_id, {ntok('text')} AS n_tokens FROM documents")
reg("new_id", with_(SRC) + f"SELECT doc_id, {doc_id_of('title')} AS id FROM src")

# --- listing, selection, filters ------------------------------------------------
reg("source_listing", with_(MANIFEST, LISTED) + "SELECT file_id, name, mime_type FROM listed")
reg("select_files", with_(MANIFEST, LISTED, LABELLED, REQUESTED) + f"""SELECT file_id, name FROM listed
  WHERE {title_of('name')} IN (SELECT title FROM requested)""")
reg("select_files_raw", with_(MANIFEST, LISTED, LABELLED, REQUESTED) + """SELECT file_id, name FROM listed
  WHERE name IN (SELECT title || '.docx' FROM requested)""")
LANDED_REQ = f"""landed AS (
  SELECT {title_of('name')} || '.docx' AS landed_name,
         arg_min(file_id, (-position, file_id)) AS file_id
  FROM listed WHERE {title_of('name')} IN (SELECT title FROM requested) GROUP BY 1)"""
reg("fetch_documents", with_(MANIFEST, LISTED, LABELLED, REQUESTED, LANDED_REQ)
    + "SELECT landed_name, file_id FROM landed")
reg("last_write_wins", f"""SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '.docx' AS landed_name,
  arg_min('turn-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR),
          (-turn, 'turn-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR))) AS file_id,
  max(turn) AS position
  FROM conversations GROUP BY conv_id""")
LANDED_ALL = f"""landed_all AS (
  SELECT {title_of('name')} || '.docx' AS landed_name,
         arg_min(file_id, (-position, file_id)) AS file_id
  FROM listed GROUP BY 1)"""
reg("filter_requested", with_(MANIFEST, LISTED, LABELLED, REQUESTED, LANDED_ALL)
    + """SELECT landed_name, file_id FROM landed_all
  WHERE landed_name IN (SELECT title || '.docx' FROM requested)""")
reg("filter_blank_documents", f"""SELECT doc_id, line_no FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)
  WHERE {non_blank('line')}""")
reg("filter_blank_paragraphs", f"""SELECT doc_id, len(p) AS n_paragraphs, md5(array_to_string(p, chr(10))) AS text_md5
  FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: {non_blank('l')}) AS p FROM documents)""")
reg("table_schemas", with_(LABELLED, STORE) + "SELECT id, title, content FROM store")

# --- matching -------------------------------------------------------------------
reg("match_documents", with_(SRC, LABELLED, STORE, MATCHED) + "SELECT title, id, status FROM matched")
reg("new_documents", with_(SRC, LABELLED, STORE, MATCHED) + "SELECT title FROM matched WHERE status = 'new'")
reg("changed_documents", with_(SRC, LABELLED, STORE, MATCHED)
    + "SELECT id, title FROM matched WHERE status = 'changed'")
reg("union_mapped", with_(SRC, LABELLED, STORE, MATCHED, MAPPED) + "SELECT id, title, status FROM mapped")
reg("first_match", f"""SELECT title, arg_min(id, (created_at, id)) AS id FROM (
  SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS title,
         {doc_id_of("'conv-' || CAST(conv_id AS VARCHAR) || '#' || CAST(turn AS VARCHAR)")} AS id,
         {fx.EPOCH_2024} + floor(turn / 2) * 60 AS created_at
  FROM conversations) GROUP BY title""")
reg("read_document_by_title", with_(LABELLED, STORE, REQUESTED) + """SELECT r.title, st.id
  FROM (SELECT DISTINCT title FROM requested) r
  LEFT JOIN (SELECT title, arg_min(id, (created_at, id)) AS id FROM store GROUP BY title) st
  ON r.title = st.title""")
reg("read_ids_by_titles", with_(LABELLED, STORE, REQUESTED, REQUESTED_IDS) + "SELECT id FROM requested_ids")

# --- titles under a collation ---------------------------------------------------------
SHOUTED = f"CASE WHEN lang = 'en' THEN upper{doc_title()} ELSE {doc_title()} END"
reg("collated_match", with_(LABELLED, STORE) + f"""SELECT coalesce(st.title, s.title) AS title, st.id,
    CASE WHEN st.id IS NULL THEN 'new' WHEN s.content IS NOT DISTINCT FROM st.content THEN 'same' ELSE 'changed' END
    AS status
  FROM (SELECT {SHOUTED} AS title, text AS content FROM documents) s
  LEFT JOIN store st ON lower(s.title) = lower(st.title)""")
reg("collated_first_match", f"""WITH t AS (
  SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS title,
         {doc_id_of("'conv-' || CAST(conv_id AS VARCHAR) || '#' || CAST(turn AS VARCHAR)")} AS id,
         {fx.EPOCH_2024} + floor(turn / 2) * 60 AS created_at
  FROM conversations)
  SELECT first.title, first.id FROM (SELECT arg_min({{'title': CASE WHEN id < '8' THEN upper(title) ELSE title END, 'id': id}}, (created_at, id)) AS first FROM t
                                     GROUP BY lower(title))""")
reg("collated_lookup", with_(LABELLED, STORE, REQUESTED) + """SELECT r.title, st.id
  FROM (SELECT title FROM requested UNION SELECT upper(title) FROM requested) r
  LEFT JOIN (SELECT lower(title) AS k, arg_min(id, (created_at, id)) AS id FROM store GROUP BY 1) st
  ON lower(r.title) = st.k""")
reg("collated_sync", with_(LABELLED, STORE) + f"""SELECT coalesce(st.id, {doc_id_of('s.title')}) AS id,
    coalesce(st.title, s.title) AS title, md5(s.content) AS content_md5
  FROM (SELECT {SHOUTED} AS title, CASE WHEN lang = 'en' THEN text || ' Again.' ELSE text END AS content
        FROM documents) s
  LEFT JOIN store st ON lower(s.title) = lower(st.title)""")

# --- chunking -------------------------------------------------------------------
reg("pack_chunks", with_(SRC_DOCS, chunk_ctes("ch", "src_docs"))
    + "SELECT document_id, chunk_index, first_sentence, last_sentence FROM ch")
reg("make_chunks", with_(SRC_DOCS, chunk_ctes("ch", "src_docs"))
    + "SELECT document_id, chunk_index, content, token_count FROM ch")
reg("chunk_index", with_(SRC_DOCS, chunk_ctes("ch", "src_docs", cat.SMALL_MAX, cat.SMALL_OVERLAP))
    + "SELECT document_id, chunk_index, token_count FROM ch")
reg("project_chunk", with_(ALL_LABELLED, STORE, STORE_DOCS, chunk_ctes("ch", "store_docs"))
    + "SELECT document_id, chunk_index, content, token_count FROM ch")
reg("chunks_per_document", with_(ALL_LABELLED, STORE, STORE_DOCS, CHUNK_STORE)
    + "SELECT document_id, count(*) AS chunks FROM chunk_store GROUP BY document_id")
reg("process_documents", with_(SRC, LABELLED, STORE, MATCHED, MAPPED, MAPPED_DOCS,
                               chunk_ctes("ch", "mapped_docs"))
    + "SELECT document_id, chunk_index, content, token_count FROM ch")

# --- stores ---------------------------------------------------------------------
NEW_CHUNKS = chunk_store_ctes("new_chunks", "mapped_docs")
reg("insert_documents", with_(SRC, LABELLED, STORE, MATCHED) + f"""SELECT id, title, content FROM store
  UNION ALL SELECT {doc_id_of('title')}, title, content FROM matched WHERE status = 'new'""")
reg("insert_chunks", with_(SRC, LABELLED, STORE, MATCHED, MAPPED, MAPPED_DOCS, NEW_CHUNKS)
    + "SELECT id, document_id, chunk_index, token_count FROM new_chunks")
APPEND_CHUNKS = chunk_ctes("app_raw", "mapped_docs") + f""",
app AS (SELECT {sid('document_id', 'chunk_index', 'content', "'run-1'")} AS id, document_id, chunk_index
        FROM app_raw)"""
reg("append_mode", with_(SRC, LABELLED, STORE, MATCHED, MAPPED, MAPPED_DOCS, STORE_DOCS, CHUNK_STORE,
                         APPEND_CHUNKS)
    + "SELECT id, document_id, chunk_index FROM chunk_store UNION ALL SELECT id, document_id, chunk_index FROM app")
reg("replace_mode", with_(SRC, LABELLED, STORE, MATCHED, MAPPED, MAPPED_DOCS, STORE_DOCS, CHUNK_STORE,
                          NEW_CHUNKS)
    + """SELECT id, document_id, chunk_index FROM chunk_store
  WHERE document_id NOT IN (SELECT DISTINCT document_id FROM new_chunks)
  UNION ALL SELECT id, document_id, chunk_index FROM new_chunks""")
reg("read_chunks_by_document", with_(LABELLED, STORE, REQUESTED, REQUESTED_IDS, STORE_DOCS, CHUNK_STORE)
    + "SELECT document_id, chunk_index, id FROM chunk_store WHERE document_id IN (SELECT id FROM requested_ids)")
reg("order_chunks", with_(ALL_LABELLED, STORE, STORE_DOCS, CHUNK_STORE)
    + """SELECT document_id, chunk_index,
  lag(chunk_index) OVER (PARTITION BY document_id ORDER BY chunk_index) AS prev_index FROM chunk_store""")

# --- embeddings and vectors ------------------------------------------------------
EMB_BASE = (ALL_LABELLED, STORE, STORE_DOCS, CHUNK_STORE, EMBEDDED_STORE)
reg("embed_chunks", with_(*EMB_BASE) + """SELECT id, len(vals) AS dims,
  round(list_sum(list_transform(vals, lambda v: CAST(v AS DOUBLE))), 6) AS value_sum,
  round(CAST(list_max(vals) AS DOUBLE), 6) AS value_max
  FROM store_emb WHERE vals IS NOT NULL""")
reg("drop_failed_embeddings", with_(*EMB_BASE) + """SELECT 'embedded' AS metric, count(*) AS value
  FROM store_emb WHERE vals IS NOT NULL
  UNION ALL SELECT 'failed', count(*) FROM store_emb WHERE vals IS NULL""")
reg("embedding_rejects", with_(ALL_LABELLED, STORE, STORE_DOCS, CHUNK_STORE) + """SELECT document_id AS filename,
  'no_embedding [doc=' || document_id || ' | chunk=' || id || ']' AS error
  FROM chunk_store WHERE substr(md5(content), 1, 1) = '0'""")
reg("validate_vectors", with_(*EMB_BASE) + """SELECT 'valid' AS metric, count(*) AS value FROM store_emb
  WHERE vals IS NOT NULL AND len(vals) > 0 AND id IS NOT NULL AND id <> ''
  UNION ALL SELECT 'rejected', count(*) FROM store_emb
  WHERE vals IS NULL OR len(vals) = 0 OR id IS NULL OR id = ''""")
VEC_BASE = (LABELLED, CURRENT, VECTOR_STORE)
reg("project_metadata", with_(ALL_LABELLED, CURRENT_ALL, VECTOR_STORE) + "SELECT id, document_id, chunk_index, token_count FROM vector_store")
UPSERTED = """upserted AS (
  SELECT v.namespace, v.id, v.document_id, v.chunk_index FROM vector_store v
  ANTI JOIN store_vectors s ON v.namespace = s.namespace AND v.id = s.id
  UNION ALL SELECT namespace, id, document_id, chunk_index FROM store_vectors)"""
reg("vector_upsert", with_(*VEC_BASE, STORE, STORE_DOCS, CHUNK_STORE, EMBEDDED_STORE, STORE_VECTORS,
                           UPSERTED)
    + "SELECT namespace, id, document_id, chunk_index FROM upserted")
reg("vector_sync", with_(ALL_LABELLED, CURRENT, VECTOR_STORE, STORE, STORE_DOCS, CHUNK_STORE, EMBEDDED_STORE, STORE_VECTORS,
                         UPSERTED)
    + """SELECT 'upserted' AS metric, count(*) AS value FROM store_vectors
  UNION ALL SELECT 'rejected', count(*) FROM store_emb WHERE vals IS NULL
  UNION ALL SELECT 'store_size', count(*) FROM upserted""")
reg("vector_fetch", with_(*VEC_BASE, STORE, REQUESTED, REQUESTED_IDS) + """SELECT id, document_id
  FROM vector_store WHERE document_id IN (SELECT id FROM requested_ids)""")
reg("limit_vectors", with_(LABELLED_VECTORS) + f"""SELECT id, document_id FROM (
  SELECT id, document_id, row_number() OVER (PARTITION BY document_id ORDER BY id) AS rn
  FROM labelled_vectors) WHERE rn <= {cat.FETCH_PER_LABEL}""")
reg("vector_clear", with_(*VEC_BASE, LABELLED_VECTORS) + f"""SELECT namespace, id FROM (
  SELECT namespace, id FROM vector_store UNION ALL SELECT namespace, id FROM labelled_vectors)
  WHERE namespace <> {lit(DEFAULT_NAMESPACE)}""")

# --- cleanup ---------------------------------------------------------------------
CL_BASE = (LABELLED, STORE, CLEANUP_NAMES, CLEANUP_IDS)
reg("resolve_cleanup_ids", with_(*CL_BASE) + "SELECT id FROM cleanup_ids")
reg("delete_documents", with_(*CL_BASE) + "SELECT id FROM store WHERE id NOT IN (SELECT id FROM cleanup_ids)")
reg("cascade_delete", with_(*CL_BASE, STORE_DOCS, CHUNK_STORE)
    + "SELECT id, document_id FROM chunk_store WHERE document_id NOT IN (SELECT id FROM cleanup_ids)")
reg("delete_chunks", with_(SRC, LABELLED, STORE, MATCHED, STORE_DOCS, CHUNK_STORE)
    + "SELECT id FROM chunk_store WHERE document_id NOT IN (SELECT id FROM matched WHERE status = 'changed')")
reg("delete_vectors", with_(*CL_BASE, CURRENT, VECTOR_STORE)
    + "SELECT id FROM vector_store WHERE document_id NOT IN (SELECT id FROM cleanup_ids)")
reg("delete_vectors_namespaced", with_(*CL_BASE, CURRENT, VECTOR_STORE) + f"""
  SELECT namespace, id FROM vector_store
  UNION ALL SELECT {lit(fx.SECOND_NS)}, id FROM vector_store WHERE document_id NOT IN (SELECT id FROM cleanup_ids)""")
reg("delete_report", with_(*CL_BASE, STORE_DOCS, CHUNK_STORE, CURRENT, VECTOR_STORE) + """
  SELECT 'ids_found' AS metric, count(DISTINCT id) AS value FROM cleanup_ids
  UNION ALL SELECT 'documents_deleted', count(*) FROM store WHERE id IN (SELECT id FROM cleanup_ids)
  UNION ALL SELECT 'chunks_deleted', count(*) FROM chunk_store WHERE document_id IN (SELECT id FROM cleanup_ids)
  UNION ALL SELECT 'vectors_deleted', count(*) FROM vector_store WHERE document_id IN (SELECT id FROM cleanup_ids)""")
reg("cleanup", with_(*CL_BASE, STORE_DOCS, CHUNK_STORE, CURRENT, VECTOR_STORE) + """
  SELECT 'documents' AS store, id FROM store WHERE id NOT IN (SELECT id FROM cleanup_ids)
  UNION ALL SELECT 'chunks', id FROM chunk_store WHERE document_id NOT IN (SELECT id FROM cleanup_ids)
  UNION ALL SELECT 'vectors', id FROM vector_store WHERE document_id NOT IN (SELECT id FROM cleanup_ids)""")

SQL["collated_cleanup"] = SQL["cleanup"]

# --- audit -----------------------------------------------------------------------
reg("group_chunks_by_document", with_(*EMB_BASE) + """SELECT document_id, count(*) AS chunks,
  min(chunk_index) AS first_index, max(chunk_index) AS last_index, CAST(sum(token_count) AS BIGINT) AS tokens,
  max(chunk_index) - min(chunk_index) + 1 - count(*) AS index_gaps
  FROM store_emb WHERE vals IS NOT NULL GROUP BY document_id""")
reg("reconcile_stores", with_(LABELLED, STORE, STORE_DOCS, CHUNK_STORE, CURRENT, VECTOR_STORE) + """
  SELECT coalesce(c.id, v.id) AS id, coalesce(c.document_id, v.document_id) AS document_id,
         CASE WHEN c.id IS NULL THEN 'orphan_vector' WHEN v.id IS NULL THEN 'missing_vector' ELSE 'ok' END
           AS status
  FROM chunk_store c FULL OUTER JOIN vector_store v ON c.id = v.id""")
SYNC_BASE = (MANIFEST, LISTED, SRC, LABELLED, STORE, MATCHED, MAPPED, MAPPED_DOCS, NEW_CHUNKS)
reg("sync_report", with_(*SYNC_BASE) + """
  SELECT 'files_listed' AS metric, count(*) AS value FROM listed
  UNION ALL SELECT 'files_landed', count(DISTINCT name) FROM listed
  UNION ALL SELECT 'documents_mapped', count(*) FROM mapped
  UNION ALL SELECT 'documents_new', count(*) FROM mapped WHERE status = 'new'
  UNION ALL SELECT 'documents_changed', count(*) FROM mapped WHERE status = 'changed'
  UNION ALL SELECT 'documents_same', count(*) FROM mapped WHERE status = 'same'
  UNION ALL SELECT 'chunks', count(*) FROM new_chunks
  UNION ALL SELECT 'chunked_documents', count(DISTINCT document_id) FROM new_chunks
  UNION ALL SELECT 'chunk_tokens', CAST(sum(token_count) AS BIGINT) FROM new_chunks
  UNION ALL SELECT 'embedded_documents', count(DISTINCT document_id) FROM new_chunks
  UNION ALL SELECT 'vectors_upserted', count(*) FROM new_chunks
  UNION ALL SELECT 'rejects', 0""")
reg("sync_append", with_(SRC, LABELLED, STORE, MATCHED, MAPPED)
    + """SELECT id, title, md5(content) AS content_md5 FROM store
  UNION ALL SELECT id, title, md5(content) FROM mapped WHERE status = 'new'""")
reg("sync", with_(SRC, LABELLED, STORE, MATCHED, MAPPED)
    + "SELECT id, title, md5(content) AS content_md5 FROM mapped")

# --- retrieval -------------------------------------------------------------------
CENTROIDS = f"""cen AS (SELECT document_id AS query_id, i, avg(CAST(vals[i + 1] AS DOUBLE)) AS m
            FROM labelled_vectors, range({EMBED_DIM}) r(i) GROUP BY document_id, i),
  q AS (SELECT query_id, list(m ORDER BY i) AS qv FROM cen GROUP BY query_id),
  sc AS (SELECT q.query_id, v.id, round(list_inner_product(CAST(v.vals AS DOUBLE[]), q.qv), 6) AS score
         FROM q, labelled_vectors v)"""
TOP = f"""SELECT query_id, id, rank, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM sc)
  WHERE rank <= {cat.TOPK}"""


def vector_scores(where: str) -> str:
    """Scores of every row whose vec_id is divisible, against the rows that the condition leaves."""
    return f"""sc AS (SELECT q.id AS query_id, v.id,
      round(list_inner_product(CAST(v.vals AS DOUBLE[]), CAST(q.vals AS DOUBLE[])), 6) AS score
    FROM labelled_vectors q, labelled_vectors v WHERE q.chunk_index % {cat.QUERY_EVERY} = 0 AND {where})"""


reg("centroid_topk", with_(LABELLED_VECTORS, CENTROIDS) + TOP)
reg("similarity_topk", with_(LABELLED_VECTORS, vector_scores("true")) + TOP)
SQL["pruned_topk"] = SQL["similarity_topk"]
reg("filtered_topk", with_(LABELLED_VECTORS, vector_scores(
    "v.document_id IN ('label-1', 'label-3', 'label-8') AND (v.chunk_index < 200 OR v.chunk_index >= 300)")) + TOP)
BENCH_Q = embed_ctes("bq", "benchmark", text="text")
BENCH_SCORES = f"""sc AS (SELECT CAST(q.item_id AS VARCHAR) AS query_id, v.id,
    round(list_inner_product(CAST(v.vals AS DOUBLE[]), CAST(q.vals AS DOUBLE[])), 6) AS score
    FROM bq q, store_vectors v WHERE q.vals IS NOT NULL),
  top AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM sc)
    WHERE rank <= {cat.CONTEXT_K})"""
reg("retrieve_context", with_(*EMB_BASE, STORE_VECTORS, BENCH_Q, BENCH_SCORES) + """
  SELECT t.query_id, t.rank, t.score, t.id AS chunk_id, c.document_id, s.title, c.chunk_index
  FROM top t JOIN chunk_store c ON t.id = c.id LEFT JOIN store s ON c.document_id = s.id""")
reg("retrieve_stale_context", with_(ALL_LABELLED, STORE, STORE_DOCS, CHUNK_STORE, CURRENT_ALL, VECTOR_STORE, BENCH_Q,
                                    BENCH_SCORES.replace("store_vectors v", "vector_store v")) + """
  SELECT t.query_id, t.rank, t.id AS chunk_id, c.id IS NULL AS stale
  FROM top t LEFT JOIN chunk_store c ON t.id = c.id""")
reg("search_documents", f"""WITH terms AS (
    SELECT DISTINCT unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')) AS term FROM benchmark),
  toks AS (SELECT doc_id, unnest(regexp_extract_all(text, {lit(TOKEN_PATTERN)})) AS term FROM documents),
  hits AS (SELECT doc_id, term, count(*) AS hits FROM toks WHERE term IN (SELECT term FROM terms)
           GROUP BY doc_id, term)
  SELECT doc_id, count(*) AS matched_terms, CAST(sum(hits) AS BIGINT) AS hits FROM hits GROUP BY doc_id""")

reg("filtered_search", f"""WITH terms AS (SELECT DISTINCT unnest(regexp_extract_all(text, {lit(TOKEN_PATTERN)})) AS term
    FROM benchmark),
  toks AS (SELECT doc_id, unnest(regexp_extract_all(text, {lit(TOKEN_PATTERN)})) AS term FROM documents
           WHERE lang IN ('en', 'de') AND NOT coalesce(n_chars > 20000, false)),
  hits AS (SELECT doc_id, term, count(*) AS hits FROM toks WHERE term IN (SELECT term FROM terms)
           GROUP BY doc_id, term)
  SELECT doc_id, count(*) AS matched_terms, CAST(sum(hits) AS BIGINT) AS hits FROM hits GROUP BY doc_id""")
reg("search_ranked", f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), {lit(TOKEN_PATTERN)}) AS ts FROM documents),
  n AS (SELECT count(*) AS n, avg(len(ts)) AS mean FROM d),
  q AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS query_id,
               unnest(regexp_extract_all(lower(text), {lit(TOKEN_PATTERN)})) AS term FROM benchmark),
  tf AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS len, unnest(ts) AS term FROM d)
         WHERE term IN (SELECT term FROM q) GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  s AS (SELECT query_id, doc_id, count(*) AS matched_terms,
               sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))) AS score
        FROM tf JOIN df USING (term) JOIN q USING (term), n GROUP BY query_id, doc_id)
  SELECT query_id, rank, doc_id, matched_terms, round(round(score, 6), 4) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, CAST(doc_id AS VARCHAR)) AS rank
    FROM s) WHERE rank <= {cat.SEARCH_K}""")
MARKED = "array_to_string(list_transform(regexp_extract_all(lower({}), " + lit(TOKEN_PATTERN).replace("{", "{{").replace(
    "}", "}}") + "), lambda t: chr(1) || t || chr(2)), '')"
reg("search_phrases", f"""WITH d AS (SELECT doc_id, {MARKED.format('text')} AS s FROM documents),
  q AS (SELECT CAST(item_id AS VARCHAR) AS query_id, {MARKED.format('text')} AS p FROM benchmark)
  SELECT query_id, doc_id, len(string_split(s, p)) - 1 AS hits FROM d JOIN q ON contains(s, p)""")

# --- bucketed stores ---------------------------------------------------------------
WEIGHTED = "round(list_sum(list_transform(vals, lambda v, i: CAST(v AS DOUBLE) * i)), 5)"


def all_rows(docs: str, chunks: str, vecs: str) -> str:
    return f"""SELECT 'documents' AS store, id, title, md5(content) AS content_md5,
    CAST(NULL AS VARCHAR) AS document_id, CAST(NULL AS BIGINT) AS chunk_index, CAST(NULL AS DOUBLE) AS value_sum
  FROM {docs}
  UNION ALL SELECT 'chunks', id, NULL, md5(content), document_id, chunk_index, NULL FROM {chunks}
  UNION ALL SELECT 'vectors', id, NULL, NULL, document_id, chunk_index, {WEIGHTED} FROM {vecs}"""


def aligned(docs: str) -> str:
    """Chunks of ``docs`` (id, content) with the ids they have after a sync: that of the stored chunk of the
    same place and content, else that of the stored chunk with the same content at the same
    rank among those that have no such partner, else a new one."""
    return chunk_store_ctes("made", docs) + """,
old_rest AS (SELECT *, row_number() OVER (PARTITION BY document_id, content ORDER BY chunk_index) AS rn
  FROM chunk_store c ANTI JOIN made m ON c.id = m.id),
made_rest AS (SELECT *, row_number() OVER (PARTITION BY document_id, content ORDER BY chunk_index) AS rn
  FROM made m ANTI JOIN chunk_store c ON c.id = m.id),
aligned AS (SELECT m.id, m.document_id, m.chunk_index, m.content, m.token_count FROM made m SEMI JOIN chunk_store c ON c.id = m.id
  UNION ALL SELECT coalesce(o.id, m.id), m.document_id, m.chunk_index, m.content, m.token_count
  FROM made_rest m LEFT JOIN old_rest o ON o.document_id = m.document_id AND o.content = m.content AND o.rn = m.rn),
""" + embed_ctes("aligned_vecs", "aligned")


INC_BASE = (MANIFEST, LISTED, SRC, LABELLED, STORE, MATCHED, MAPPED, MAPPED_DOCS, STORE_DOCS, CHUNK_STORE)
reg("incremental_sync", with_(*INC_BASE, aligned("mapped_docs")) + all_rows("mapped", "aligned", "aligned_vecs"))
ASKED = "asked AS (SELECT m.* FROM mapped m WHERE title IN (SELECT title FROM requested))"
ASKED_DOCS = "asked_docs AS (SELECT id, content FROM asked)"
LEFT_OVER = """docs_now AS (SELECT id, title, content FROM asked UNION ALL
    SELECT id, title, content FROM store WHERE id NOT IN (SELECT id FROM asked)),
  chunks_now AS (SELECT id, document_id, chunk_index, content FROM aligned UNION ALL
    SELECT id, document_id, chunk_index, content FROM chunk_store WHERE document_id NOT IN (SELECT id FROM asked)),
  vecs_now AS (SELECT id, document_id, chunk_index, vals FROM aligned_vecs UNION ALL
    SELECT id, document_id, chunk_index, vals FROM vector_store WHERE document_id NOT IN (SELECT id FROM asked))"""
reg("incremental_requested", with_(*INC_BASE, REQUESTED, CURRENT, VECTOR_STORE, ASKED, ASKED_DOCS, aligned("asked_docs"),
                                   LEFT_OVER) + all_rows("docs_now", "chunks_now", "vecs_now"))
STATE_BASE = (LABELLED, STORE, STORE_DOCS, CHUNK_STORE, CURRENT, VECTOR_STORE)
reg("store_as_of", with_(*STATE_BASE) + all_rows("store", "chunk_store", "vector_store"))
reg("incremental_cleanup", with_(*STATE_BASE, CLEANUP_NAMES, CLEANUP_IDS) + all_rows(
    "(FROM store WHERE id NOT IN (SELECT id FROM cleanup_ids))",
    "(FROM chunk_store WHERE document_id NOT IN (SELECT id FROM cleanup_ids))",
    "(FROM vector_store WHERE document_id NOT IN (SELECT id FROM cleanup_ids))"))
reg("incremental_report", with_(*INC_BASE, CLEANUP_NAMES, CURRENT, VECTOR_STORE, aligned("mapped_docs"), f"""gone_docs AS (
    SELECT id FROM mapped WHERE title IN (SELECT {title_of('name')} FROM cleanup_names))""") + """
  SELECT 'files_listed' AS metric, count(*) AS value FROM listed
  UNION ALL SELECT 'files_landed', count(DISTINCT name) FROM listed
  UNION ALL SELECT 'documents_mapped', count(*) FROM mapped
  UNION ALL SELECT 'documents_new', count(*) FROM mapped WHERE status = 'new'
  UNION ALL SELECT 'documents_changed', count(*) FROM mapped WHERE status = 'changed'
  UNION ALL SELECT 'documents_same', count(*) FROM mapped WHERE status = 'same'
  UNION ALL SELECT 'chunks_kept', count(*) FROM made WHERE id IN (SELECT id FROM chunk_store)
  UNION ALL SELECT 'chunks_moved', count(*) FROM aligned WHERE id IN (SELECT id FROM old_rest)
  UNION ALL SELECT 'chunks_fresh', count(*) FROM aligned WHERE id NOT IN (SELECT id FROM chunk_store)
  UNION ALL SELECT 'chunks_gone', count(*) FROM old_rest WHERE id NOT IN (SELECT id FROM aligned)
  UNION ALL SELECT 'chunks_embedded', count(*) FROM aligned a
    ANTI JOIN vector_store v ON a.id = v.id AND a.document_id = v.document_id
  UNION ALL SELECT 'embeddings_failed', 0
  UNION ALL SELECT 'documents_deleted', count(*) FROM gone_docs
  UNION ALL SELECT 'chunks_deleted', count(*) FROM aligned WHERE document_id IN (SELECT id FROM gone_docs)
  UNION ALL SELECT 'vectors_deleted', count(*) FROM aligned WHERE document_id IN (SELECT id FROM gone_docs)""")

# --- sources and sinks -----------------------------------------------------------
reg("docx_extract", with_(MANIFEST) + f"""SELECT name,
  array_to_string(list_filter(string_split(content, chr(10)), lambda l: {non_blank('l')}), chr(10)) AS content
  FROM manifest WHERE mime_type <> {lit(fx.HTML_MIME)}""")
READ_TEXT = f"array_to_string(list_filter(string_split(content, chr(10)), lambda l: {non_blank('l')}), chr(10))"
BAD_FILE = "'BadZipFile: File is not a zip file'"
reg("folder_source", with_(MANIFEST) + f"""SELECT name, {READ_TEXT} AS content, CAST(NULL AS VARCHAR) AS error
  FROM manifest WHERE mime_type <> {lit(fx.HTML_MIME)}
  UNION ALL SELECT file_id || '.docx', NULL, {BAD_FILE} FROM manifest WHERE mime_type = {lit(fx.HTML_MIME)}""")
reg("folder_sync", with_(MANIFEST, LABELLED, STORE) + f"""SELECT title, md5(text) AS content_md5,
    CAST(NULL AS VARCHAR) AS error
  FROM (SELECT {title_of('name')} AS title, {READ_TEXT} AS text FROM manifest
        WHERE mime_type <> {lit(fx.HTML_MIME)}) WHERE {non_blank('text')}
  UNION ALL SELECT title, md5(content), NULL FROM store WHERE title NOT IN
    (SELECT {title_of('name')} FROM manifest WHERE {non_blank('content')} AND mime_type <> {lit(fx.HTML_MIME)})
  UNION ALL SELECT file_id || '.docx', NULL, {BAD_FILE} FROM manifest WHERE mime_type = {lit(fx.HTML_MIME)}""")
reg("error_sink", with_(MANIFEST) + f"""SELECT file_id || '.docx' AS filename,
  'BadZipFile: File is not a zip file' AS error FROM manifest WHERE mime_type = {lit(fx.HTML_MIME)}""")

# --- streaming -------------------------------------------------------------------
# every source document is mapped by some batch, and replace mode leaves exactly
# the chunks of the mapped documents
SQL["sync_stream"] = SQL["insert_chunks"]

LATER = """later AS (SELECT d.doc_id, m.title, m.id, coalesce(l.toxic, 0) = 1 AS gone, d.lang = 'en' AS edited,
         d.text || ' Again.' AS content
  FROM documents d JOIN mapped m ON m.title = d.source || '-' || CAST(d.doc_id AS VARCHAR)
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
reg("stream_match", with_(SRC, LABELLED, STORE, MATCHED, MAPPED, LATER) + f"""
  SELECT m.title, m.id, m.status, s.doc_id AS position,
         CASE WHEN m.status <> 'same' THEN md5(m.content) END AS content_md5
  FROM mapped m JOIN src s ON s.title = m.title
  UNION ALL SELECT title, id, 'deleted', {1 << 40}, NULL FROM later WHERE gone
  UNION ALL SELECT title, id, 'changed', doc_id * 2 + 1, md5(content) FROM later WHERE edited AND NOT gone""")
LEFT_DOCS = """left_docs AS (SELECT l.id, l.title, CASE WHEN edited THEN l.content ELSE m.content END AS content
  FROM later l JOIN mapped m ON m.title = l.title WHERE NOT gone)"""
reg("sync_stream_keyed", with_(SRC, LABELLED, STORE, MATCHED, MAPPED, LATER, LEFT_DOCS, chunk_ctes("lch", "left_docs"))
    + """SELECT d.id, d.title, md5(d.content) AS content_md5, c.chunks, c.tokens FROM left_docs d
  JOIN (SELECT document_id AS id, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS tokens FROM lch
        GROUP BY document_id) c ON c.id = d.id""")
