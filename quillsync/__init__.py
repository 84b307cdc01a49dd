"""quillsync: keep a retrieval knowledge base in sync with a document corpus, on Spark.

Stores are DataFrames (documents, chunks, vectors) with versioned parquet
snapshots; every operator maps DataFrames to DataFrames:

* ``functions.text``        title, blank, sentences, tokens, stable ids (Columns)
* ``operators.chunking``    sentence packing under a token limit with overlap
* ``operators.matching``    first match per title; new / changed / same
* ``operators.store``       lookups, inserts (append / replace), deletes, snapshots
* ``operators.embed``       embedders and embedding rejects
* ``operators.vectors``     validation, upsert, fetch, clear, delete
* ``operators.retrieval``   exact top-k, context, term search
* ``operators.audit``       reconcile, reports
* ``sources``               listing, selection, landing, docx, reject sink
* ``plans.sync``            sync and cleanup pipelines
* ``streaming.sync_stream`` incremental sync over a landing folder
"""

__version__ = "0.1.0"
