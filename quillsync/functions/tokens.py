"""Pluggable token counters.

The default counter (:func:`quillsync.functions.text.token_count`) is a
regular expression that runs in the JVM.  A byte-pair-encoding counter for a
named encoding can be plugged in instead when its vocabulary is available
locally (no download happens here); it runs as Arrow-batched pandas UDFs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F


def bpe_counters(encoding: str = "cl100k_base"):
    """``(counter, sentence_counter)`` for ``make_chunks`` using a BPE encoding.

    Raises ``RuntimeError`` when the encoding cannot be loaded offline.
    """
    try:
        import tiktoken
        tiktoken.get_encoding(encoding)
    except Exception as e:  # noqa: BLE001
        raise RuntimeError(f"BPE encoding {encoding!r} is not available locally: {e}") from e

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        import tiktoken as tk
        enc = tk.get_encoding(encoding)
        return pd.Series([len(enc.encode(t)) if t is not None else 0 for t in texts], dtype="int32")

    @F.pandas_udf("array<int>")
    def count_each(arrays: pd.Series) -> pd.Series:
        import tiktoken as tk
        enc = tk.get_encoding(encoding)
        return pd.Series([[len(x) for x in enc.encode_batch(list(a))] if a is not None else []
                          for a in arrays])

    return count, count_each
