"""Document fingerprints: bottom-k sketches of five-word shingle hashes.

A sketch is the ascending list of the ``k`` smallest distinct 64-bit shingle
hashes of a text.  Sketches of parts merge into the sketch of the whole
(``merge``), and give estimates of resemblance, containment and the number of
distinct shingles; a sketch with fewer than ``k`` hashes is the full set and
its figures are exact.

Null or wordless text: the empty sketch (the empty string when encoded).
Two empty sketches resemble each other with 1, an empty and a non-empty with 0.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsync.llm.text import Words, local, shingles, slices

K = 128
_SPAN = 2.0 ** 64


def sketches(column, k: int = K) -> list[np.ndarray]:
    """One ascending uint64 array of at most ``k`` hashes per text."""
    words = Words(column)
    hashes, doc = shingles(words)
    cut = np.searchsorted(doc, np.arange(len(words.first)))
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        h = hashes[a:b]
        if len(h) > 16 * k:
            # repeated shingles can fill the smallest places: widen until k are distinct
            take = 4 * k
            while True:
                low = np.unique(np.partition(h, take)[:take])
                if len(low) >= k:
                    break
                take *= 4
                if take >= len(h):
                    low = np.unique(h)
                    break
            out.append(low[:k])
        else:
            out.append(np.unique(h)[:k])
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of the two sketched sets."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]), kind="stable")
    same = both[1:] == both[:-1]
    first = np.concatenate([[True], ~same])
    rank = np.cumsum(first)                    # place among the union's distinct hashes
    total = min(k, int(rank[-1]))
    return float(np.count_nonzero(same & (rank[1:] <= total))) / total


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * _SPAN / float(a[k - 1])


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too."""
    if not len(a):
        return 1.0
    union = distinct(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct(a, k))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decode(s: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s or ""), dtype=">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = K) -> DataFrame:
    """(id, fingerprint, n_shingles estimate) of every row; no shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), local(text_col))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            own = sketches(b.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([encode(x) for x in own], pa.string()),
                 pa.array([distinct(x, k) for x in own], pa.float64())],
                names=["id", "fingerprint", "n_shingles"])

    return rows.mapInArrow(run, f"id {kind}, fingerprint string, n_shingles double") \
        .withColumnRenamed("id", id_col)


def merged(parts: DataFrame, key: str, fingerprint_col: str = "fingerprint",
           k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts.

    The parts' hashes are exploded, made distinct and cut to ``k`` by a window
    limit, which Spark applies before the shuffle as well, so no task holds
    more than ``k`` hashes of a key per input partition.
    """
    @F.pandas_udf("array<decimal(20,0)>")
    def hashes(s: pd.Series) -> pd.Series:
        from decimal import Decimal
        return s.map(lambda x: [Decimal(int(v)) for v in decode(x)])

    @F.pandas_udf("string")
    def join(s: pd.Series) -> pd.Series:
        return s.map(lambda xs: encode(np.array(sorted(int(v) for v in xs), dtype=np.uint64)))

    h = parts.select(F.col(key).alias("key"),
                     F.explode_outer(hashes(fingerprint_col)).alias("h")).distinct()
    w = Window.partitionBy("key").orderBy(F.col("h").asc_nulls_last())
    low = h.withColumn("at", F.row_number().over(w)).where(F.col("at") <= k)
    return low.groupBy("key").agg(join(F.collect_list("h")).alias("fingerprint")) \
        .withColumnRenamed("key", key)


# --- fingerprints of texts and of texts whose tail comes from the next one ---

def edited(text: str, after: str) -> str:
    """The last third of ``text`` replaced by as much of the start of ``after``."""
    n = len(text) // 3
    return text[:len(text) - n] + after[:n]


def with_edited(docs: DataFrame, k: int = K, partitions: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The next document is the next in descending ``doc_id`` (nulls last, equal
    ids in text order); the first follows the last; a lone document follows
    itself.  Rows are dealt into ranges of ``doc_id`` with one shuffle; the
    first rows of each range also go to the range before it, so every task sees its
    successors and no global window is needed.  Rows of one ``doc_id`` share a
    range.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), local("text"))
    share = [i / n for i in range(1, n)] or [0.5]
    found = rows.select(F.percentile_approx("doc_id", share, 20_000).alias("q")).first().q
    bounds = np.unique(np.array(found or [], dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        """Descending ranges 0..len(bounds)."""
        return pd.Series((len(bounds) - np.searchsorted(bounds, ids.to_numpy())).astype("int32"))

    # pandas would turn a long column with nulls into doubles, so none is passed
    ranged = rows.withColumn("part", F.when(
        F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(range_of(F.coalesce("doc_id", F.lit(0)))))
    heads = [(r.part, r.top) for r in
             ranged.groupBy("part").agg(F.max("doc_id").alias("top")).collect()]  # one row a range
    heads.sort()
    to = spark.createDataFrame(
        [(part, top, heads[i - 1][0]) for i, (part, top) in enumerate(heads)],
        "part int, top long, before int")
    copies = ranged.join(F.broadcast(to), "part").where(F.col("doc_id").eqNullSafe(F.col("top")))
    both = ranged.withColumn("carry", F.lit(0)).unionByName(
        copies.select("doc_id", "text", F.col("before").alias("part"), F.lit(1).alias("carry")))
    dealt = both.repartition(n, "part").sortWithinPartitions(
        "part", "carry", F.col("doc_id").desc_nulls_last(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait = None                    # the last row, whose successor is not known yet
        for b in slices(batches):
            cols = [b.column(c).to_pylist() for c in ("part", "carry", "doc_id", "text")]
            seen = list(zip(*cols))
            chain = ([wait] if wait else []) + seen
            pairs = [(x, y[3]) for x, y in zip(chain, chain[1:]) if not x[1]]
            wait = chain[-1]
            if pairs:
                yield _compare([x[2] for x, _ in pairs], [x[3] for x, _ in pairs],
                               [y for _, y in pairs], k)

    return dealt.select("part", "carry", "doc_id", "text").mapInArrow(run, SCHEMA)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _compare(ids: list, texts: list[str], after: list[str], k: int) -> pa.RecordBatch:
    changed = [edited(t, a) for t, a in zip(texts, after)]
    # texts follow each other, so every next text but the last is an own text too
    own = sketches(pa.array(texts + after[-1:], pa.large_string()), k)
    new = sketches(pa.array(changed, pa.large_string()), k)
    follow = [own[i + 1] if i + 1 == len(texts) or after[i] is texts[i + 1] or after[i] == texts[i + 1]
              else sketches(pa.array([after[i]], pa.large_string()), k)[0]
              for i in range(len(texts))]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
        pa.array([encode(x) for x in own[:-1]], pa.string()),
        pa.array([encode(x) for x in new], pa.string()),
        pa.array([resemblance(x, y, k) for x, y in zip(own, new)], pa.float64()),
        pa.array([resemblance(x, y, k) for x, y in zip(own, follow)], pa.float64())],
        names=[f.split()[0] for f in SCHEMA.split(", ")])
