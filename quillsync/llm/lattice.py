"""Vectors on an integer lattice, in bounded blocks of Arrow rows.

A component x becomes floor(scale * x), x as double, so inner products are whole
numbers: a matrix product in doubles is exact below 2**53, and beyond that the
products are computed with Python's integers and kept within 64 bits.

A null vector, one with a null or non-finite component and one with a null id take
no part.  A shorter vector counts as filled with zeros.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsync.session import scratch_dir

SCALE = 256
EXACT = 2.0 ** 53
STEP_CELLS = 1 << 20          # scores that are held at once (8 MB each time)
BLOCK_CELLS = 1 << 19         # components of the asking vectors in one block (4 MB)
NONE = -2 ** 63              # below every score that is compared


def matrix(column, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """The usable rows of a list column as a matrix of whole doubles, and which they are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros((0, 0)), np.zeros(0, dtype=np.int64)
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan"))
    flat = flat.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), size)
    good = np.asarray(column.is_valid())
    good[row[~np.isfinite(flat)]] = False
    out = np.zeros((n, int(size.max(initial=0))))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore", invalid="ignore"):
        out[row, place] = np.clip(np.floor(scale * flat), -EXACT, EXACT)
    rows = np.flatnonzero(good)
    return out[rows], rows


def fit(x: np.ndarray, dim: int) -> np.ndarray:
    """The matrix with ``dim`` columns: zeros added, or columns left out that meet only zeros."""
    if x.shape[1] >= dim:
        return x[:, :dim]
    return np.hstack([x, np.zeros((len(x), dim - x.shape[1]))])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole inner products of the rows of a and b as 64-bit integers."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    whole = exact(a).dot(exact(b).T) if a.size and b.size else np.zeros((len(a), len(b)), dtype=object)
    return np.clip(whole, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def pieces(batches, *columns: str, scale: float = SCALE) -> Iterator[tuple]:
    """(matrix, *columns as arrays) of the usable rows, so cut that no matrix is far above
    STEP_CELLS (or one vector), however unequal the vectors are in length."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.list_value_length(batch.column("vector")), 0), dtype=np.int64)
        work = [(0, batch.num_rows)]
        while work:
            at, end = work.pop()
            if end - at > 1 and (end - at) * int(size[at:end].max()) > STEP_CELLS:
                half = (at + end) // 2
                work += [(half, end), (at, half)]
                continue
            part = batch.slice(at, end - at)
            x, rows = matrix(part.column("vector"), scale)
            if len(rows):
                yield x, *[part.column(c).to_numpy(zero_copy_only=False)[rows].astype(np.int64) for c in columns]


def rows_of(vectors: DataFrame, id_col: str, values_col: str, **more) -> DataFrame:
    """(id, vector, ...): the rows with an id, other columns left out."""
    return vectors.where(F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("id"), F.col(values_col).alias("vector"),
                *[c.alias(k) for k, c in more.items()])


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again."""
    path = scratch_dir(frame.sparkSession, f"{name}-{uuid.uuid4().hex}")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def parts_for(rows: int, dim: int) -> int:
    """How many blocks hold so many vectors of so many components."""
    return max(1, math.ceil(rows * max(1, dim) / BLOCK_CELLS))


def bundles(blocks: DataFrame) -> Iterator[list]:
    """The written blocks, streamed to the driver and bundled up to BLOCK_CELLS components:
    at no time does it hold more than a bundle and one block."""
    held, cells = [], 0
    for row in blocks.toLocalIterator():
        size = len(row["cells"]) // 8
        if held and cells + size > BLOCK_CELLS:
            yield held
            held, cells = [], 0
        held.append(row)
        cells += size
    if held:
        yield held


def unpacked(rows: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """The blocks of a bundle as one matrix, and the ids of each of them."""
    dim = max((r["dim"] for r in rows), default=0)
    x = [fit(np.frombuffer(r["cells"]).reshape(-1, r["dim"]) if r["dim"] else np.zeros((len(r["ids"]) // 8, 0)), dim)
         for r in rows]
    return np.vstack(x) if x else np.zeros((0, 0)), [np.frombuffer(r["ids"], dtype=np.int64) for r in rows]


def firsts(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k first entries of every key, by falling score and then by id."""
    order = np.lexsort((ids, ~scores, keys))         # ~s falls as s rises, without overflow
    at = keys[order]
    new = np.concatenate([[True], at[1:] != at[:-1]])
    first = np.flatnonzero(new)
    return order[np.arange(len(at)) - first[np.cumsum(new) - 1] < k] if len(at) else order


def ranked(entries: DataFrame, key: str, k: int) -> DataFrame:
    """The k first entries (score, id, own) of every key over all tasks, with their rank, less one
    entry that is the asking row itself.  The limit is taken in each task before the exchange."""
    w = Window.partitionBy(key).orderBy(F.desc("score"), "id", F.desc("own"))
    top = entries.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k + 1)
    seen = F.sum(F.col("own").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return top.withColumn("seen", seen).where(~(F.col("own") & (F.col("seen") == 1))) \
        .withColumn("rank", F.col("place") - F.least("seen", F.lit(1)).cast("int")).where(F.col("rank") <= k) \
        .drop("place", "seen", "own")
