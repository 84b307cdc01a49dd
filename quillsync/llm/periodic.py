"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least ``max(MIN_WORDS, MIN_PERIODS * q)`` words, which no
neighbouring word extends.  Every word of a run stands in it ``MIN_PERIODS`` times
at least, so within a segment of a text a word with fewer occurrences lies in no
run: it splits the segment.  The pieces are counted anew until none splits
(a piece recounts its smaller parts only, so a text of n words costs n log n).

The segments that survive are scanned by lag.  Lags up to ``SHORT`` compare each
word with the one a lag on.  For a longer lag q, a run holds two adjacent aligned
blocks of q words that are equal, so only the blocks at multiples of q are compared:
n log n comparisons for all lags, by hashes that never miss an equal pair.  A pair is
extended word by word, so a run is exact whatever its hashes say.

A word is the bytes between 0x20 and 0x09-0x0D; case counts.  A text is one row and
one task's work.  Null, empty and wordless texts have no runs and an empty collapsed
text; a null id stays null; repeated rows are handled apart; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.llm.text import bounded_batches, local, slices

MIN_WORDS = 24
MIN_PERIODS = 3
SHORT = 8                 # MIN_WORDS / MIN_PERIODS: up to this lag MIN_WORDS is the bound
PAIRS = 1 << 19           # block pairs that are compared at once

_U = np.uint64
RUNS = "array<struct<start:long,length:long,period:long>>"


def _survivors(words: list[int]) -> list[tuple[int, int]]:
    """The segments (first, end) in which every word occurs MIN_PERIODS times."""
    n = len(words)
    if n < MIN_WORDS:
        return []
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    counts = {w: len(p) for w, p in places.items()}
    work = [(0, n, counts, None)]
    done = []
    while work:
        lo, hi, counts, asked = work.pop()
        # words that may have become rare here; all of them in a new segment
        rare = [w for w in (counts if asked is None else asked) if 0 < counts[w] < MIN_PERIODS]
        cuts = sorted({i for w in rare for i in _within(places[w], lo, hi)})
        if not cuts:
            done.append((lo, hi))
            continue
        parts = [(a + 1, b) for a, b in zip([lo - 1, *cuts], [*cuts, hi])]
        big = max(parts, key=lambda p: p[1] - p[0])
        # the largest part keeps the counts, less what lies outside of it
        if big[1] - big[0] >= MIN_WORDS:
            gone = Counter(words[lo:big[0]])
            gone.update(words[big[1]:hi])
            for w, k in gone.items():
                counts[w] -= k
            work.append((*big, counts, list(gone)))
        work.extend((a, b, Counter(words[a:b]), None) for a, b in parts
                    if b - a >= MIN_WORDS and (a, b) != big)
    return done


def _within(places: list[int], lo: int, hi: int) -> list[int]:
    return places[bisect_left(places, lo):bisect_left(places, hi)]


class _Runs:
    """The runs found so far, by period; runs of one period overlap by less than it."""

    def __init__(self):
        self.by_period: dict[int, tuple[list[int], list[int]]] = {}

    def add(self, start: int, end: int, period: int) -> None:
        starts, ends = self.by_period.setdefault(period, ([], []))
        starts.append(start)
        ends.append(end)

    def covered(self, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which stretches a..b of period q lie in a run whose period divides q."""
        out = np.zeros(len(q), dtype=bool)
        for p, (starts, ends) in self.by_period.items():
            ask = np.flatnonzero(q % p == 0)
            if len(ask):
                s, e = np.asarray(starts), np.asarray(ends)        # ascending, as they are found
                k = np.searchsorted(s, a[ask], side="right") - 1
                out[ask] |= (k >= 0) & (e[np.maximum(k, 0)] >= b[ask])
        return out


def _same(ids: np.ndarray, lag: int, at: int, step: int, limit: int) -> int:
    """How many places from ``at`` on (by step 1 or -1) equal the one a lag on, ``limit`` at most."""
    got, size = 0, 64
    while got < limit:
        size = min(size * 2, limit - got)
        lo = at + got if step > 0 else at - got - size + 1
        odd = np.flatnonzero(ids[lo:lo + size] != ids[lo + lag:lo + lag + size])
        if len(odd):
            return got + int(odd[0] if step > 0 else size - 1 - odd[-1])
        got += size
    return got


def _scan(ids: np.ndarray, salt: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs within one segment of word numbers."""
    n = len(ids)
    found = _Runs()
    out = []

    def add(s: int, e: int, q: int) -> None:
        found.add(s, e, q)
        out.append((s, e, q))

    for q in range(1, min(SHORT, n // MIN_PERIODS) + 1):
        edge = np.diff(np.concatenate([[0], (ids[q:] == ids[:-q]).view(np.int8), [0]]))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q
        long = b - a >= max(MIN_WORDS, MIN_PERIODS * q)
        a, b = a[long], b[long]
        old = found.covered(np.full(len(a), q), a, b)
        for s, e in zip(a[~old].tolist(), b[~old].tolist()):
            add(s, e, q)
    if n // MIN_PERIODS <= SHORT:
        return out
    # prefix sums of word hash times B**i: the blocks at i and j are equal only if
    # their sums, shifted by B**(j - i), are (modulo 2**64)
    power = np.full(n + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(salt[ids] * power[:n], out=sums[1:])
    q0, last = SHORT + 1, n // MIN_PERIODS
    while q0 <= last:
        # as many lags as make about PAIRS pairs
        q1 = min(last, max(q0, q0 + PAIRS * q0 // n))
        lags = np.arange(q0, q1 + 1)
        per = (n - 2 * lags) // lags + 1
        q = np.repeat(lags, per)
        a = (np.arange(len(q)) - np.repeat(np.cumsum(per) - per, per)) * q
        alike = ids[a] == ids[a + q]
        q, a = q[alike], a[alike]
        alike = (sums[a + q] - sums[a]) * power[q] == sums[a + 2 * q] - sums[a + q]
        q, a = q[alike], a[alike]
        fresh = ~found.covered(q, a, a + 2 * q)
        q, a = q[fresh], a[fresh]
        while len(q):
            lag, at = int(q[0]), int(a[0])
            s = at - _same(ids, lag, at - 1, -1, at)
            e = at + lag + _same(ids, lag, at, 1, n - lag - at)
            rest = np.ones(len(q), dtype=bool)
            rest[0] = False
            if e - s >= MIN_PERIODS * lag:
                add(s, e, lag)
                rest &= (q % lag != 0) | (a < s) | (a + 2 * q > e)
            q, a = q[rest], a[rest]
        q0 = q1 + 1
    return out


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, by start and then period."""
    number: dict = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    segments = _survivors(ids)
    if not segments:
        return []
    whole = np.asarray(ids)
    salt = np.random.default_rng(1).integers(1, 2 ** 63, len(number), dtype=np.uint64) * _U(2) + _U(1)
    found = [(lo + s, e - s, q) for lo, hi in segments for s, e, q in _scan(whole[lo:hi], salt)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def _annotate(batches) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
    for batch in slices(batches):
        runs, texts = [], []
        for text in batch.column("text").to_pylist():
            words = text.encode().split()        # bytes split at 0x20 and 0x09-0x0D
            here = runs_of(words)
            runs.append([dict(zip(("start", "length", "period"), r)) for r in here])
            texts.append(b" ".join(kept_words(words, here)).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(runs, kind), pa.array(texts, pa.string())], ["id", "runs", "collapsed"])


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed): every text's runs and its words without their repetitions, joined by one space."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), local(text_col))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_annotate, f"id {kind}, runs {RUNS}, collapsed string")


def strongest(runs_col: str = "runs") -> Column:
    """The run with the greatest length / period, compared exactly; of ties the first
    by start and then by period (as the runs are in that order); null where there is none."""
    return F.aggregate(F.slice(runs_col, 2, F.greatest(F.size(runs_col), F.lit(1))), F.get(runs_col, F.lit(0)),
                       lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r)
                       .otherwise(best))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of :func:`runs`: their number, the strongest run, and digests of
    all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(F.col("id").alias(id_col), F.size("runs").cast("long").alias("n_runs"),
                        strongest().alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")) \
        .select(id_col, "n_runs", *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
                F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                "runs_sha256", "collapsed_sha256")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of every row, one in ten given a repetition as the query's contract says:
    with h the crc32 of the id in decimal (null: of the empty text), g = h div 10 and n words,
    where h % 10 = 0 the words from a = g % n on repeat those from a to
    a + p - 1, p = 1 + (n - a) div (3 + g % 8)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("h"))
    cut = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # a generator keeps the words from being cut once per use
    rows = rows.select("id", "text", F.expr("h div 10").alias("g"),
                       F.inline(F.array(F.struct(F.when(F.col("h") % 10 == 0, cut).alias("words")))))
    n = F.size("words").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.expr("g % size(words)")))
    rows = rows.withColumn("p", 1 + F.expr("(size(words) - a) div (3 + g % 8)"))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
