"""Match incoming documents to the document store by title.

The store's ``title`` is not unique; a title resolves to its first row by
``(created_at, id)``.  That pick is a ``min_by`` aggregation rather than a
``row_number`` window: partial aggregation reduces every map partition to
one row per title before the shuffle, so a title held by a third of all
rows never lands whole in one task.

``collation`` (for instance ``CASELESS``) names the Spark collation that titles are
compared under; without one they are compared byte by byte.  A stored document
keeps its own spelling of the title.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.functions.text import stable_id

NEW, CHANGED, SAME = "new", "changed", "same"
CASELESS = "UTF8_LCASE"
_FAR_FUTURE = "9999-12-31 23:59:59"


def title_key(title: Column | str, collation: str | None = None) -> Column:
    """The title as a join and grouping key: equal keys are one title under ``collation``."""
    t = F.col(title) if isinstance(title, str) else title
    return t if collation is None else F.collate(t, collation)


def _first_key(created_at: str = "created_at", id_col: str = "id") -> Column:
    ts = F.coalesce(F.col(created_at), F.lit(_FAR_FUTURE).cast("timestamp"))
    return F.struct(ts.alias("ts"), F.col(id_col).alias("id"))


def first_per_key(df: DataFrame, key, order: Column) -> DataFrame:
    """One row per ``key`` (a column name or list): the row with the smallest
    ``order``.  Skew-safe: ``min_by`` aggregates partially before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def first_match(store: DataFrame, collation: str | None = None) -> DataFrame:
    """The store resolved to one row per title: earliest ``created_at``, then ``id``."""
    if collation is None:
        return first_per_key(store, "title", _first_key())
    keyed = store.withColumn("_title", title_key("title", collation))
    return first_per_key(keyed, "_title", _first_key()).drop("_title")


def match_documents(src: DataFrame, store: DataFrame, collation: str | None = None) -> DataFrame:
    """Source documents (title, content) left-joined to the store's first match.

    Output: ``id, title, content`` (the source content), ``created_at``,
    ``updated_at`` of the store row, and ``status``: ``new`` (no store row),
    ``changed`` (content differs, null-safe) or ``same``.

    The store side enters the join with the md5 of its content, not the
    text: only the source text is shuffled.  Under a ``collation`` the title is the stored one
    where there is a match; source titles that are equal under it match the same row.
    """
    if collation is not None:
        s = src.select(title_key("title", collation).alias("_title"), "title", "content")
        st = first_match(store.select("title", "id", "created_at", "updated_at",
                                      F.md5(F.col("content")).alias("stored_md5")), collation)
        st = st.withColumn("_title", title_key("title", collation)).withColumnRenamed("title", "stored_title")
        joined = s.join(st, "_title", "left").withColumn("title", F.coalesce("stored_title", "title"))
        return _with_status(joined)
    s = src.select("title", "content")
    st = first_match(store.select("title", "id", "created_at", "updated_at",
                                  F.md5(F.col("content")).alias("stored_md5")))
    return _with_status(s.join(st, "title", "left"))


def _with_status(joined: DataFrame) -> DataFrame:
    status = (F.when(F.col("id").isNull(), F.lit(NEW))
              .when(F.md5(F.col("content")).eqNullSafe(F.col("stored_md5")), F.lit(SAME))
              .otherwise(F.lit(CHANGED)))
    return joined.select("id", "title", "content", "created_at", "updated_at",
                         status.alias("status"))


def new_documents(src: DataFrame, store: DataFrame, collation: str | None = None) -> DataFrame:
    """Source documents whose title the store does not hold."""
    if collation is None:
        return src.join(store.select("title"), "title", "left_anti")
    held = store.select(title_key("title", collation).alias("_title"))
    return src.withColumn("_title", title_key("title", collation)).join(held, "_title", "left_anti").drop("_title")


def changed_documents(src: DataFrame, store: DataFrame, collation: str | None = None) -> DataFrame:
    """Matched store rows whose content differs, carrying the new content."""
    m = match_documents(src, store, collation).where(F.col("status") == CHANGED)
    return m.select("id", "title", "content", "created_at", "updated_at")


def document_id(title: Column | str) -> Column:
    """Id of a newly inserted document (deterministic in its title)."""
    return stable_id(F.lit("document"), title)


def mapped(src: DataFrame, store: DataFrame, run_ts: Column | None = None,
           skip_unchanged: bool = False, collation: str | None = None) -> DataFrame:
    """The run's mapped set: new documents with fresh ids + matched ones with new content.

    ``skip_unchanged`` leaves out matched documents whose content is equal;
    the reference re-processes them.
    """
    ts = run_ts if run_ts is not None else F.current_timestamp()
    m = match_documents(src, store, collation)
    if skip_unchanged:
        m = m.where(F.col("status") != SAME)
    # one projection over the join (no union of a new and a matched branch,
    # which would evaluate the join twice)
    is_new = F.col("status") == NEW
    return m.select(
        F.when(is_new, document_id(F.col("title"))).otherwise(F.col("id")).alias("id"),
        "title", "content",
        F.when(is_new, ts).otherwise(F.col("created_at")).alias("created_at"),
        F.when(is_new, ts).otherwise(F.col("updated_at")).alias("updated_at"),
        "status")
