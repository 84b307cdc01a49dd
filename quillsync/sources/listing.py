"""Source listing, selection by title, landing names, requested-file filter.

A listing (manifest) is a DataFrame ``file_id, name, mime_type, position``
(plus ``content`` when the text is already there).  For files landed in a
folder, :func:`scan_folder` builds the same shape from Spark's
``binaryFile`` source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsync.functions.text import DOCX_SUFFIX, title_of
from quillsync.operators.matching import first_per_key, title_key
from quillsync.operators.store import keys_of
from quillsync.schemas import DOCUMENT_MIME_TYPES

RAW, TITLE = "raw", "title"


def list_source(manifest: DataFrame, mime_types=DOCUMENT_MIME_TYPES) -> DataFrame:
    """Files of the two document MIME types, as ``file_id, name, mime_type`` (+ rest)."""
    return manifest.where(F.col("mime_type").isin(list(mime_types)))


def scan_folder(spark: SparkSession, path: str, suffix: str = DOCX_SUFFIX) -> DataFrame:
    """Direct children of ``path`` ending in ``suffix`` (case-sensitive), as binary rows
    ``path, name, modificationTime, length, content``."""
    from quillsync.operators.chunking import spread
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", f"*{suffix}")
          .option("recursiveFileLookup", "false")
          .load(path))
    # many small files pack into few splits; parsing them is CPU work
    return spread(df).withColumn("name", F.regexp_extract(F.col("path"), r"([^/]*)$", 1))


def select_files(files: DataFrame, titles=None, all: bool = True,
                 match: str = TITLE, collation: str | None = None) -> DataFrame:
    """``all`` -> every file.  Otherwise the files whose name is requested; an
    empty or missing request list selects nothing.

    ``match="raw"`` compares the raw file name (the reference's code);
    ``match="title"`` compares the name's title (its documented behaviour), under ``collation`` if given.
    """
    if all:
        return files
    spark = files.sparkSession
    if titles is None or (not isinstance(titles, DataFrame) and len(titles) == 0):
        return files.limit(0)
    t = keys_of(spark, titles, "_t")
    key = F.col("name") if match == RAW else title_of(F.col("name"))
    t = t.select(title_key("_t", collation).alias("_t"))
    return files.withColumn("_t", title_key(key, collation)).join(t, "_t", "left_semi").drop("_t")


def land_names(files: DataFrame, collation: str | None = None) -> DataFrame:
    """Landed file name (title + .docx) per file; when two files land on the same
    name the later one (highest ``position``) wins, as a later download
    overwrites an earlier one.

    The dedupe is keyed by ``title`` (one title <-> one landed name), so its
    output stays hash-partitioned by the key the document match joins on.  Names that are equal
    under ``collation`` land on one file, under the later one's spelling."""
    titled = files.withColumn("title", title_of(F.col("name")))
    later = F.struct((-F.col("position")).alias("p"), F.col("file_id"))
    if collation is None:
        won = first_per_key(titled, "title", later)
    else:
        won = first_per_key(titled.withColumn("_title", title_key("title", collation)), "_title", later).drop("_title")
    return won.withColumn("landed_name", F.concat(F.col("title"), F.lit(DOCX_SUFFIX)))


def fetch(manifest: DataFrame, titles=None, all: bool = False,
          match: str = TITLE, collation: str | None = None) -> DataFrame:
    """list -> select -> land: one row per landed name with the winning file."""
    return land_names(select_files(list_source(manifest), titles, all, match, collation), collation)


def filter_requested(files: DataFrame, names=None, name_col: str = "landed_name") -> DataFrame:
    """Keep files whose name is in ``names``; an empty or missing list keeps all."""
    if names is None or (not isinstance(names, DataFrame) and len(names) == 0):
        return files
    n = keys_of(files.sparkSession, names, "_n")
    return files.join(n, files[name_col] == n["_n"], "left_semi")


def landed_documents(files: DataFrame, name_col: str = "landed_name",
                     text_col: str = "content") -> DataFrame:
    """Landed files -> source documents ``title, content`` for matching."""
    title = F.col("title") if "title" in files.columns else title_of(F.col(name_col))
    return files.select(title.alias("title"), F.col(text_col).alias("content"))
