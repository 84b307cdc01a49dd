"""Table schemas of the four stores and a conform (schema check + cast) operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_NAMESPACE = "__default__"

# The two document MIME types a source listing keeps
# (an uploaded Word file, and a native online document exported as Word).
DOCX_MIME = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
GDOC_MIME = "application/vnd.google-apps.document"
DOCUMENT_MIME_TYPES = (DOCX_MIME, GDOC_MIME)

SOURCE_FILES = T.StructType([
    T.StructField("file_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("mime_type", T.StringType(), True),
    T.StructField("position", T.LongType(), True),
    T.StructField("content", T.StringType(), True),
])

DOCUMENTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("content", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

CHUNKS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("document_id", T.StringType(), True),
    T.StructField("chunk_index", T.IntegerType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("token_count", T.IntegerType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

VECTOR_METADATA = T.StructType([
    T.StructField("document_id", T.StringType(), True),
    T.StructField("chunk_index", T.IntegerType(), True),
    T.StructField("token_count", T.IntegerType(), True),
])

VECTORS = T.StructType([
    T.StructField("namespace", T.StringType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("values", T.ArrayType(T.FloatType(), True), True),
    T.StructField("metadata", VECTOR_METADATA, True),
])

REJECTS = T.StructType([
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("filename", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
])


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType, fill_missing: bool = True) -> DataFrame:
    """Select the schema's columns in order, cast each to its type.

    A missing nullable column is filled with null when ``fill_missing``; a
    missing non-nullable column raises.  A value that cannot be cast, and a
    null in a non-nullable column, fail the job: a store is written whole or
    not at all.
    """
    have = {f.name: f for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        if field.name in have:
            src = F.col(field.name)
            if have[field.name].dataType != field.dataType:
                src = src.cast(field.dataType)       # ANSI: raises
            if not field.nullable and have[field.name].nullable:
                src = F.coalesce(src, F.raise_error(f"null in column {field.name}").cast(field.dataType))
            cols.append(src.alias(field.name))
        elif fill_missing and field.nullable:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise SchemaMismatch(f"missing required column {field.name!r}")
    return df.select(*cols)


def empty(spark, schema: T.StructType) -> DataFrame:
    """An empty DataFrame with the given schema (guard_empty's result)."""
    return spark.createDataFrame([], schema)
