"""Text extracts: every column arrives as text, with a mark for malformed lines and three audit columns.

A file whose header does not name the columns in their order fails the load. A line with too few or too
many fields is landed with its raw text in ``MALFORMED``, so nothing is padded or cut without a word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import Entity

MALFORMED = "_malformed"

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "NULL",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
    "enforceSchema": "false",
    # With pruned columns the reader would not count a line's fields.
    "columnPruning": "false",
}


def _with_audit(raw: DataFrame, entity: Entity) -> DataFrame:
    """Empty text to NULL, plus file name, file time and load time.

    The reader keeps a quoted empty value as an empty string, hence the explicit pass.
    """
    texts = [F.nullif(F.col(c.stage), F.lit("")).alias(c.stage) for c in entity.columns]
    return raw.select(
        *texts,
        MALFORMED,
        F.col("_metadata.file_name").alias("_stg_file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_stg_load_ts"),
        F.localtimestamp().alias("_copy_ts"),
    )


def extract_schema(entity: Entity) -> T.StructType:
    return T.StructType([*entity.stage_schema().fields, T.StructField(MALFORMED, T.StringType())])


def read_extract(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    reader = spark.read.schema(extract_schema(entity)).options(**CSV_OPTIONS)
    return _with_audit(reader.csv(path), entity)


def stream_extract(
    spark: SparkSession, path: str, entity: Entity, files_per_batch: int | None = None
) -> DataFrame:
    """The same rows as a stream over a landing folder."""
    reader = spark.readStream.schema(extract_schema(entity)).options(**CSV_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_audit(reader.csv(path), entity)
