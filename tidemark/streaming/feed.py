"""Append-only change feeds: each run sees only what arrived since the run before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.entities import AUDIT_SCHEMA, Entity
from tidemark.sources.text_csv import extract_schema, stream_extract


def stage_table_schema(entity: Entity) -> T.StructType:
    return T.StructType([*extract_schema(entity).fields, *AUDIT_SCHEMA.fields])


def land(
    spark: SparkSession,
    entity: Entity,
    landing: str,
    stage: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Append the extracts that are new in ``landing`` to the text table, each file exactly once."""
    (
        stream_extract(spark, landing, entity, files_per_batch)
        .writeStream.format("parquet")
        .option("path", stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def changes(
    spark: SparkSession, schema: T.StructType, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet table as a stream of its appended rows."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain(
    feed: DataFrame, checkpoint: str, apply: Callable[[DataFrame, str], None]
) -> None:
    """Hand every batch not yet consumed to ``apply`` with a tag, then stop.

    A batch may be handed over again after a failure, with the same tag: ``apply`` must recognise
    the tag or be idempotent.
    """
    (
        feed.writeStream.foreachBatch(lambda rows, number: apply(rows, f"{checkpoint}#{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
