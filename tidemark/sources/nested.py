"""Extracts of JSON documents, one per line: typed nested columns, unknown fields kept, faulty documents set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED, RAW, REASON = "_rescued", "_raw", "reject_reason"


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Documents that can be loaded, with ``_rescued``; and the others as text with the reason.

    ``_rescued`` maps each field that the schema does not name to its JSON text, so nothing a sender adds is
    lost; NULL if there is none. A document is rejected if it is no JSON object, if a field does not have its type
    (at any depth: then what is read differs from what is there), or if a required field is missing or null. An
    absent or null field that is not required is NULL. Empty lines are no documents.
    """
    lines = spark.read.text(path).withColumnRenamed("value", RAW).filter(F.trim(F.col(RAW)) != "")
    fields = F.from_json(RAW, T.MapType(T.StringType(), T.StringType()))
    parsed = F.from_json(RAW, schema)
    known = [f.name for f in schema.fields]
    read = lines.select(
        RAW,
        F.json_object_keys(RAW).isNotNull().alias("_object"),
        fields.alias("_fields"),
        parsed.alias("_row"),
    )
    wrong = [F.when(_misread(f), F.lit(f.name)) for f in schema.fields]
    missing = [F.when(F.col(f"_row.{n}").isNull(), F.lit(n)) for n in required]
    reason = F.coalesce(
        F.when(~F.col("_object") | F.col("_fields").isNull(), "no JSON object"),
        F.concat(F.lit("wrong type: "), F.nullif(F.concat_ws(",", *wrong), F.lit(""))),
        F.concat(F.lit("missing: "), F.nullif(F.concat_ws(",", *missing), F.lit(""))) if missing else F.lit(None),
    )
    judged = read.withColumn(REASON, reason)
    other = F.map_filter("_fields", lambda k, _: ~k.isin(known))
    rescued = F.when(F.cardinality(other) > 0, other)
    accepted = judged.filter(f"{REASON} IS NULL").select("_row.*", rescued.alias(RESCUED))
    return accepted, judged.filter(f"{REASON} IS NOT NULL").select(RAW, REASON)


def _misread(field: T.StructField) -> Column:
    """A field that is there, and is not what the schema says."""
    there, row = F.col("_fields").getItem(field.name), F.col("_row").getField(field.name)
    return there.isNotNull() & (row.isNull() | _lost(row, there, field.dataType))


def _lost(row: Column, text: Column, kind: T.DataType) -> Column:
    """Parts of a nested value that are null in ``row`` and are not in the document."""
    if isinstance(kind, T.StructType):
        parts = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
        lost = F.lit(False)
        for part in kind.fields:
            value, inner = row.getField(part.name), parts.getItem(part.name)
            lost = lost | (inner.isNotNull() & (value.isNull() | _lost(value, inner, part.dataType)))
        return F.coalesce(lost, F.lit(False))
    if isinstance(kind, T.ArrayType):
        parts = F.from_json(text, T.ArrayType(T.StringType()))
        pairs = F.zip_with(row, parts, lambda v, t: t.isNotNull() & v.isNull())
        return F.coalesce(F.exists(pairs, lambda x: x) | (F.size(row) != F.size(parts)), F.lit(False))
    if isinstance(kind, T.MapType):
        parts = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
        pairs = F.map_zip_with(row, parts, lambda _, v, t: t.isNotNull() & v.isNull())
        return F.coalesce(F.exists(F.map_values(pairs), lambda x: x), F.lit(False))
    return F.lit(False)
