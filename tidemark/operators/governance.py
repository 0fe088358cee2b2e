"""Masking driven by column tags, which every table of the layers carries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import Dimension, Entity

ALLOWED_TAGS = ("PII", "EMAIL", "PHONE")
PRIVILEGED_ROLE = "PII_VIEWER"
REDACTED = "***MASKED***"


class TagMissing(ValueError):
    """A column that has to be hidden came without its tag, so the frame cannot be shown."""


def tagged_columns(df: DataFrame) -> dict[str, str]:
    """Column name to tag, read from the schema."""
    tags = {f.name: f.metadata["pii"] for f in df.schema.fields if "pii" in f.metadata}
    unknown = sorted(set(tags.values()) - set(ALLOWED_TAGS))
    if unknown:
        raise ValueError(f"unknown column tags: {unknown}")
    return tags


def masked(
    df: DataFrame, role: str, of: Entity | Dimension, privileged: str = PRIVILEGED_ROLE
) -> DataFrame:
    """The frame as ``role`` may see it: tagged strings redacted, other tagged types NULL.

    ``of`` says which columns have to be tagged. One that is there without its tag raises, also for
    the privileged role: a frame that lost its tags would show everything. A projection, not a
    security boundary: whoever can read the underlying files sees all of it.
    """
    tags = tagged_columns(df)
    lost = sorted(c for c in of.tags if c in df.columns and c not in tags)
    if lost:
        raise TagMissing(f"{of.name}: no tag on {', '.join(lost)}")
    if role == privileged:
        return df

    def shown(field: T.StructField):
        if field.name not in tags:
            return F.col(field.name)
        hidden = REDACTED if isinstance(field.dataType, T.StringType) else None
        value = F.lit(hidden).cast(field.dataType)
        if hidden is not None:
            value = F.when(F.col(field.name).isNotNull(), value)
        return value.alias(field.name, metadata=field.metadata)

    return df.select(*[shown(f) for f in df.schema.fields])
