"""Text to typed values, as Spark SQL expressions. What does not parse becomes NULL, never an error."""

from __future__ import annotations

from datetime import datetime

from tidemark.entities import Column


def as_key(text: str) -> str:
    """Whole number; a fraction rounds half up, which a direct cast to bigint would refuse.

    Text that is written as a whole number is, that is nearly all, takes the direct cast, which costs far less.
    """
    direct = f"try_cast({text} AS bigint)"
    return f"CASE WHEN CAST({direct} AS string) = {text} THEN {direct} ELSE try_cast(try_cast({text} AS decimal(38,0)) AS bigint) END"


def beyond_key(text: str) -> str:
    """Whether the text is a number, but not one that a key can hold."""
    return f"({as_key(text)} IS NULL AND {text} RLIKE '^\\\\s*[+-]?[0-9]+([.][0-9]*)?\\\\s*$')"


def as_decimal(text: str, precision: int, scale: int) -> str:
    return f"try_cast({text} AS decimal({precision},{scale}))"


def as_timestamp(text: str, pattern: str | None = None) -> str:
    if pattern is None:
        return f"try_cast({text} AS timestamp_ntz)"
    return f"CAST(try_to_timestamp({text}, '{pattern}') AS timestamp_ntz)"


def as_date(text: str) -> str:
    return f"try_cast({text} AS date)"


def as_flag(text: str, yes: str, fold_case: bool = False) -> str:
    """True for the one accepted spelling, false for anything else including NULL."""
    value = f"lower({text})" if fold_case else text
    return f"coalesce({value} = '{yes}', false)"


def typed(column: Column) -> str:
    """The typed expression of one configured column."""
    if column.kind == "key":
        return as_key(column.stage)
    if column.kind == "decimal":
        return as_decimal(column.stage, column.precision, column.scale)
    if column.kind == "timestamp":
        return as_timestamp(column.stage, column.pattern)
    if column.kind == "date":
        return as_date(column.stage)
    if column.kind == "flag":
        return as_flag(column.stage, column.yes, column.fold_case)
    return column.stage


def moment(ts: datetime) -> str:
    """A batch time as a zone-free timestamp literal."""
    return f"timestamp_ntz '{ts.isoformat(sep=' ')}'"
