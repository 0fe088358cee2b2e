"""Sessions: runs of a user's events without a longer pause than the gap.

A user's events are cut into slices of time. Inside a slice a window finds the pauses; across slices a window
over one row per slice finds whether the first session goes on from the slice before, and how many sessions
lie ahead. So a user with a third of all events is as many small windows as there are slices.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hours of a slice.
SLICE_HOURS = 24


def user_sessions(
    events: DataFrame, user: str, time: str, amount: str, gap: timedelta, slice_hours: int = SLICE_HOURS
) -> DataFrame:
    """One row per session: ``user``, ``session_start``, ``session_end`` (times of its first and last event),
    ``events`` and ``amount`` (its sum).

    Two events of a user that lie ``gap`` or less apart belong together. Events without a user or a time are in
    no session. Events of one user and time are counted together ahead of the first shuffle.
    """
    longest = round(gap / timedelta(microseconds=1))
    width = slice_hours * 3_600_000_000
    moments = (
        events.select(F.col(user).alias("_user"), F.col(time).cast("timestamp").alias("_at"), F.col(amount).alias("_amount"))
        .filter("_user IS NOT NULL AND _at IS NOT NULL")
        .groupBy("_user", "_at")
        .agg(F.count("*").alias("_events"), F.sum("_amount").alias("_amount"))
        .withColumn("_micros", F.expr("unix_micros(_at)"))
        .withColumn("_slice", F.expr(f"floor(_micros / {width}L)"))
    )
    inside = Window.partitionBy("_user", "_slice").orderBy("_micros")
    pause = F.col("_micros") - F.lag("_micros").over(inside) > longest
    marked = moments.withColumn("_begins", F.when(pause, 1).otherwise(0))
    marked = marked.withColumn("_local", F.sum("_begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = marked.groupBy("_user", "_slice", "_local").agg(
        F.min("_micros").alias("_first"),
        F.max("_micros").alias("_last"),
        F.sum("_events").alias("_events"),
        F.sum("_amount").alias("_amount"),
    )
    slices = pieces.groupBy("_user", "_slice").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.max("_local").alias("_breaks")
    )
    by_slice = Window.partitionBy("_user").orderBy("_slice")
    fresh = F.coalesce(F.col("_first") - F.lag("_last").over(by_slice) > longest, F.lit(True)).cast("int")
    slices = slices.withColumn("_fresh", fresh)
    # Sessions that begin before this slice's first one, and with it.
    ahead = F.sum(F.col("_fresh") + F.col("_breaks")).over(by_slice.rowsBetween(Window.unboundedPreceding, 0))
    slices = slices.select("_user", "_slice", (ahead - F.col("_breaks")).alias("_ahead"))
    whole = pieces.join(slices, ["_user", "_slice"]).withColumn("_number", F.col("_ahead") + F.col("_local"))
    return (
        whole.groupBy("_user", "_number")
        .agg(
            F.expr("timestamp_micros(min(_first))").alias("session_start"),
            F.expr("timestamp_micros(max(_last))").alias("session_end"),
            F.sum("_events").alias("events"),
            F.sum("_amount").alias("amount"),
        )
        .select(F.col("_user").alias(user), "session_start", "session_end", "events", "amount")
    )
