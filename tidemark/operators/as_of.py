"""As-of joins: each row meets the version of its key that was valid at the row's time.

Versions and the distinct (key, time) pairs of the rows are put in one order, and the last version is carried
forward. That is done in slices of time: inside a slice by a window over (key, slice), across slices by a
window over one row per slice. So a key with very many versions or rows is spread over its slices, and no
pair of a row and a version that does not fit it is ever made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import splittable_join

#: Days of a slice.
SLICE_DAYS = 7


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    since: str = "eff_start_date",
    until: str | None = "eff_end_date",
    early: bool = False,
    how: str = "inner",
    slice_days: int = SLICE_DAYS,
    points: DataFrame | None = None,
) -> DataFrame:
    """``rows`` with the ``columns`` of the version of ``key`` that begins last at or before the time ``at``.

    A version is valid from ``since`` until just before ``until`` (None or NULL: until the next one begins);
    a row that falls in a gap has none. ``early`` gives rows before their key's first version that first one.
    Of versions that begin at one time the one with the greatest ``columns`` counts. ``how`` is ``inner`` or
    ``left``; a NULL key or time finds no version. ``columns`` must be orderable and not in ``rows``.
    ``points`` are rows with all keys and times that ``rows`` have, where such are cheaper to make.
    """
    width = f"{86_400 * slice_days}L"
    closing = f"CAST({until} AS timestamp)" if until else "CAST(NULL AS timestamp)"
    begun = versions.selectExpr(
        f"{key} AS _key",
        f"CAST({since} AS timestamp) AS _at",
        f"named_struct('until', {closing}, {', '.join(f'{c!r}, {c}' for c in columns)}) AS _version",
    ).filter("_key IS NOT NULL AND _at IS NOT NULL")
    source = rows if points is None else points
    asked = source.selectExpr(f"{key} AS _key", f"CAST({at} AS timestamp) AS _at").distinct()
    asked = asked.filter("_key IS NOT NULL AND _at IS NOT NULL").withColumn("_version", F.lit(None))
    # Slices are looked at twice, as wholes and inside. Both read one shuffle, as long as nothing is asked of one only:
    # hence a slice that cannot be NULL (times are not), for which a join has no test to add.
    slice_of = F.coalesce(F.expr(f"floor(unix_seconds(_at) / {width})"), F.lit(0).cast("long"))
    marks = begun.unionByName(asked).withColumn("_slice", slice_of)
    marks = marks.repartition("_key", "_slice")
    mark = F.when(F.col("_version").isNotNull(), F.struct("_at", "_version"))
    slices = marks.groupBy("_key", "_slice").agg(F.max(mark).alias("_last"), F.min(mark).alias("_first"))
    by_slice = Window.partitionBy("_key").orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    every = by_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slices = slices.select(
        "_key",
        "_slice",
        F.last("_last", True).over(earlier)["_version"].alias("_before"),
        F.first("_first", True).over(every)["_version"].alias("_earliest"),
    )
    # A version that begins at a row's time is ahead of the row.
    inside = Window.partitionBy("_key", "_slice").orderBy("_at", F.col("_version").isNull(), "_version")
    carried = marks.withColumn("_inside", F.last("_version", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    carried = carried.filter("_version IS NULL").join(slices, ["_key", "_slice"])
    found = F.coalesce("_inside", "_before")
    found = F.when(found["until"].isNull() | (F.col("_at") < found["until"]), found)
    if early:
        found = F.when(F.coalesce("_inside", "_before").isNull(), F.col("_earliest")).otherwise(found)
    looked_up = carried.select("_key", "_at", found.alias("_found")).filter("_found IS NOT NULL")
    looked_up = looked_up.select("_key", "_at", *[F.col(f"_found.{c}").alias(c) for c in columns])
    keyed = rows.selectExpr("*", f"{key} AS _key", f"CAST({at} AS timestamp) AS _at")
    return splittable_join(keyed, looked_up, ["_key", "_at"], how).drop("_key", "_at")
