"""Event time in streams: windows with late rows, sessions, and joins of two streams.

Every function takes what has arrived since the last call and stops; its checkpoint says where to go on, and open
windows, sessions and unmatched rows are in its state until the watermark has passed them.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.upsert import optional
from tidemark.sources.tables import gathered, parts_of, read_table, replace_parts
from tidemark.streaming import feed

MONTH = "_month"
_MARK = T.StructType([T.StructField("watermark", T.LongType()), T.StructField("batch", T.IntegerType())])


def span(length: timedelta) -> str:
    """As Spark reads intervals."""
    return f"{round(length / timedelta(microseconds=1))} microseconds"


def triage(arrived: DataFrame, root: str, time: str, window: timedelta, delay: timedelta) -> None:
    """Split what arrives into ``root/in_time`` and ``root/late``, by batch.

    The watermark of a batch is the greatest time of all batches before it, less ``delay``. A row is late if
    its window (of the length ``window``, from 1970 on) ended at or before that; a row without a time is kept
    with the late ones. A batch that is handed over again after a failure replaces what it wrote, and finds
    the same watermark, as that depends on earlier batches only.
    """
    spark, micros = arrived.sparkSession, round(window / timedelta(microseconds=1))

    def apply(rows: DataFrame, tag: str) -> None:
        number = int(tag.rsplit("#", 1)[-1])
        marks = read_table(spark, f"{root}/marks", _MARK).filter(F.col("batch") < number)
        before = marks.agg(F.max("watermark")).first()[0]
        at = f"unix_micros(CAST({time} AS timestamp))"
        ends = f"(floor({at} / {micros}L) + 1) * {micros}L"
        late = "false" if before is None else f"{ends} <= {before}L"
        reason = f"CASE WHEN {time} IS NULL THEN 'no time' WHEN {late} THEN 'late' END"
        marked = rows.withColumn("late_reason", F.expr(reason))
        marked.persist()
        try:
            held, on_time = (marked.filter(f"late_reason IS {n} NULL") for n in ("NOT", ""))
            held.write.mode("overwrite").parquet(f"{root}/late/batch={number}")
            on_time.drop("late_reason").write.mode("overwrite").parquet(f"{root}/in_time/batch={number}")
            newest = marked.agg(F.max(F.expr(at))).first()[0]
        finally:
            marked.unpersist()
        reached = [x for x in (before, None if newest is None else newest - round(delay / timedelta(microseconds=1))) if x is not None]
        mark = spark.createDataFrame([(max(reached) if reached else None,)], "watermark long")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/batch={number}")

    feed.drain(arrived, f"{root}/_checkpoints/triage", apply)


def window_totals(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    time: str,
    key: str,
    amount: str,
    window: timedelta,
    delay: timedelta,
) -> None:
    """Sum ``amount`` by window and ``key`` over the rows that ``triage`` let pass, into ``root/totals``.

    The sums are state of the query until the watermark closes their window; each batch writes the sums it
    changed in place of the stored ones. This watermark is never ahead of the one of ``triage``, as only
    whole batches of that are read, so nothing is dropped here.
    """
    # The batch's folder is a column of the source, though none of the result.
    wanted = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    arrived = feed.changes(spark, wanted, f"{root}/in_time").withColumn(time, F.col(time).cast("timestamp"))
    sums = (
        arrived.withWatermark(time, span(delay))
        .groupBy(F.window(time, span(window)).alias("_window"), F.col(key))
        .agg(F.sum(amount).alias("amount"), F.count("*").alias("events"))
        .select(F.col("_window.start").alias("window_start"), key, "amount", "events")
    )

    def apply(rows: DataFrame, tag: str) -> None:
        changed = rows.withColumn(MONTH, F.expr("year(window_start) * 100 + month(window_start)"))
        changed.persist()
        try:
            months = parts_of(changed, MONTH)
            if months:
                kept = totals(spark, root, sums.schema, months)
                same = (kept["window_start"] == changed["window_start"]) & kept[key].eqNullSafe(changed[key])
                merged = kept.join(changed, same, "left_anti").unionByName(changed)
                replace_parts(gathered(merged, MONTH), f"{root}/totals", MONTH)
        finally:
            changed.unpersist()

    writer = sums.writeStream.outputMode("update").foreachBatch(lambda rows, number: apply(rows, str(number)))
    _finish(spark, writer.option("checkpointLocation", f"{root}/_checkpoints/totals"))


def totals(spark: SparkSession, root: str, schema: T.StructType, months: list[int] | None = None) -> DataFrame:
    return read_table(spark, f"{root}/totals", optional(schema), MONTH, months)


def late_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows that came too late, with ``late_reason`` and the ``batch`` they came in."""
    extra = [T.StructField("late_reason", T.StringType()), T.StructField("batch", T.IntegerType())]
    return read_table(spark, f"{root}/late", T.StructType([*schema.fields, *extra]))


def sessions(arrived: DataFrame, user: str, time: str, amount: str, gap: timedelta, delay: timedelta) -> DataFrame:
    """A stream of the sessions that the watermark has closed, as ``operators.sessions`` defines them."""
    timed = arrived.withColumn(time, F.col(time).cast("timestamp")).filter(F.col(time).isNotNull())
    return (
        timed.withWatermark(time, span(delay))
        .groupBy(F.session_window(time, span(gap)).alias("_window"), F.col(user))
        .agg(F.count("*").alias("events"), F.sum(amount).alias("amount"), F.max(time).alias("session_end"))
        .select(user, F.col("_window.start").alias("session_start"), "session_end", "events", "amount")
    )


def within(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    before: timedelta,
    after: timedelta,
    delay: timedelta,
) -> DataFrame:
    """Each row of ``left`` with the rows of ``right`` of its key from ``before`` ahead of it to ``after`` behind it.

    A left row without any comes out alone, in a stream once both watermarks have passed its last chance; until
    then both sides are kept as state, and no longer. On tables it is the plain left join.
    """
    one = left.withColumn(left_time, F.col(left_time).cast("timestamp")).withWatermark(left_time, span(delay))
    two = right.withColumn(right_time, F.col(right_time).cast("timestamp")).withWatermark(right_time, span(delay))
    two = two.withColumnRenamed(key, "_key")
    near = F.expr(
        f"{key} = _key AND {right_time} >= {left_time} - INTERVAL {span(before)}"
        f" AND {right_time} <= {left_time} + INTERVAL {span(after)}"
    )
    return one.join(two, near, "leftOuter").drop("_key")


def collect(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append what a stream has finished to the table ``path``, each row once, and stop."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    _finish(rows.sparkSession, writer.option("checkpointLocation", checkpoint))


def _finish(spark: SparkSession, writer: DataStreamWriter) -> None:
    """Run a stateful query over what is there.

    State is in as many parts as the cluster has cores when the query first starts: each part is a store of its
    own, with files for every batch, and adaptive execution cannot merge them.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.sparkContext.defaultParallelism)
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, before)
    query.awaitTermination()
