"""Keyed tables on plain Parquet, in a bounded number of partitions that are replaced one by one.

A table has one partition column: a hash bucket of its key, or the month of a fact row. A batch reads
the partitions that it touches and writes them anew beside the table; then each is renamed into the place
of the old one. A partition changes at once, a table partition by partition. A writer that is killed
leaves, at any moment, each partition either in its place or complete beside it: ``settle`` puts it there, or
drops what was not written to the end. A run that failed half-way is then repeated: applying a batch again
changes nothing, whichever partitions it had reached. One writer per table is assumed, and a file system that
renames a folder at once; where the catalog's tables support MERGE, use that instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folders below a table that its readers do not see: new partitions, and those they take the place of.
_STAGED, _REPLACED = "_staged", "_replaced"
#: Folders of a table whose rows are dealt out by a hash of their key.
BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    part: str | None = None,
    parts: Iterable[int] | None = None,
) -> DataFrame:
    """The rows of a table, or of some partitions; none where nothing is stored. Creates nothing."""
    wanted = schema if part is None else T.StructType([*schema.fields, T.StructField(part, T.IntegerType())])
    try:
        table = spark.read.schema(wanted).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, wanted)
    # What is read from files loses no tag, as the schema is given.
    return table if parts is None else table.filter(F.col(part).isin(list(parts)))


def gathered(rows: DataFrame, part: str) -> DataFrame:
    """The rows of a partition in few tasks, by a shuffle."""
    return rows.hint("rebalance", part)


def replace_parts(rows: DataFrame, path: str, part: str) -> None:
    """Write the partitions that ``rows`` fall in, in place of what they held.

    Each task writes a file for each partition it has rows of, so these should be ``gathered`` or lie in that order.
    """
    settle(rows.sparkSession, path)
    rows.write.mode("overwrite").partitionBy(part).parquet(f"{path}/{_STAGED}")
    settle(rows.sparkSession, path)


def settle(spark: SparkSession, path: str) -> None:
    """Finish a replacement that was cut off, or drop it if its rows were not all written."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    table, staged, replaced = of(path), of(path, _STAGED), of(path, _REPLACED)
    files = table.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(of(staged, "_SUCCESS")):
        for name in [f.getPath().getName() for f in files.listStatus(staged) if f.isDirectory()]:
            if files.exists(of(table, name)):
                files.mkdirs(replaced)
                _move(files, of(table, name), of(replaced, name))
            _move(files, of(staged, name), of(table, name))
    for done in (staged, replaced):
        if files.exists(done):
            files.delete(done, True)


def _move(files: JavaObject, old: JavaObject, new: JavaObject) -> None:
    if not files.rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")


def parts_of(rows: DataFrame, part: str) -> list[int]:
    """The partitions that rows fall in: at most as many as the table can have."""
    return sorted(r[0] for r in rows.select(part).distinct().collect())


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame the optimizer knows to be empty, with the schema's tags."""
    columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
    return spark.sql(f"SELECT {', '.join(columns)} WHERE false").to(schema)
