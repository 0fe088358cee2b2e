"""Helpers shared by the operators."""

from __future__ import annotations

import gc
import math
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import scratch, written

#: A word: a run without space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: What a task gets from Spark at a time: so many rows or bytes at most.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 * 2**20


@cache
def _archive() -> str:
    """The package's code in one file."""
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    return str(path)


@cache
def _ship(application: str, context: SparkContext) -> None:
    context.addPyFile(_archive())


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """What every operator with Python tasks needs: this package there, and Arrow batches of bounded size.

    The batches stay bounded from here on, whatever the texts are long.
    """
    _ship(spark.sparkContext.applicationId, spark.sparkContext)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def replaced(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with the column ``name``, in place of any of that name."""
    others = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return df.select(*others, column.alias(name))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back, so that lost executors cost no recomputation."""
    return written(df, scratch(df.sparkSession, label))


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage; Spark then removes shuffle files that nothing refers to.

    For jobs of many written steps, which would else keep the shuffles of all steps to the end.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def only(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Just these columns under names of our own, so that other columns cannot clash."""
    return df.select(
        *[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def hex60(*parts: Column) -> Column:
    """A hash of 60 bits that other engines have too: the first 15 hex digits of an MD5 sum."""
    digits = F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def count_below(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are smaller than the key: coarse steps, then those of one part."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts) - 1) + 1
    every = F.array(*[F.lit(c).cast("long") for c in cuts])
    coarse = F.array(*[F.lit(c).cast("long") for c in cuts[step - 1 :: step]])
    skipped = F.size(F.filter(coarse, lambda c: c < key)) * step
    return skipped + F.size(F.filter(F.slice(every, skipped + 1, step), lambda c: c < key))
