"""Where intermediate tables may be written."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names, else one below the warehouse.

    ``spark.checkpoint.dir`` is read from the session. The warehouse is shared by definition, so the
    fallback holds on a cluster as well as in a test; nothing depends on the kind of master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    # Registered only for a folder that is there.
    files.mkdirs(target)
    files.deleteOnExit(target)
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and read it back: a cut in the lineage that outlives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove tables in the shared folder that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def side_by_side(spark: SparkSession, tasks: Iterable[Callable[[], object]], at_once: int = 9) -> list:
    """Run independent jobs from several threads, so that small tables do not queue behind large ones.

    All are given the chance to finish; the first failure is raised afterwards.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    return [r.result() for r in running]
