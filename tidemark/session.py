"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Explicit-format timestamps pass through a zoned type, so the zone must have no gaps.
    "spark.sql.session.timeZone": "UTC",
    # Intermediate tables are written once and read once or twice; this is about a third smaller than the default.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A query's shuffle files go when it ends, not when the driver happens to collect its garbage. What is run again
    # after that is computed again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Split a hot order, customer or menu item even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

LAUNCH_SETTINGS = {
    "spark.ui.enabled": "false",
    # Call sites on every column expression cost several round trips to the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; ``settings`` uses ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in (LAUNCH_SETTINGS | RUNTIME_SETTINGS).items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
