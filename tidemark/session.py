"""Session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL settings, safe to set on a session somebody else started.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles begin with this many partitions and are merged to the size that data has: with as few as cores, the
    # memory of one task would grow with the input.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where the next operator then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A stored table is larger in memory than on disk; broadcast by the size it will have.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Long rule chains compile to methods the JVM would not optimise; run them as several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go when the query that wrote them is over, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # batch_id=001 is a name, not the number 1.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


# With both at more bytes than a file has, files are not split, and none shares a task with another.
WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}


def tune(spark: SparkSession) -> SparkSession:
    """A session of the same application with the library's settings on top of the caller's; the
    caller's own session stays as it is."""
    if all(spark.conf.get(key, None) == value for key, value in RUNTIME.items()):
        return spark
    return _with(spark, RUNTIME)


def whole_files(spark: SparkSession) -> SparkSession:
    """A session like the caller's whose scans read every file in one task of its own, in order."""
    return _with(spark, WHOLE_FILES)


def _with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    other = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def local_session(name: str = "tidemark", cores: int | None = None) -> SparkSession:
    """A session for one machine. On a cluster, pass your own session to ``tune``."""
    cores = cores or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
