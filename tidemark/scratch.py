"""Intermediate tables in the cluster's shared checkpoint folder.

A frame used by several later steps is written once and read back. That cuts its lineage, so a
lost executor costs one task and not the whole chain, and it gives Spark the table's real size:
joins then broadcast by that size instead of by a hint.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import InheritableThread, SparkContext
from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if context.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


class Scratch:
    """One run's intermediate tables, dropped together when the run is over."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str | None = None) -> None:
        """Delete the folder, or what lies in it under one name."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root if name is None else f"{self.root}/{name}")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


_until_exit: list[Scratch] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once for a caller that may read the result as long as the program runs."""
    return run_scratch(df.sparkSession).keep(df, name)


def run_scratch(spark: SparkSession) -> Scratch:
    """A folder for results that may be read as long as the program runs."""
    if not _until_exit:
        atexit.register(drop_materialised)
    _until_exit.append(Scratch(spark))
    return _until_exit[-1]


def drop_materialised() -> None:
    """Drop all that ``materialise`` has written, also called when the program ends."""
    while _until_exit:
        scratch = _until_exit.pop()
        if SparkContext._active_spark_context is scratch.spark.sparkContext:
            scratch.drop()


def together(*steps):
    """Run independent jobs at the same time, in the caller's job group and pool; each step is a
    function without arguments. The first failure is raised once all have ended."""
    outcomes = [None] * len(steps)

    def run(number, step):
        try:
            outcomes[number] = (step(), None)
        except BaseException as error:  # handed to the caller below
            outcomes[number] = (None, error)

    threads = [InheritableThread(target=run, args=item) for item in enumerate(steps)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    for _, error in outcomes:
        if error is not None:
            raise error
    return [result for result, _ in outcomes]
