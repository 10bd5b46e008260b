"""The package on the executors, for functions that run there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package's source to Spark, which copies it to every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        name = Path(tempfile.mkdtemp(prefix="tidemark-package-"), f"{PACKAGE.name}.zip")
        with zipfile.ZipFile(name, "w") as out:
            for path in sorted(PACKAGE.rglob("*.py")):
                out.write(path, path.relative_to(PACKAGE.parent))
        context.addPyFile(str(name))
        _shipped.add(context.applicationId)
    return spark
