"""The newest version of every key, carried from batch to batch.

Rows lie in buckets by a hash of their key. A batch reads and rewrites only the buckets its own keys fall
into; the others stay where earlier batches wrote them and are not opened. Which run wrote each bucket stands in
the pointer that the batch creates at its end, so a batch counts as a whole or not at all, and of two that
began after the same pointer the later one is told so. A batch that is applied again changes nothing: rows equal in all
columns are one version.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import keep_one, newest_first
from tidemark.scratch import Scratch
from tidemark.sinks import commits

BUCKETS = 256
POINTED = "state"  # the name under which pointers are kept


class KeyedState:
    """A table of one row per key: the one that is newest by ``order``, ties broken by all other columns."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS):
        """``buckets`` holds for a new table; an existing one keeps its own."""
        self.spark, self.root, self.keys, self.order = spark, root.rstrip("/"), list(keys), list(order)
        self.buckets = buckets

    def _pointer(self) -> tuple[int, dict]:
        return commits.newest(self.spark, self.root, POINTED) or (0, {"buckets": self.buckets, "runs": {}, "schema": None})

    def _folder(self, run: str, bucket: int) -> str:
        return f"{self.root}/rows/run_id={run}/bucket={bucket}"

    def _read(self, state: dict, wanted=None) -> DataFrame | None:
        runs = state["runs"].items() if wanted is None else [(b, r) for b, r in state["runs"].items() if int(b) in wanted]
        paths = [self._folder(run, int(bucket)) for bucket, run in runs]
        if not paths:
            return None
        return self.spark.read.schema(state["schema"]).parquet(*paths)

    def read(self) -> DataFrame | None:
        """All current rows; None before the first batch."""
        return self._read(self._pointer()[1])

    def apply(self, versions: DataFrame) -> DataFrame:
        """Take in a batch of versions. Returns all versions now known of the touched buckets' keys that are current or
        were until now, and those of the batch, with ``is_current``."""
        number = commits.last_number(self.spark, self.root, POINTED)
        _, state = self._pointer()
        scratch, run = Scratch(self.spark), commits.new_run()
        place = F.pmod(F.xxhash64(*self.keys), F.lit(state["buckets"])).cast("int")
        fresh = scratch.keep(versions.withColumn("bucket", place), "fresh")
        touched = sorted(row["bucket"] for row in fresh.select("bucket").distinct().collect())  # at most all buckets
        older = self._read(state, set(touched))
        rows = fresh if older is None else fresh.unionByName(older.withColumn("bucket", place))
        rest = [name for name in sorted(versions.columns) if name not in (*self.keys, *self.order)]
        order = newest_first([*self.order, *rest])
        current = keep_one(rows, self.keys, order)
        # the bucket's rows are dealt to as many tasks as there are buckets, each written as one folder
        current.repartition(len(touched) or 1, "bucket").write.partitionBy("bucket").option("compression", "zstd").parquet(
            f"{self.root}/rows/run_id={run}"
        )
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in versions.schema.fields)
        written = {**state["runs"], **{str(bucket): run for bucket in touched}}
        pointer = {"run_id": run, "buckets": state["buckets"], "runs": written, "schema": schema}
        commits.point(self.spark, self.root, POINTED, pointer, number)
        kept = self._read(pointer, set(touched))
        if kept is None:
            return rows.withColumn("is_current", F.lit(True)).drop("bucket")
        signs = [
            kept.select(*versions.columns).withColumn("_now", F.lit(1)),
            rows.select(*versions.columns).withColumn("_now", F.lit(0)),
        ]
        known = reduce(DataFrame.unionByName, signs).groupBy(*versions.columns).agg(F.max("_now").alias("_now"))
        return known.select(*versions.columns, (F.col("_now") == 1).alias("is_current"))

    def runs(self) -> dict[int, str]:
        """The run that wrote each bucket."""
        return {int(bucket): run for bucket, run in self._pointer()[1]["runs"].items()}

    def prune(self) -> None:
        """Remove what no bucket of the newest pointer lies in."""
        used = set(self.runs().values())
        for name in commits.names(self.spark, f"{self.root}/rows"):
            if name.startswith("run_id=") and name.removeprefix("run_id=") not in used:
                commits.delete(self.spark, f"{self.root}/rows/{name}")
