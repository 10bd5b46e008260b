"""Run every batch folder that has arrived, each once.

A batch folder holds the three feeds; it is complete when a non-empty file ``<batch_id>.ready``
appears beside it in the inbox. The stream's checkpoint remembers which batches were done. A batch that is
cut off is run again from its start. A batch that fails changes nothing in the lake and does not
hold up the others; all failures are raised together at the end, and a batch is tried again when
its marker arrives anew under another name or with another checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.batch import run_pipeline
from tidemark.scratch import checkpoint_root
from tidemark.session import tune


def run_arrivals(
    spark: SparkSession, inbox: str, target_dir: str, checkpoint: str | None = None, **options
) -> None:
    """Process the batches now waiting in ``inbox``, oldest name first; raise what failed."""
    failed: dict[str, Exception] = {}
    spark = tune(spark)
    root = inbox.rstrip("/")
    checkpoint = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/arrivals"

    def run_waiting(markers: DataFrame, _: int) -> None:
        for row in markers.select("batch_id").distinct().orderBy("batch_id").collect():
            name = row["batch_id"]
            try:
                run_pipeline(spark, f"{root}/{name}", target_dir, batch_id=name, **options)
            except Exception as error:
                failed[name] = error

    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)\.ready$", 1)
    markers = (
        spark.readStream.schema("value string")
        .option("pathGlobFilter", "*.ready")
        .option("wholetext", True)
        .text(root)
        .select(name.alias("batch_id"))
    )
    stream = (
        markers.writeStream.foreachBatch(run_waiting)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    if failed:
        raise ExceptionGroup(f"batches that failed: {', '.join(failed)}", list(failed.values()))
