"""Running tallies over the growing run log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import LOG

TALLIES = "batch long, status string, tiles long, ok_nodes long, download_ms long"


def status_counts(log: DataFrame) -> DataFrame:
    ok = F.sum(F.when(F.col("status") == "ok", F.col("nodes")).otherwise(0))
    return log.groupBy("status").agg(F.count("*").alias("tiles"), ok.alias("ok_nodes"), F.sum("download_ms").alias("download_ms"))


def run_tallies(spark: SparkSession, log: str, out: str, checkpoint: str, files_per_batch: int = 2, before_batch: Callable[[int], None] | None = None) -> DataFrame:
    """Counts per status over all log files in a folder, as one run that ends when caught up.

    Each batch of new files leaves its counts in a part of ``out`` named by its number; what was
    read is kept in ``checkpoint``. A run that was stopped, at any point, goes on from there: a
    batch done again replaces its own part, so no file counts twice or is lost. The result is the
    sum of the parts. ``before_batch`` is told each batch's number before it is counted.
    """

    def keep(rows: DataFrame, batch: int) -> None:
        if before_batch:
            before_batch(batch)
        counted = status_counts(rows).withColumn("batch", F.lit(batch).cast("long"))
        counted.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_batch).json(log)
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    return tallies(spark, out)


def tallies(spark: SparkSession, out: str) -> DataFrame:
    """The counts of all batches so far."""
    parts = spark.read.schema(TALLIES).parquet(out)
    return parts.groupBy("status").agg(*(F.sum(c).alias(c) for c in ("tiles", "ok_nodes", "download_ms")))
