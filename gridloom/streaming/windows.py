"""Extension, not a counterpart of a batch operator: event-time windows over a stream of event files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import cut_lineage, ensure_checkpoint_dir


def windowed_counts(events: DataFrame, time: str, kind: str, value: str, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, kind, events, total) per window; rows later than ``late`` are dropped by the watermark of a stream."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    grouped = timed.groupBy(F.window("_t", length).alias("w"), F.col(kind).alias("kind"))
    return grouped.agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), "kind", "events", "total")


def run_available(spark: SparkSession, source: DataFrame, mode: str = "complete") -> DataFrame:
    """Runs a streaming aggregation over what is there and gives its result from files in the shared folder.

    Each micro-batch replaces the result; the folder survives the loss of an executor. The
    result is checkpointed, then the stream's own folder is deleted.
    """
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"

    def store(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/result")

    query = source.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).foreachBatch(store).start()
    query.awaitTermination()
    result = cut_lineage(spark.read.parquet(f"{place}/result"))
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return result
