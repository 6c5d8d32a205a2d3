"""Incremental work: only what is new is done, each batch once.

The parity case is the batch resume (operators.dedupe.missing_from). `resumed` does the same with
a file stream: the folder of the checkpoint remembers which input files were done, a batch is
written under its number, and a batch that is tried again replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def resumed(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> int:
    """Run work over the Parquet files of source that were not done yet and append to target; the number of batches."""
    done = [0]

    def batch(df: DataFrame, number: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{target}/batch={number}")
        done[0] += 1

    stream = spark.readStream.schema(schema).parquet(source)
    running = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return done[0]


def windowed_counts(events: DataFrame, ts: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window and key; on a stream, rows later than `late` are dropped with their window closed (an extension)."""
    stamped = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if events.isStreaming:
        stamped = stamped.withWatermark("_ts", late)
    return stamped.groupBy(F.window("_ts", width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")
