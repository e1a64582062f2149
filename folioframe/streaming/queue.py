"""The restartable queue as a stream: each run takes what has come in since the last, and only that."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def incoming(spark: SparkSession, path: str, pattern: str = "*.idml") -> DataFrame:
    """Package files as they arrive; the checkpoint remembers which were taken."""
    return spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def drain(files: DataFrame, work: Callable[[DataFrame], DataFrame], results: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop. ``work`` gives a result row a package; its failures are rows, so one does not stop others.

    Results of a batch go to a folder named by its number, so a batch that runs
    again after a failure replaces its rows.
    """

    def each(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{results}/batch={number}")

    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, event_type, n): arrivals in windows of event time, late rows dropped beyond the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width),
        "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), "event_type", "n")


def count_arrivals(events: DataFrame, results: str, checkpoint: str) -> StreamingQuery:
    """``arrivals`` of a stream, kept whole at ``results``; what has come in is counted and the stream stops."""

    def each(counts: DataFrame, number: int) -> None:
        counts.write.mode("overwrite").parquet(results)

    stream = arrivals(events).writeStream.outputMode("complete").foreachBatch(each)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
