"""Landed dumps as a stream: each trigger takes new files, and a checkpoint remembers them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dumpmill.run import process_file

FILES = "path string, modificationTime timestamp, length long"


def landed_files(spark: SparkSession, folder: str, per_trigger: int = 4) -> DataFrame:
    """A stream of the dump files in a folder, paths and sizes only."""
    own = spark.readStream.format("binaryFile").option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.xml.gz").schema(FILES + ", content binary")
    return own.load(folder).select("path", "modificationTime", "length")


def ingest_stream(
    spark: SparkSession, folder: str, out: str, checkpoint: str, on_file: Callable[[str, int], Any] | None = None, once: bool = True, **options,
) -> StreamingQuery:
    """Process files as they land; with ``once`` all that are there now, then stop.

    A batch that is retried writes the same events again, keyed by (id, sha256): at least once.
    """
    def batch(files: DataFrame, epoch: int) -> None:
        for row in files.select("path").orderBy("path").collect():  # at most ``per_trigger`` names
            _, total, _ = process_file(spark, row.path, out, **options)
            if on_file:
                on_file(row.path, total)

    writer = landed_files(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def due(last: datetime | None, now: datetime, days: int = 15, asked: bool = False) -> bool:
    """Whether a scheduler should start a run: never run before, ``days`` since the last start, or asked for by hand."""
    return asked or last is None or now - last >= timedelta(days=days)


def deduplicated(events: DataFrame, delay: str = "7 days") -> DataFrame:
    """A stream of events (ts, data_type, id, sha256, ...) without repeats inside the delay: what a
    consumer of the at-least-once output applies."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["data_type", "id", "sha256"])


def progress_counts(events: DataFrame) -> DataFrame:
    """Running counts by data_type, with the time of the last record for stall detection."""
    return events.groupBy("data_type").agg(F.count("*").alias("records"), F.max("ts").alias("last"))
