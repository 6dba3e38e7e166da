"""Arriving raw files as a stream: each micro-batch of files goes through the batch ingestion and is merged by match, so
a batch that runs again after a failure changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def files(spark: SparkSession, path: str, per_batch: int = 1000) -> DataFrame:
    """Whole JSON files of a folder as they arrive: value, source_file."""
    return spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", per_batch).format("text").load(path).selectExpr("value", "_metadata.file_path AS source_file")


def ingest(stream: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None], once: bool = True) -> StreamingQuery:
    """Runs ``load(batch, batch id)`` for each micro-batch; ``load`` must be a merge."""
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
