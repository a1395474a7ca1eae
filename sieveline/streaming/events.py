"""Streaming forms: exactly-once ingestion within an overlap, run until the input is used up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.runtime import shared_dir


def deduplicated(stream: DataFrame, key: str, at: str, overlap: str = "7 days") -> DataFrame:
    """First arrival of each key; state of keys older than the overlap is dropped."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp"))
    return timed.withWatermark(at, overlap).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, spark: SparkSession, checkpoint: str | None = None) -> DataFrame:
    """Writes what is there now as a table and reads it; with a lasting checkpoint a later run goes on from there."""
    root = checkpoint or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    run = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{root}/out")
