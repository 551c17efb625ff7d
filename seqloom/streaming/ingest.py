"""Structured Streaming: files as they arrive, split assignments that stay, sessions with late data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FILE = "path string, modificationTime timestamp, length long, content binary"


def arriving_projects(spark: SparkSession, folder: str, pattern: str = "*.RPP") -> DataFrame:
    """Project files of a folder, each once."""
    return spark.readStream.schema(FILE).format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)


def hashed_split(ids: Column, fraction: float) -> Column:
    """A split that needs no other rows: by the share of the SHA-256 range. Near ``fraction``, not exactly it."""
    return F.when(F.conv(F.substring(F.sha2(ids, 256), 1, 12), 16, 10).cast("double") < fraction * 16.0**12, "test").otherwise("train")


def event_counts(events: DataFrame, at: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and kind; rows later than the watermark are dropped, so state stays bounded."""
    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def first_seen(events: DataFrame, at: str, key: str, late: str = "2 hours") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])
