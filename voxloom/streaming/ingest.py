"""Incremental ingest: new audio files as a stream, finished ones remembered by the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import suffix
from ..sources.readers import AUDIO

BINARY = "path string, modificationTime timestamp, length long, content binary"


def audio_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000, types=AUDIO) -> DataFrame:
    """Audio files as they arrive; each is seen once per checkpoint."""
    return spark.readStream.format("binaryFile").schema(BINARY).option("maxFilesPerTrigger", files_per_batch).load(folder).where(suffix("path").isin(*types))


def duration_windows(stream: DataFrame, time: str, value: str, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Number and total of values per window of event time; later events than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, every)).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def write_once(stream: DataFrame, path: str, checkpoint: str):
    """Takes all that has arrived, then stops; running it again continues where it ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
