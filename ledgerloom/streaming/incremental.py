"""Incremental forms of the scan and of content decisions, by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, folder: str, max_files: int = 10_000) -> DataFrame:
    """A stream of the files below ``folder``, in the listing's columns, for ``cards.scan``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(folder).filter(F.lower("path").rlike(r"\.(png|json)$"))
    return files.select(F.col("path").alias("relative_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"), F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("extension"), F.col("length").alias("size_bytes"), F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("modified_utc"), "content")


def first_of_content(records: DataFrame, event_time: str, horizon: str) -> DataFrame:
    """The first record of each content that arrives within ``horizon``; state older than that is dropped."""
    return records.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["card_sha256"])


def append_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now, exactly once, and stop."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
