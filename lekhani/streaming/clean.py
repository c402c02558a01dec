"""Cleaning of arriving documents with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lekhani.config import Config
from lekhani.operators import clean
from lekhani.sources.readers import string_schema


def read_json_stream(spark: SparkSession, folder: str, columns: list[str], files_per_trigger: int = 100) -> DataFrame:
    """New JSON files of a folder, all-string columns."""
    return spark.readStream.schema(string_schema(columns)).option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def first_seen(stream: DataFrame, time_col: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Each key once; keys older than the delay behind the newest are forgotten."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def clean_stream(stream: DataFrame, passthrough: list[str], config: Config = Config()) -> DataFrame:
    """Cleaned documents of a stream; all steps are row-local, no state is kept."""
    return clean.clean_documents(stream, passthrough, config)[0]


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to parquet, exactly once, for what is there now."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()
