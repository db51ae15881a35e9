"""Streaming readers and payload parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import expressions as X


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                 max_files: int = 10_000) -> DataFrame:
    """File stream with an explicit schema, in micro-batches of at most ``max_files`` files.

    A path may name a folder or one file; written as a glob pattern, both are accepted.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return reader.format(fmt).load(f"{path[:-1]}[{path[-1]}]")


SENSOR_SCHEMA = "sensor_id string, timestamp string, temperature double, humidity double, status string"


def parse_records(records: DataFrame, schema: str, event_time_from: str | None = None,
                  extra: tuple[str, ...] = ()) -> DataFrame:
    """Columns of the JSON payload; text that is not valid JSON gives null columns.

    ``event_time_from`` names a text column to parse into ``event_time``.
    """
    parsed = records.select(*extra, F.from_json(F.col("value").cast("string"), schema).alias("data"))
    flat = parsed.select(*extra, "data.*")
    if event_time_from:
        flat = flat.withColumn("event_time", X.parse_event_time(F.col(event_time_from)))
    return flat


def with_event_time(df: DataFrame, column: str, delay: str, name: str = "event_time") -> DataFrame:
    """Timestamp column with a watermark; watermarks need TIMESTAMP, not TIMESTAMP_NTZ."""
    return df.withColumn(name, F.col(column).cast("timestamp")).withWatermark(name, delay)
