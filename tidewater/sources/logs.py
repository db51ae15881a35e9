"""Message logs: Kafka readers, record-shaped tables, partition statistics and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_batch(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Bounded read of a whole topic; needs the Kafka connector on the class path."""
    defaults = {"startingOffsets": "earliest", "endingOffsets": "latest"}
    return (
        spark.read.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, **defaults, **options})
        .load()
    )


def kafka_options(servers: str, topic: str, starting: str = "earliest", per_trigger: int = 1_000_000,
                  fail_on_data_loss: bool = False, group_prefix: str | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(per_trigger), "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    return options | ({"groupIdPrefix": group_prefix} if group_prefix else {})


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Unbounded read of a topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def as_records(df: DataFrame, key: str, offset: str, partitions: int, topic: str,
               payload: list[str] | None = None, time: Column | None = None) -> DataFrame:
    """Rows in the shape of log records, with a JSON value; the key picks the partition."""
    payload = payload or df.columns
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*payload)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col(key), F.lit(partitions)).cast("int").alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        (F.current_timestamp() if time is None else time).alias("timestamp"),
    )


def partition_stats(records: DataFrame, time: str = "timestamp") -> DataFrame:
    """Records, offset range and records per second of each partition."""
    seconds = F.unix_timestamp(F.max(time)) - F.unix_timestamp(F.min(time))
    return records.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.round(F.try_divide(F.count(F.lit(1)), seconds), 6).alias("records_per_sec"),
    )


def consumer_lag(high: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per partition = high watermark - committed offset; nothing committed means offset 0."""
    done = F.coalesce(F.col("committed"), F.lit(0))
    return high.join(committed, ["topic", "partition"], "left").select(
        "topic", "partition", "high_watermark", done.alias("committed"),
        F.greatest(F.col("high_watermark") - done, F.lit(0)).alias("lag"),
        F.col("high_watermark").alias("safe_offset"))
