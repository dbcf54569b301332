"""Message broker source and sink; they need the Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gearwatch.functions.messages import encode_messages


def source_options(servers: str, topic: str, max_per_batch: int | None = None) -> dict[str, str]:
    """Start at the earliest offset; offsets are kept in the query checkpoint, not in the group."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest",
               "failOnDataLoss": "true"}
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "5"}


def as_arrivals(records: DataFrame) -> DataFrame:
    """Broker records as ``arrival_seq``, ``arrival_part`` and ``body``; the number grows per partition."""
    return records.select(F.col("offset").alias("arrival_seq"), F.col("partition").cast("string").alias("arrival_part"),
                          F.col("value").cast("string").alias("body"))


def read_stream(spark: SparkSession, servers: str, topic: str, max_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**source_options(servers, topic, max_per_batch))
    return as_arrivals(reader.load())


def publish(df: DataFrame, servers: str, topic: str, dataset: str | None = None) -> None:
    encode_messages(df, dataset).write.format("kafka").options(**sink_options(servers, topic)).save()
