"""Structured Streaming jobs: message ingestion and scoring of what was ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gearwatch import schema as S
from gearwatch.functions.messages import encode_messages, parse_messages
from gearwatch.plans.rule_run import run_rule_scoring
from gearwatch.plans.store import Store


def read_message_files(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of ``arrival_seq``, ``arrival_part`` and ``body`` from Parquet files; every file counts by itself."""
    return (spark.readStream.schema("arrival_seq bigint, body string")
            .option("maxFilesPerTrigger", files_per_batch).parquet(path)
            .select("arrival_seq", F.col("_metadata.file_name").alias("arrival_part"), "body"))


def ingest_stream(store: Store, arrivals: DataFrame, feed: str, checkpoint: str, *,
                  default_source: str = "UNKNOWN", drain: bool = True, interval: str = "5 seconds") -> StreamingQuery:
    """Parse, quarantine, deduplicate and append raw readings, one commit per micro-batch.

    Offsets advance after the table commit. A batch that is repeated is recognised by its id,
    and redelivered readings by their natural key. ``drain`` stops when the source is used up.
    Messages are dealt to all cores before they are parsed: a batch has few files, of any size.
    """
    def commit(batch: DataFrame, batch_id: int) -> None:
        dealt = batch.repartition(store.spark.sparkContext.defaultParallelism)
        store.ingest(parse_messages(dealt, default_source=default_source), f"{feed}-{batch_id}")

    writer = arrivals.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start()


def score_stream(store: Store, checkpoint: str, *, drain: bool = True, interval: str = "60 seconds",
                 window_cycles: int = S.CONTEXT_ROWS) -> StreamingQuery:
    """Incremental rule scoring after each committed ingest.

    The stream follows the small ingest log; the readings are taken from the raw table past the
    checkpoint, so a repeated batch finds nothing new.
    """
    log = (store.spark.readStream.schema(S.INGESTS).option("maxFilesPerTrigger", 1).parquet(f"{store.root}/ingests"))

    def run(batch: DataFrame, batch_id: int) -> None:
        last = batch.agg({"to_raw_id": "max"}).first()[0]
        if last is not None:
            run_rule_scoring(store, "stream", window_cycles, up_to=last)

    writer = log.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start()


def machine_feed(messages: DataFrame) -> DataFrame:
    """A second machine feed as messages of the common form: parsed, checked and encoded again.

    Works on batches and streams. Bad messages are left out here and counted by the caller.
    """
    from gearwatch.functions.messages import accepted
    return encode_messages(accepted(parse_messages(messages, default_source="MQTT")))
