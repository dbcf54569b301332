"""Checks of the streaming jobs: each drains its source and reads the tables back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gearwatch.plans.store import Store
from gearwatch.schema import NATURAL_KEY
from gearwatch.session import scratch_folder
from gearwatch.sources.fixtures import messages
from gearwatch import schema as S
from gearwatch.streaming import stateful
from gearwatch.streaming.ingest import ingest_stream, read_message_files, score_stream
from registry import oracle as O
from registry.common import Checks, batches, new_store
from registry.oracle import r6, with_

checks = Checks()
_memo: dict[tuple[str, str], Store] = {}


def _drained(spark, folder) -> Store:
    """All messages streamed in, then streamed again from the start by a second consumer."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _memo:
        store, files = new_store(spark, "streamed"), scratch_folder(spark, "messages")
        messages(spark, folder).write.mode("overwrite").parquet(files)
        for feed in ("first", "replay"):
            arrivals = read_message_files(spark, files, files_per_batch=4)
            ingest_stream(store, arrivals, feed, scratch_folder(spark, "offsets")).awaitTermination()
        _memo[key] = store
    return _memo[key]


# Within the accepted messages every natural key is new: the cycle is the event number.
_OK = "parsed WHERE reject_reason IS NULL"


@checks.add("stream_ingest", with_(O.PARSED, f"SELECT source_file, engine_id, time_in_cycles, {r6('s2')} AS s2 FROM {_OK}"))
def stream_ingest(spark, folder):
    return _drained(spark, folder).raw().select(*NATURAL_KEY, "s2")


@checks.add("stream_replay", with_(O.PARSED, """SELECT feed, count(*) AS consumed_and_skipped, count(*) FILTER (reject_reason IS NULL) AS consumed,
CASE WHEN feed = 'first' THEN count(*) FILTER (reject_reason IS NULL) ELSE 0 END AS inserted,
CASE WHEN feed = 'replay' THEN count(*) FILTER (reject_reason IS NULL) ELSE 0 END AS duplicates,
count(*) FILTER (reject_reason IS NOT NULL) AS skipped FROM parsed, (VALUES ('first'), ('replay')) f(feed) GROUP BY feed"""))
def stream_replay(spark, folder):
    log = _drained(spark, folder).ingests()
    return (log.groupBy(F.split("ingest_id", "-")[0].alias("feed"))
            .agg(F.sum(F.col("consumed") + F.col("skipped")).alias("consumed_and_skipped"), F.sum("consumed").alias("consumed"),
                 F.sum("inserted").alias("inserted"), F.sum("duplicates").alias("duplicates"), F.sum("skipped").alias("skipped")))


@checks.add("stream_quarantine", with_(O.PARSED, "SELECT reject_reason, count(*) AS messages FROM parsed WHERE reject_reason IS NOT NULL GROUP BY ALL"))
def stream_quarantine(spark, folder):
    rows = _drained(spark, folder).quarantine().filter("ingest_id LIKE 'first-%'")
    return rows.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


@checks.add("stream_incremental", with_(O.BATCHED, "SELECT raw_id, source_file, engine_id, time_in_cycles AS latest_cycle, risk_score, predicted_rul, risk_level FROM predictions"))
def stream_incremental(spark, folder):
    store = new_store(spark, "followed")
    offsets = scratch_folder(spark, "offsets")
    for number, batch in enumerate(batches(spark, folder)):
        store.ingest(batch, f"batch-{number}")
        score_stream(store, offsets).awaitTermination()
    return store.predictions().select("raw_id", "source_file", "engine_id", "latest_cycle", "risk_score", "predicted_rul", "risk_level")


@checks.add("stateful_scores", with_(O.BATCHED, "SELECT raw_id, CAST(run_id - 1 AS BIGINT) AS batch_id, source_file, engine_id, time_in_cycles, risk_score, predicted_rul, risk_level, recommended_action FROM predictions"))
def stateful_scores(spark, folder):
    """The three batches as a stream that is started anew for each of them, with its look-back in keyed state.

    The files of a batch are all that is unread when the stream starts, and are one micro-batch.
    """
    files, out, offsets = (scratch_folder(spark, label) for label in ("readings", "stateful", "offsets"))
    for batch in batches(spark, folder):
        rows = batch.withColumn("raw_id", F.col("arrival_seq") + 1).select(*S.RAW.names)
        rows.write.mode("append").parquet(files)
        readings = spark.readStream.schema(S.RAW).parquet(files)
        stateful.score_with_state(readings, out, offsets).awaitTermination()
    return stateful.scored_batches(spark, out, "predictions").select(
        "raw_id", "batch_id", "source_file", "engine_id", "time_in_cycles", "risk_score", "predicted_rul", "risk_level", "recommended_action")
