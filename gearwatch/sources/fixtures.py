"""Telemetry derived from the ``events`` table, for checks and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gearwatch.operators.skew import HOT_ROWS, numbered
from gearwatch.schema import CYCLE, ENGINE, READINGS, SENSORS, SETTINGS, SOURCE


def telemetry(spark: SparkSession, folder: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every event as one reading: event type as source, user as engine, n-th event as cycle."""
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    cycles = numbered(events, ["event_type", "user_id"], "event_id", CYCLE, rows=event_count(spark, folder), hot_rows=hot_rows)
    settings = [f"CAST((event_id * {j}) % 10 AS DOUBLE) / 10 AS op_setting_{j}" for j in range(1, len(SETTINGS) + 1)]
    sensors = [f"CASE WHEN event_id % 17 != {i % 17} THEN CAST(value AS DOUBLE) * {i} / 10 "
               f"+ ((event_id * {i + 3}) % 97) END AS s{i}" for i in range(1, len(SENSORS) + 1)]
    return cycles.selectExpr(
        "event_id + 1 AS raw_id", f"event_type AS {SOURCE}", f"CAST(user_id AS INT) AS {ENGINE}",
        f"CAST({CYCLE} AS INT) AS {CYCLE}", *settings, *sensors, "ts AS inserted_at")


def event_count(spark: SparkSession, folder: str) -> int:
    """Rows of the events table, from the file footers; there is one reading per event."""
    return spark.read.parquet(f"{folder}/events.parquet").count()


def batch_bounds(spark: SparkSession, folder: str) -> tuple[int, int, int]:
    """Last raw id of the 40 %, 70 % and 100 % batches; raw ids are 1..n here."""
    total = event_count(spark, folder)
    return total * 4 // 10, total * 7 // 10, total


def redelivered(readings: DataFrame) -> DataFrame:
    """Telemetry with every tenth event delivered twice, in arrival order, same raw id."""
    first = readings.withColumn("arrival_seq", F.col("raw_id") - 1)
    again = (first.filter((F.col("raw_id") - 1) % 10 == 0)
             .withColumn("arrival_seq", F.col("arrival_seq") + 1_000_000_000_000)
             .withColumn("s2", F.lit(-1.0)))
    return first.unionByName(again)


def dirty_text(readings: DataFrame) -> DataFrame:
    """Telemetry as text columns with bad numbers and missing engines mixed in."""
    event = "(raw_id - 1)"
    spoiled = [f"CASE WHEN {event} % 29 = 0 THEN 'abc' WHEN {event} % 31 = 0 THEN '5d' "
               f"ELSE CAST({c} AS STRING) END AS {c}" for c in READINGS]
    return readings.selectExpr(
        "CAST(raw_id AS STRING) AS raw_id", f"CASE WHEN {event} % 41 != 0 THEN {SOURCE} END AS {SOURCE}",
        f"CASE WHEN {event} % 37 != 0 THEN CAST({ENGINE} AS STRING) END AS {ENGINE}",
        f"concat(CAST({CYCLE} AS STRING), '.7') AS {CYCLE}", *spoiled, "inserted_at")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON message per event, ``arrival_seq`` and ``body``; one in three is flawed on purpose."""
    source = '"source_file":"\', event_type, \'"'
    engine = '"engine_id":\', user_id, \''
    cycle = '"time_in_cycles":\', event_id, \''
    bodies = [
        "not json \', event_id, \'", "[\', event_id, \']", f"{{{source},{cycle}}}", f'{{"engine_id":"x",{cycle}}}',
        f"{{{source},{engine},{cycle}.7}}", f'{{"source_file":"","source":"B",{engine},{cycle}}}',
        f'{{"engine_id":"\', user_id, \'",{cycle}}}', f'{{"engine_id":null,{cycle}}}', f'{{{engine},{cycle},"s2":"abc"}}']
    kinds = " ".join(f"WHEN {i} THEN concat('{text}')" for i, text in enumerate(bodies))
    other = f'{{{source},{engine},{cycle},"s2":\', event_id, \'.25}}'
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.selectExpr("event_id AS arrival_seq", f"CASE event_id % 23 {kinds} ELSE concat('{other}') END AS body")
