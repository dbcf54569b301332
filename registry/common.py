"""Helpers of the registered checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gearwatch.operators.clean import clean_telemetry
from gearwatch.operators.features import build_features
from gearwatch.plans.rule_run import run_rule_scoring
from gearwatch.plans.store import Store
from gearwatch.session import scratch_folder, tune
from gearwatch.sources.fixtures import batch_bounds, event_count, telemetry

Query = Callable[[SparkSession, str], DataFrame]


class Checks:
    """Collects queries and their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = lambda spark, folder: rounded(query(tune(spark), folder))
            if sql:
                self.sql[name] = sql
            return query
        return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, half to even, without a negative zero; times as text."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            columns.append(f"rint({f.name} * 1e6D) / 1e6D + 0.0D AS {f.name}")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            columns.append(f"date_format({f.name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {f.name}")
        else:
            columns.append(f.name)
    return df.selectExpr(*columns)


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_telemetry(telemetry(spark, folder), unique_ids=True)


def features(spark: SparkSession, folder: str) -> DataFrame:
    return build_features(clean(spark, folder), rows=event_count(spark, folder))


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry as it arrives, before ids are given out."""
    return telemetry(spark, folder).withColumn("arrival_seq", F.col("raw_id") - 1).drop("raw_id")


def batches(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Telemetry in three arrivals: 40 %, 30 % and 30 % of the rows."""
    rows, low, parts = arrivals(spark, folder), 0, []
    for high in batch_bounds(spark, folder):
        parts.append(rows.filter((F.col("arrival_seq") >= low) & (F.col("arrival_seq") < high)))
        low = high
    return parts


def new_store(spark: SparkSession, label: str) -> Store:
    return Store(spark, scratch_folder(spark, label)).create()


_stores: dict[tuple[str, str], Store] = {}


def scored_store(spark: SparkSession, folder: str) -> Store:
    """Store with the three batches ingested and scored one after another, built once per session.

    The run times are the newest insert times of the batches, so results do not depend on the clock.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stores:
        store = new_store(spark, "scored")
        for number, batch in enumerate(batches(spark, folder)):
            at = batch.agg(F.max("inserted_at")).first()[0]
            store.ingest(batch, f"batch-{number}", now=at)
            run_rule_scoring(store, now=at)
        _stores[key] = store
    return _stores[key]
