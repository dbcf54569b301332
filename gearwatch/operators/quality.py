"""Integrity checks of the tables: one row per rule with its number of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from gearwatch.functions.display import TIME_TEXT


def _rule(df: DataFrame, table: str, rule: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations")


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All not-null rules of a table from one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'not_null {c}', {c}" for c in columns)
    return (counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (rule, violations)")
            .select(F.lit(table).alias("table_name"), "rule", "violations"))


def unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Key values held by more than one row."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _rule(repeated, table, f"unique {','.join(keys)}")


def references(child: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent row.

    Children are first counted per value, so one value with very many children is one row in
    the join.
    """
    values = child.groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).filter("_v IS NOT NULL")
    orphans = values.join(parent.select(F.col(key).alias("_v")), "_v", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(f"reference {column}").alias("rule"), "violations")


def time_format(df: DataFrame, table: str, column: str) -> DataFrame:
    return _rule(df.filter(~F.col(column).rlike(TIME_TEXT) | (F.length(column) > 5)), table, f"time_format {column}")


def audit(rules: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def audit_store(store) -> DataFrame:
    """All rules over the tables of a store."""
    raw, processed = store.raw(), store.committed("processed")
    predictions, alerts, runs = store.predictions(), store.alerts(), store.runs()
    return audit([
        not_null(raw, "raw", ["raw_id", "source_file", "engine_id", "time_in_cycles", "inserted_at"]),
        unique(raw, "raw", ["raw_id"]), unique(raw, "raw", ["source_file", "engine_id", "time_in_cycles"]),
        not_null(processed, "processed", ["raw_id", "source_file", "engine_id", "time_in_cycles", "processed_at"]),
        unique(store.processed(), "processed", ["raw_id"]),
        unique(store.processed(), "processed", ["source_file", "engine_id", "time_in_cycles"]),
        references(processed, "processed", "raw_id", raw, "raw_id"),
        not_null(predictions, "predictions", ["run_id", "raw_id", "risk_score", "risk_level", "recommended_action"]),
        unique(predictions, "predictions", ["raw_id", "model_version"]),
        references(predictions, "predictions", "raw_id", raw, "raw_id"),
        references(predictions, "predictions", "run_id", runs, "run_id"),
        not_null(alerts, "alerts", ["run_id", "raw_id", "severity", "message", "is_resolved"]),
        unique(alerts, "alerts", ["raw_id", "model_version"]),
        references(alerts, "alerts", "raw_id", raw, "raw_id"),
        references(alerts, "alerts", "run_id", runs, "run_id"),
        *[time_format(store.schedule(), "schedule", f"time_{i}") for i in (1, 2, 3)]])


def stale_alerts(alerts: DataFrame, predictions: DataFrame, alert_cut: float = 70.0) -> DataFrame:
    """Open alerts of engines whose newest prediction of the same model is below the cut."""
    from gearwatch.operators.clean import first_by
    keys = ["source_file", "engine_id", "model_version"]
    newest = first_by(predictions, keys, [F.col("prediction_time").desc(), F.col("id").desc()])
    calm = newest.filter(F.col("risk_score") < alert_cut).select(*keys)
    return alerts.filter(~F.col("is_resolved")).join(calm, keys, "left_semi")
