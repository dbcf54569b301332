"""Operator reports over the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gearwatch.operators.clean import first_by
from gearwatch.operators.selection import engine_filter
from gearwatch.schema import ENGINE, SOURCE

LEVELS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
STATUS = ["risk_score", "risk_level", "latest_cycle", "recommended_action"]


def headline_counts(raw: DataFrame, processed: DataFrame, predictions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Rows of each table and open alerts."""
    tables = [("raw_rows", raw), ("processed_rows", processed), ("prediction_rows", predictions),
              ("active_alerts", alerts.filter(~F.col("is_resolved")))]
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("metric"), "rows") for name, df in tables]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def rows_per_source(raw: DataFrame) -> DataFrame:
    return raw.groupBy(SOURCE).agg(F.count(F.lit(1)).alias("rows")).orderBy(SOURCE)


def latest_per_engine(predictions: DataFrame, keys: tuple[str, ...] = (ENGINE,)) -> DataFrame:
    """Newest prediction per engine; pass the source too where engine ids repeat across sources."""
    return first_by(predictions, list(keys), [F.col("prediction_time").desc(), F.col("id").desc()])


def risk_distribution(predictions: DataFrame, keys: tuple[str, ...] = (ENGINE,)) -> DataFrame:
    """Engines per risk level with their share in percent; levels without engines show 0."""
    newest = latest_per_engine(predictions.select(*keys, "prediction_time", "id", "risk_level"), keys)
    counts = newest.groupBy("risk_level").agg(F.count(F.lit(1)).alias("engines"))
    levels = predictions.sparkSession.createDataFrame([(level,) for level in LEVELS], "risk_level string")
    table = levels.join(counts, "risk_level", "full").withColumn("engines", F.coalesce("engines", F.lit(0)))
    return with_shares(table)


def with_shares(table: DataFrame) -> DataFrame:
    total = table.agg(F.sum("engines").alias("n")).scalar()
    return table.withColumn("share", F.when(total == 0, F.lit(0.0)).otherwise(
        F.rint(F.col("engines") / total * 1000) / 10))


def engine_history(predictions: DataFrame, engine: int, newest_first: bool = False) -> DataFrame:
    """All predictions of an engine in time order."""
    rows = predictions.filter(F.col(ENGINE) == engine).select(
        "id", "prediction_time", "risk_score", "risk_level", "latest_cycle", "recommended_action")
    order = [F.col("prediction_time"), F.col("id")]
    return rows.orderBy(*[c.desc() for c in order] if newest_first else order)


def engine_status(predictions: DataFrame) -> DataFrame:
    """Current status of every engine: its newest prediction."""
    return latest_per_engine(predictions).select(ENGINE, *STATUS)


def latest_predictions(predictions: DataFrame, level: str = "ALL", engines: str = "", top: int = 200) -> DataFrame:
    """The newest ``top`` predictions, then filtered by level and engine text."""
    newest = predictions.orderBy(F.col("prediction_time").desc(), F.col("id").desc()).limit(top)
    if level != "ALL":
        newest = newest.filter(F.col("risk_level") == level)
    return newest.filter(engine_filter(F.col(ENGINE), engines))


def shown_counts(predictions: DataFrame, level: str = "ALL", engines: str = "", top: int = 200) -> DataFrame:
    """How many of the newest ``top`` predictions pass the filters."""
    total = latest_predictions(predictions, top=top).agg(F.count(F.lit(1)).alias("n")).scalar()
    return (latest_predictions(predictions, level, engines, top).agg(F.count(F.lit(1)).alias("shown"))
            .withColumn("total", total))


def latest_runs(runs: DataFrame, top: int = 10) -> DataFrame:
    return runs.orderBy(F.col("run_id").desc()).limit(top)


def active_alerts(alerts: DataFrame, top: int = 25) -> DataFrame:
    return alerts.filter(~F.col("is_resolved")).orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(top)


def latest_alerts(alerts: DataFrame, top: int = 10) -> DataFrame:
    return alerts.orderBy(F.col("id").desc()).limit(top)


def latest_raw(raw: DataFrame, top: int = 10, source: str | None = None) -> DataFrame:
    """Newest raw rows, of one feed or of all."""
    rows = raw if source is None else raw.filter(F.col(SOURCE) == source)
    return rows.orderBy(F.col("raw_id").desc()).limit(top)
