"""Rule scorer, probability scorer outputs and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gearwatch.functions import levels
from gearwatch.functions.numbers import clip, round_half_even
from gearwatch.operators.features import build_features, last_rows, latest_per_key
from gearwatch.schema import CYCLE, ENGINE, ROLLING_ROWS, TRACKED_SENSORS, Thresholds


def _mean_abs(df: DataFrame, prefix: str) -> str:
    names = [f"{prefix}_{s}" for s in TRACKED_SENSORS if f"{prefix}_{s}" in df.columns]
    if not names:
        return "0.0D"
    return f"({' + '.join(f'abs({c})' for c in names)}) / {len(names)}.0D"


def risk_signal(df: DataFrame) -> Column:
    """Twice the mean absolute change plus the mean variability of the tracked sensors."""
    return F.expr(f"{_mean_abs(df, 'delta')} * 2.0D + {_mean_abs(df, 'rolling_std')}")


def score_risk(latest: DataFrame, cuts: Thresholds = Thresholds(), reference_max: float | None = None,
               keep: list[str] | None = None) -> DataFrame:
    """Scores 0..100 relative to the highest signal of the batch, with level and action.

    The batch maximum is a one-row scalar subquery over a partially aggregated maximum.
    ``reference_max`` replaces it where scores must be comparable across batches.
    """
    kept = keep or latest.columns
    signal = latest.select(*kept, risk_signal(latest).alias("_signal"))
    if reference_max is None:
        top = signal.agg(F.max("_signal").alias("top")).scalar()
    else:
        top = F.lit(float(reference_max))
    return (signal.withColumn("_top", top)
            .withColumn("risk_score", F.when(F.col("_top") == 0.0, F.lit(0.0)).otherwise(
                round_half_even(clip(F.col("_signal") / F.col("_top") * F.lit(100.0), 0.0, 100.0), 2)))
            .withColumn("predicted_rul", round_half_even(F.greatest(F.lit(100.0) - F.col("risk_score"), F.lit(0.0)), 2))
            .withColumn("risk_level", levels.score_level(F.col("risk_score"), cuts))
            .withColumn("recommended_action", levels.action_for(F.col("risk_level"), levels.SCORE_ACTIONS))
            .drop("_signal", "_top"))


def score_latest(clean: DataFrame, window: int = ROLLING_ROWS, cuts: Thresholds = Thresholds()) -> DataFrame:
    """Latest score per machine straight from clean readings.

    The features of a newest row need only the last ``window`` rows of its key, two at least
    for the change, so every map task cuts its input to those before the one shuffle.
    """
    needed = max(window, 2)
    recent = last_rows(clean, needed)
    latest = latest_per_key(build_features(recent, window, rows=needed).drop("demo_rul"))
    keep = [c for c in ("raw_id", "source_file", ENGINE, CYCLE) if c in latest.columns]
    return score_risk(latest, cuts, keep=keep)


def score_alerts(scored: DataFrame, cuts: Thresholds = Thresholds()) -> DataFrame:
    """Alert rows of rule scores at or above the alert cut."""
    return (scored.filter(F.col("risk_score") >= cuts.alert)
            .select("raw_id", "source_file", ENGINE, F.col("risk_level").alias("severity"),
                    levels.score_message(F.col("risk_level"), F.col(ENGINE), F.col(CYCLE),
                                         F.col("risk_score")).alias("message")))


def apply_probability(df: DataFrame, probability: Column, cuts: Thresholds = Thresholds()) -> DataFrame:
    """Result columns of a 0..1 failure probability."""
    return (df.withColumn("risk_score", round_half_even(probability, 6))
            .withColumn("predicted_rul", F.lit(None).cast("double"))
            .withColumn("risk_level", levels.probability_level(F.col("risk_score"), cuts))
            .withColumn("recommended_action",
                        levels.action_for(F.col("risk_level"), levels.PROBABILITY_ACTIONS)))


def probability_alerts(scored: DataFrame) -> DataFrame:
    """Alert rows of HIGH probabilities."""
    return (scored.filter(F.col("risk_level") == "HIGH")
            .select("raw_id", "source_file", ENGINE, F.col("risk_level").alias("severity"),
                    levels.probability_message(F.col(ENGINE), F.col(CYCLE), F.col("risk_score")).alias("message")))
