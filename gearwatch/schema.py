"""Column groups, table schemas and scoring settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SOURCE, ENGINE, CYCLE = "source_file", "engine_id", "time_in_cycles"
KEY = [SOURCE, ENGINE]
NATURAL_KEY = [SOURCE, ENGINE, CYCLE]

SETTINGS = [f"op_setting_{j}" for j in range(1, 4)]
SENSORS = [f"s{i}" for i in range(1, 22)]
READINGS = SETTINGS + SENSORS
TEXT_COLUMNS = [ENGINE, CYCLE] + READINGS

# The sensors that never vary in this machine family, and those whose
# recent behaviour is tracked.
FLAT_SENSORS = ["s1", "s5", "s6", "s10", "s16", "s18", "s19"]
TRACKED_SENSORS = ["s2", "s3", "s4", "s7", "s11", "s12", "s15", "s20", "s21"]

KEPT_SENSORS = [s for s in SENSORS if s not in FLAT_SENSORS]
DERIVED = [f"{kind}_{s}" for s in TRACKED_SENSORS for kind in ("rolling_avg", "rolling_std", "delta")]
MODEL_INPUTS = [CYCLE] + SETTINGS + KEPT_SENSORS + DERIVED
PROCESSED_COLUMNS = ["raw_id"] + NATURAL_KEY + SETTINGS + KEPT_SENSORS + DERIVED + ["demo_rul"]

ROLLING_ROWS = 5
CONTEXT_ROWS = 50
DEFAULT_TIMES = ("07:00", "12:00", "17:00")
RULE_PIPELINE = "rule_scoring"
RULE_MODEL = "demo-v1"
TRAINED_MODEL = "trees-trained-v1"


@dataclass(frozen=True)
class Thresholds:
    """Cut points of both scorers: 0..100 rule scores and 0..1 probabilities."""

    critical: float = 90.0
    high: float = 70.0
    medium: float = 40.0
    alert: float = 70.0
    high_probability: float = 0.80
    medium_probability: float = 0.50


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_ID, _INT, _TEXT, _REAL, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampType()
_READING = [(SOURCE, _TEXT), (ENGINE, _INT), (CYCLE, _INT)]

RAW = _struct(("raw_id", _ID), *_READING, *[(c, _REAL) for c in READINGS], ("inserted_at", _TIME))

PROCESSED = _struct(
    ("raw_id", _ID), *_READING, *[(c, _REAL) for c in SETTINGS + KEPT_SENSORS + DERIVED],
    ("demo_rul", _INT), ("processed_at", _TIME))

PREDICTIONS = _struct(
    ("id", _ID), ("raw_id", _ID), ("model_version", _TEXT), (SOURCE, _TEXT), (ENGINE, _INT),
    ("prediction_time", _TIME), ("latest_cycle", _INT), ("risk_score", _REAL),
    ("predicted_rul", _REAL), ("risk_level", _TEXT), ("recommended_action", _TEXT),
    ("created_at", _TIME))

ALERTS = _struct(
    ("id", _ID), ("raw_id", _ID), ("model_version", _TEXT), (SOURCE, _TEXT), (ENGINE, _INT),
    ("severity", _TEXT), ("message", _TEXT), ("created_at", _TIME))

RUNS = _struct(
    ("run_id", _ID), ("seq", _INT), ("pipeline_name", _TEXT), ("run_type", _TEXT),
    ("scheduled_time", _TIME), ("started_at", _TIME), ("finished_at", _TIME), ("status", _TEXT),
    ("raw_rows_used", _ID), ("from_raw_id", _ID), ("to_raw_id", _ID), ("checkpoint_before", _ID),
    ("checkpoint_after", _ID), ("last_inserted_at", _TIME),
    ("last_prediction_id", _ID), ("last_alert_id", _ID), ("notes", _TEXT), ("model_version", _TEXT),
    ("totals_run", _ID))

INGESTS = _struct(
    ("ingest_id", _TEXT), ("consumed", _ID), ("inserted", _ID), ("duplicates", _ID),
    ("skipped", _ID), ("from_raw_id", _ID), ("to_raw_id", _ID), ("committed_at", _TIME),
    ("full_marks", _INT))

RESOLUTIONS = _struct(("alert_id", _ID), ("after_run_id", _ID), ("resolved_at", _TIME), ("closed", _ID))

SCHEDULE = _struct(
    ("version", _ID), ("time_1", _TEXT), ("time_2", _TEXT), ("time_3", _TEXT), ("updated_at", _TIME))

QUARANTINE = _struct(("arrival_seq", _ID), ("body", _TEXT), ("reject_reason", _TEXT))
