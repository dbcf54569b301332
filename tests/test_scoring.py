import pytest
from pyspark.sql import functions as F

from conftest import reading
from gearwatch.functions import display, levels
from gearwatch.functions.numbers import round_half_even
from gearwatch.operators.clean import clean_telemetry
from gearwatch.operators.features import build_features, latest_per_key
from gearwatch.operators.scoring import probability_alerts, score_alerts, score_risk
from gearwatch.schema import Thresholds


def values(spark, column, rows, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v")).alias("x")).collect()]


def test_score_levels(spark):
    assert values(spark, levels.score_level, [100.0, 90.0, 89.99, 70.0, 69.99, 40.0, 39.99, 0.0]) == [
        "CRITICAL", "CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_probability_levels(spark):
    assert values(spark, levels.probability_level, [0.80, 0.50, 0.49]) == ["HIGH", "MEDIUM", "LOW"]
    cuts = Thresholds(high_probability=0.9, medium_probability=0.3)
    assert values(spark, lambda c: levels.probability_level(c, cuts), [0.85, 0.3, 0.2]) == ["MEDIUM", "MEDIUM", "LOW"]


def test_rounding_scales_and_unscales(spark):
    import numpy as np
    numbers = [39.995, 0.125, 0.375, 2.675, 99.985, 70.005]
    assert values(spark, lambda c: round_half_even(c, 2), numbers) == list(np.round(numbers, 2))


def test_no_signal_scores_zero(make):
    rows = make([reading(i, i, 1, 3) for i in (1, 2, 3)])
    scored = score_risk(latest_per_key(build_features(clean_telemetry(rows)))).collect()
    assert {(r.risk_score, r.predicted_rul, r.risk_level) for r in scored} == {(0.0, 100.0, "LOW")}


def test_alert_texts(spark):
    df = spark.createDataFrame([(1, "FD001", 7, 31, 71.5, "HIGH"), (2, "FD001", 8, 9, 100.0, "CRITICAL"), (3, "A", 1, 1, 69.9, "MEDIUM")],
                               "raw_id bigint, source_file string, engine_id int, time_in_cycles int, risk_score double, risk_level string")
    assert sorted(r.message for r in score_alerts(df).collect()) == [
        "CRITICAL risk for engine 8 at cycle 9: score=100.0", "HIGH risk for engine 7 at cycle 31: score=71.5"]
    df = spark.createDataFrame([(1, "FD001", 7, 31, 0.90625, "HIGH"), (2, "A", 1, 1, 0.2, "LOW")],
                               "raw_id bigint, source_file string, engine_id int, time_in_cycles int, risk_score double, risk_level string")
    assert [r.message for r in probability_alerts(df).collect()] == [
        f"HIGH failure probability for engine 7 at cycle 31: probability={0.90625:.4f}"]


def test_probability_texts(spark):
    numbers = [0.5, 1.0, 0.12345, 1.235, 2.675, 0.0, 71.5]
    expected = [f"{v:.2%}" if v <= 1 else f"{v:.2f}" for v in numbers]
    assert values(spark, display.probability_text, numbers + [None, float("nan")]) == expected + ["-", "-"]


@pytest.mark.parametrize("text,ok", [("07:00", True), ("23:59", True), ("24:00", False), ("7:00", False), ("12:60", False)])
def test_time_pattern(spark, text, ok):
    assert values(spark, lambda c: c.rlike(display.TIME_TEXT), [text], "string") == [ok]


def test_half_hour_slots(spark):
    rows = display.half_hour_slots(spark).orderBy("slot").collect()
    assert len(rows) == 48
    assert (rows[0].value_24h, rows[0].display_12h) == ("00:00", "12:00 AM")
    assert (rows[35].value_24h, rows[35].display_12h) == ("17:30", "05:30 PM")
