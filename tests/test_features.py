import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import reading
from gearwatch.operators.clean import clean_telemetry, ordered
from gearwatch.operators.features import build_features, last_rows, latest_per_key
from gearwatch.operators.scoring import score_latest, score_risk
from gearwatch.operators.skew import numbered
from gearwatch.schema import DERIVED, KEY, READINGS, TRACKED_SENSORS
from gearwatch.sources.fixtures import telemetry


def two_engines():
    return [reading(None, e, c, c + e) for e in (1, 2) for c in range(1, 6)]


def without_ids(rows):
    return [{k: v for k, v in r.items() if k != "raw_id"} for r in rows]


def random_rows(seed, engines=3, rows=160):
    """Sparse, unordered, partly negative cycles; engine 1 holds most rows."""
    rng = random.Random(seed)
    taken, out = set(), []
    while len(out) < rows:
        engine = 1 if rng.random() < 0.7 else rng.randint(2, engines)
        cycle = rng.choice([rng.randint(-30, 200), rng.randint(0, 5000)])
        if (engine, cycle) in taken:
            continue
        taken.add((engine, cycle))
        row = reading(len(out) + 1, engine, cycle, 0)
        row.update({c: round(rng.uniform(-50, 50), 3) for c in READINGS})
        out.append(row)
    return out


def brute_force(rows, window):
    df = pd.DataFrame(rows).sort_values(["source_file", "engine_id", "time_in_cycles", "raw_id"])
    groups = df.groupby(["source_file", "engine_id"])
    for s in TRACKED_SENSORS:
        df[f"rolling_avg_{s}"] = groups[s].transform(lambda v: v.rolling(window, min_periods=1).mean())
        df[f"rolling_std_{s}"] = groups[s].transform(lambda v: v.rolling(window, min_periods=1).std()).fillna(0.0)
        df[f"delta_{s}"] = groups[s].diff().fillna(0.0)
    df["demo_rul"] = groups["time_in_cycles"].transform("max") - df["time_in_cycles"]
    return df.sort_values("raw_id").reset_index(drop=True)


def test_cleaning_keeps_valid_rows_in_order(make):
    rows = without_ids(two_engines())
    rows[0]["s2"] = None
    cleaned = ordered(clean_telemetry(make(rows + rows[:1]))).collect()
    assert len(cleaned) == 10
    assert cleaned[0]["s2"] == 0.0
    assert (cleaned[0].engine_id, cleaned[-1].engine_id) == (1, 2)


def test_cleaning_coerces_texts(spark):
    rows = [("7", None, "3.9", "2", "5d", " 1e3 "), ("8", "A", "x", "2", "1", "1"), (None, "A", "1", "2", "1", "1"),
            ("9", "", "-3.7", "4", "1e999", "1_000"), ("10", "A", "1", "1", "inf", "nan")]
    df = spark.createDataFrame(rows, "raw_id string, source_file string, engine_id string, time_in_cycles string, s2 string, s3 string")
    got = {r.raw_id: r for r in clean_telemetry(df).collect()}
    assert sorted(got) == [7, 9, 10]
    assert (got[7].source_file, got[7].engine_id, got[7].s2, got[7].s3, got[7].s4) == ("UNKNOWN", 3, 0.0, 1000.0, 0.0)
    assert (got[9].source_file, got[9].engine_id, got[9].s2, got[9].s3) == ("", -3, 0.0, 0.0)
    assert (got[10].s2, got[10].s3) == (0.0, 0.0)


def test_first_arrival_of_a_raw_id_stays(make):
    rows = [reading(1, 1, 1, v, arrival_seq=a) for a, v in ((5, 50), (2, 20), (9, 90))]
    assert [r.s2 for r in clean_telemetry(make(rows)).collect()] == [20.0]


def test_feature_columns_and_last_remaining_cycle(make):
    features = build_features(clean_telemetry(make(without_ids(two_engines()))))
    assert set(DERIVED) <= set(features.columns) and "s1" not in features.columns
    assert features.filter("engine_id = 1 AND time_in_cycles = 5").first().demo_rul == 0


def test_raw_ids_survive(make):
    rows = make([reading(100 + c, 1, c, c) for c in (1, 2, 3)])
    features = build_features(clean_telemetry(rows))
    new = features.filter(F.col("raw_id") > 101)
    assert sorted(r.raw_id for r in new.collect()) == [102, 103]
    assert score_risk(latest_per_key(new)).first().raw_id == 103


@pytest.mark.parametrize("seed,window,hot_rows", [(1, 5, 1_000_000), (2, 5, 7), (3, 5, 1), (4, 1, 9), (5, 2, 11), (6, 12, 10), (7, 9, 40)])
def test_features_equal_brute_force(make, seed, window, hot_rows):
    rows = random_rows(seed)
    expected = brute_force(rows, window)
    got = build_features(make(rows), window, hot_rows=hot_rows).toPandas().sort_values("raw_id").reset_index(drop=True)
    assert len(got) == len(expected)
    for name in DERIVED:
        np.testing.assert_allclose(got[name], expected[name], atol=1e-9, err_msg=name)
    assert (got["demo_rul"] == expected["demo_rul"]).all()


def test_hot_keys_are_found_in_the_whole_table(spark, folder):
    names = ["raw_id", *DERIVED, "demo_rul"]
    plain = build_features(clean_telemetry(telemetry(spark, folder), unique_ids=True)).select(*names)
    split = build_features(clean_telemetry(telemetry(spark, folder, hot_rows=5), unique_ids=True), hot_rows=4).select(*names)
    left = plain.toPandas().sort_values("raw_id").to_numpy()
    np.testing.assert_allclose(left, split.toPandas().sort_values("raw_id").to_numpy(), atol=1e-9)


def test_numbering_of_hot_groups(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("k"), (F.col("id") * 13 % 1009).alias("at"))
    plain = numbered(df, ["k"], "at", "n", rows=500).collect()
    split = numbered(df, ["k"], "at", "n", hot_rows=20).collect()
    assert sorted(plain) == sorted(split)


def test_score_latest_equals_full_features(make):
    rows = make(random_rows(11, engines=6))
    quick = {r.engine_id: r.risk_score for r in score_latest(clean_telemetry(rows)).collect()}
    full = {r.engine_id: r.risk_score for r in score_risk(latest_per_key(build_features(clean_telemetry(rows)))).collect()}
    assert quick == full and max(quick.values()) == 100.0


def test_last_rows_per_key(make):
    rows = random_rows(12)
    got = last_rows(make(rows), 4, KEY).groupBy("engine_id").count().collect()
    assert all(r["count"] == 4 for r in got)


def test_empty_input(spark, make):
    nothing = make(random_rows(1, rows=2)).filter("false")
    assert build_features(clean_telemetry(nothing)).count() == 0
    assert score_latest(clean_telemetry(nothing)).count() == 0


def test_both_window_formulas_agree(spark, folder, monkeypatch):
    """Lag arithmetic up to MAX_LAGS and sliding aggregates above it give the same features."""
    import numpy as np
    from gearwatch.operators import features as module
    from gearwatch.operators.clean import clean_telemetry
    from gearwatch.sources.fixtures import telemetry
    rows = clean_telemetry(telemetry(spark, folder), unique_ids=True)
    for window in (2, 9, 10):
        frames = []
        for lags in (1, 20):
            monkeypatch.setattr(module, "MAX_LAGS", lags)
            frames.append(module.build_features(rows, window).select("raw_id", *module.DERIVED).toPandas().sort_values("raw_id").to_numpy())
        np.testing.assert_allclose(*frames, atol=1e-9)


def test_long_look_backs_are_cut_on_the_map_side(spark, folder):
    from gearwatch.operators.features import last_rows
    from gearwatch.sources.fixtures import telemetry
    plan = last_rows(telemetry(spark, folder), 1500)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
