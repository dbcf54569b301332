import datetime as dt

import pytest
from pyspark.sql import functions as F

from gearwatch.plans import reports, rule_run, totals
from gearwatch.plans.rule_run import recompute_keys, run_rule_scoring
from gearwatch.plans.store import Store
from conftest import reading

T0, T1, T2 = (dt.datetime(2024, 3, 1, hour) for hour in (6, 7, 12))


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store")).create()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def same_as_counted(store, kept=True):
    assert (totals.in_force(store) is not None) == kept
    assert rows_of(totals.headline_counts(store)) == rows_of(reports.headline_counts(store.raw(), store.processed(), store.predictions(), store.alerts()))
    assert rows_of(totals.risk_distribution(store)) == rows_of(reports.risk_distribution(store.predictions()))
    assert rows_of(totals.engine_status(store)) == rows_of(reports.engine_status(store.predictions()))


def add(store, make, name, cycles, engines=(1, 2, 3), now=T1):
    rows = [reading(None, e, c, (c * e * 7) % 23) for c in cycles for e in engines]
    store.ingest(make([{**{k: v for k, v in r.items() if k != "raw_id"}, "arrival_seq": i} for i, r in enumerate(rows)]), name, now)
    return run_rule_scoring(store, now=now)


def again(store, now, level="HIGH", rows="true", model="demo-v1"):
    """Score stored predictions anew with one level, and open an alert for each."""
    at = store.position("x")
    run = store.start_run("x", "again", now, at)
    scored = store.predictions().filter(rows).select("raw_id", "source_file", "engine_id", F.col("latest_cycle").alias("time_in_cycles"),
                                                     F.lit(91.0).alias("risk_score"), "predicted_rul", F.lit(level).alias("risk_level"), "recommended_action")
    alerts = lambda df: df.select("raw_id", "source_file", "engine_id", F.lit(level).alias("severity"), F.lit("again").alias("message"))
    return store.finish_run(run, "SUCCESS", now, **rule_run.write_results(store, scored, alerts, run["run_id"], at, 1, model, now))


def test_totals_follow_runs_resolutions_and_recomputes(store, make):
    same_as_counted(store)
    add(store, make, "a", range(1, 6))
    same_as_counted(store)
    run_rule_scoring(store, now=T1)  # nothing new
    same_as_counted(store)
    add(store, make, "b", range(6, 9), engines=(2, 4))
    alert = store.alerts().filter("NOT is_resolved").first()
    for _ in range(2):  # the second time it is closed already
        store.resolve_alert(alert.id, T1)
        same_as_counted(store)
    store.resolve_alert(10**9, T1)
    same_as_counted(store)
    recompute_keys(store, store.raw(), now=T2)
    same_as_counted(store)
    again(store, T2)  # same rows, opens the resolved alert again
    same_as_counted(store)
    again(store, T2, "LOW", "engine_id = 2", model="other")
    store.resolve_alert(store.alerts().filter("model_version = 'other'").first().id, T2)
    same_as_counted(store)


def test_a_run_dated_back_makes_the_next_one_count_anew(store, make):
    add(store, make, "a", range(1, 6))
    again(store, T0, "LOW")
    same_as_counted(store, kept=False)
    again(store, T2, "MEDIUM", "engine_id = 1")
    same_as_counted(store)


def test_a_failed_run_changes_no_totals(store, make):
    add(store, make, "a", range(1, 4))
    before = rows_of(totals.headline_counts(store))[1:]
    def stop(run_id):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        recompute_keys(store, store.raw(), now=T2, before_commit=stop)
    assert rows_of(totals.headline_counts(store))[1:] == before
    same_as_counted(store)


def test_state_is_written_anew_after_some_runs(store, make, monkeypatch):
    monkeypatch.setattr(totals, "STATE_FOLDERS", 2)
    for part in range(5):
        add(store, make, f"p{part}", range(3 * part + 1, 3 * part + 4), engines=(part + 1, 9))
    same_as_counted(store)
    assert totals.counted(store, 5)["state", "from"] > 1


def test_readers_open_only_totals(store, make):
    add(store, make, "a", range(1, 6))
    for df in (totals.headline_counts(store), totals.risk_distribution(store), totals.engine_status(store)):
        assert all("/newest/" in f for f in df.inputFiles())
