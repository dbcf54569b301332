import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearwatch.operators.clean import clean_telemetry
from gearwatch.operators.features import build_features
from gearwatch.operators.merge import insert_absent, insert_counts, upsert
from gearwatch.operators.quality import audit_store
from gearwatch.plans import rule_run
from gearwatch.plans.rule_run import context_rows, late_rows, recompute_keys, rows_of_batch, run_rule_scoring
from gearwatch.plans.store import Store
from gearwatch.schema import DERIVED, NATURAL_KEY, READINGS
from gearwatch.session import folder_names
from gearwatch.sources.fixtures import telemetry
from conftest import reading

T1, T2 = dt.datetime(2024, 3, 1, 7, 0), dt.datetime(2024, 3, 1, 12, 0)


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store")).create()


def arrivals(rows, first=0):
    return [{**{k: v for k, v in r.items() if k != "raw_id"}, "arrival_seq": first + i} for i, r in enumerate(rows)]


def test_ingest_counts_and_keeps_first_arrival(store, make):
    rows = [reading(None, 1, 1, 10), reading(None, 1, 2, 20), reading(None, 1, 1, 99)]
    log = store.ingest(make(arrivals(rows)), "a", T1)
    assert (log["consumed"], log["inserted"], log["duplicates"], log["skipped"]) == (3, 2, 1, 0)
    again = store.ingest(make(arrivals(rows + [reading(None, 1, 0, 5), reading(None, 2, 1, 7)], 50)), "b", T1)
    assert (again["inserted"], again["duplicates"]) == (2, 3)
    raw = {(r.engine_id, r.time_in_cycles): r for r in store.raw().collect()}
    assert len(raw) == 4 and raw[(1, 1)].s2 == 10.0
    assert sorted(r.raw_id for r in raw.values()) == [1, 2, 3, 4]
    assert store.ingest(make(arrivals(rows)), "a", T2)["committed_at"] == T1
    assert store.raw().count() == 4


def test_uncommitted_ingest_is_not_read(store, make, monkeypatch):
    monkeypatch.setattr(Store, "_append_log", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.ingest(make(arrivals([reading(None, 1, 1, 1)])), "a", T1)
    monkeypatch.undo()
    assert store.raw().count() == 0
    assert store.ingest(make(arrivals([reading(None, 1, 1, 1)])), "a", T1)["inserted"] == 1


@pytest.mark.parametrize("parts,hot_rows", [([0.4, 0.7, 1.0], 1_000_000), ([0.1, 0.2, 0.5, 0.9, 1.0], 3)])
def test_batches_give_the_features_of_one_batch(spark, store, folder, parts, hot_rows):
    rows = telemetry(spark, folder)
    whole = build_features(clean_telemetry(rows, unique_ids=True)).select("raw_id", *DERIVED).toPandas().sort_values("raw_id")
    total = rows.count()
    store.ingest(rows.withColumn("arrival_seq", F.col("raw_id") - 1).drop("raw_id"), "all", T1)
    for part in parts:
        result = run_rule_scoring(store, now=T1, up_to=int(total * part), window_cycles=4, hot_rows=hot_rows)
        assert result["checkpoint_after"] == int(total * part)
    got = store.processed().select("raw_id", *DERIVED).toPandas().sort_values("raw_id")
    np.testing.assert_allclose(got.to_numpy(), whole.to_numpy(), atol=1e-9)
    violations = {(r.table_name, r.rule): r.violations for r in audit_store(store).collect()}
    assert set(violations.values()) == {0} and len(violations) == 34


def test_run_without_new_rows_writes_nothing(store, make, monkeypatch):
    store.ingest(make(arrivals([reading(None, 1, c, c * c) for c in range(1, 9)])), "a", T1)
    first = run_rule_scoring(store, now=T1)
    monkeypatch.setattr(Store, "write", lambda *a: (_ for _ in ()).throw(AssertionError("must not write")))
    second = run_rule_scoring(store, now=T2)
    assert (second["status"], second["raw_rows_used"]) == ("SUCCESS", 0)
    assert second["checkpoint_before"] == second["checkpoint_after"] == first["checkpoint_after"] == 8
    assert store.runs().filter("run_id = 2").first().notes.startswith("No new raw rows to process")


def test_failed_run_leaves_no_trace_but_its_log_row(store, make):
    store.ingest(make(arrivals([reading(None, 1, c, c * c) for c in range(1, 9)])), "a", T1)
    def stop(run_id):
        raise RuntimeError("disk full")
    with pytest.raises(RuntimeError, match="disk full"):
        run_rule_scoring(store, now=T1, before_commit=stop)
    assert store.processed().count() == store.predictions().count() == store.alerts().count() == 0
    run = store.runs().first()
    assert (run.status, run.notes, run.checkpoint_after) == ("FAILED", "disk full", 0)
    assert store.checkpoint()["last_processed_raw_id"] == 0
    assert run_rule_scoring(store, now=T2)["processed_rows"] == 8
    assert store.checkpoint()["last_processed_raw_id"] == 8


def test_alert_resolution_and_reopening(store, make):
    store.ingest(make(arrivals([reading(None, 1, c, c * c) for c in range(1, 9)])), "a", T1)
    assert run_rule_scoring(store, now=T1)["alert_rows"] == 1
    alert = store.alerts().first()
    assert not alert.is_resolved and alert.severity == "CRITICAL"
    store.resolve_alert(alert.id, T1)
    assert store.alerts().first().is_resolved
    at = store.position("x")
    run = store.start_run("x", "again", T2, at)
    scored = store.predictions().select("raw_id", *NATURAL_KEY[:2], F.col("latest_cycle").alias("time_in_cycles"), "risk_score",
                                        "predicted_rul", "risk_level", "recommended_action")
    written = rule_run.write_results(store, scored, rule_run.score_alerts, run["run_id"], at, 1, "demo-v1", T2)
    store.finish_run(run, "SUCCESS", T2, **written)
    again = store.alerts().first()
    assert again.id == alert.id and not again.is_resolved and again.created_at == T2
    prediction = store.predictions().first()
    assert (prediction.created_at, prediction.prediction_time, prediction.run_id) == (T1, T2, 2)


def test_schedule(store):
    assert store.schedule_times() == ["07:00", "12:00", "17:00"]
    store.set_schedule("06:30", "11:00", "23:59", T1)
    store.set_schedule("06:00", "11:00", "23:59", T2)
    assert store.schedule_times() == ["06:00", "11:00", "23:59"]
    with pytest.raises(ValueError):
        store.set_schedule("25:00", "11:00", "23:59")


def test_context_is_empty_without_checkpoint_or_look_back(make):
    rows = make([reading(c, 1, c, c) for c in range(1, 9)])
    batch = rows.filter("raw_id > 6")
    assert context_rows(rows, batch, 0, 50).count() == 0
    assert context_rows(rows, batch, 6, 0).count() == 0
    assert sorted(r.raw_id for r in context_rows(rows, batch, 6, 3).collect()) == [4, 5, 6]


def test_context_of_a_large_key_list(make, monkeypatch):
    rows = make([reading(e * 100 + c, e, c, c) for e in (1, 2, 3) for c in range(1, 9)])
    batch = make([reading(900 + e, e, 9, 1) for e in (1, 3)])
    small = context_rows(rows, batch, 899, 3)
    monkeypatch.setattr(rule_run, "broadcast_if_small", lambda df: (df, False))
    large = context_rows(rows, batch, 899, 3)
    assert sorted(r.raw_id for r in small.collect()) == sorted(r.raw_id for r in large.collect()) == [106, 107, 108, 306, 307, 308]


def test_late_cycles_are_counted_and_recomputed(store, make):
    store.ingest(make(arrivals([reading(None, 1, c, c * c) for c in (1, 2, 5)])), "a", T1)
    run_rule_scoring(store, now=T1)
    store.ingest(make(arrivals([reading(None, 1, 3, 100), reading(None, 1, 6, 36)], 10)), "b", T1)
    raw = store.raw()
    assert [r.time_in_cycles for r in late_rows(raw.filter("raw_id <= 3"), raw.filter("raw_id > 3")).collect()] == [3]
    run_rule_scoring(store, now=T1)
    before = {r.time_in_cycles: r.delta_s2 for r in store.processed().collect()}
    assert before[5] == 25.0 - 4.0
    recompute_keys(store, store.raw(), now=T2)
    after = {r.time_in_cycles: (r.delta_s2, r.demo_rul) for r in store.processed().collect()}
    assert after[5] == (25.0 - 100.0, 1) and len(after) == 5
    assert store.checkpoint()["last_processed_raw_id"] == 5


def test_rows_of_batch(make):
    rows = make([reading(i, 1, i, 1) for i in (1, 2, 3, 4)])
    assert sorted(r.raw_id for r in rows_of_batch(rows, rows.filter("raw_id > 2")).collect()) == [3, 4]


def test_keyed_inserts_and_upserts(spark):
    target = spark.createDataFrame([(1, 10, 1), (2, 20, 1)], "k int, v int, made int")
    batch = spark.createDataFrame([(2, 21, 2, 0), (3, 31, 2, 1), (3, 30, 2, 0)], "k int, v int, made int, at int")
    order = [F.col("at")]
    assert [(r.k, r.v) for r in insert_absent(target, batch, ["k"], order).collect()] == [(3, 30)]
    assert insert_counts(target, batch, ["k"], order).first() == (3, 1, 2)
    merged = upsert(target, batch.filter("v != 31").drop("at"), ["k"], ["made"])
    assert sorted(tuple(r) for r in merged.collect()) == [(1, 10, 1), (2, 21, 1), (3, 30, 2)]


def test_ids_are_unique_when_numbers_collide(store, make):
    """Files and partitions that count from 0 each, and readings with one number, get ids of their own."""
    rows = [{**reading(None, part, cycle, cycle), "arrival_seq": cycle // 2, "arrival_part": None} for part in range(3) for cycle in range(6)]
    for row in rows:
        del row["raw_id"], row["arrival_part"]
    batch = make(rows).withColumn("arrival_part", F.col("engine_id").cast("string"))
    assert store.ingest(batch.repartition(5), "a", T1)["to_raw_id"] == 18
    assert store.ingest(batch.withColumn("engine_id", F.col("engine_id") + 10).repartition(3), "b", T1)["from_raw_id"] == 19
    raw = store.raw().orderBy("raw_id").collect()
    assert [r.raw_id for r in raw] == list(range(1, 37))
    assert [(r.time_in_cycles // 2, r.engine_id) for r in raw[:18]] == sorted((r.time_in_cycles // 2, r.engine_id) for r in raw[:18])


def test_a_run_opens_new_folders_and_the_tail_only(spark, store, folder, monkeypatch):
    rows = telemetry(spark, folder).withColumn("arrival_seq", F.col("raw_id") - 1).drop("raw_id")
    for k in range(3):
        store.ingest(rows.filter(F.col("arrival_seq") % 3 == k), f"i{k}", T1)
        if k < 2:
            run_rule_scoring(store, now=T1, window_cycles=3)
    last = store.position("rule_scoring")
    files = store.raw_between(last["checkpoint"]).inputFiles()
    assert files and all("ingest_id=i2" in f for f in files)
    assert store.raw_between(10**9).count() == 0
    monkeypatch.setattr(Store, "raw", lambda self: (_ for _ in ()).throw(AssertionError("the history is not read")))
    run_rule_scoring(store, now=T2, window_cycles=3)
    monkeypatch.undo()
    longest = store.tail(store.position("rule_scoring")["last_working_run"]).groupBy("source_file", "engine_id").count().agg(F.max("count")).first()[0]
    assert 0 < longest <= rule_run.TAIL_ROWS


def test_short_tails_fall_back_to_the_history(store, make, monkeypatch):
    monkeypatch.setattr(rule_run, "TAIL_ROWS", 2)
    rows = [reading(None, 1, c, (c * 7) % 13) for c in range(1, 13)]
    store.ingest(make(arrivals(rows[:8])), "a", T1)
    run_rule_scoring(store, now=T1, window_cycles=6)
    store.ingest(make(arrivals(rows[8:])), "b", T1)
    assert run_rule_scoring(store, now=T1, window_cycles=6)["context_rows"] == 6
    whole = build_features(clean_telemetry(store.raw(), unique_ids=True)).orderBy("raw_id").select(*DERIVED).collect()
    assert [tuple(r) for r in store.processed().orderBy("raw_id").select(*DERIVED).collect()] == [tuple(r) for r in whole]


def test_reports_read_separate_runs_without_resolving(store, make):
    for k in range(3):
        store.ingest(make(arrivals([reading(None, 1, 10 * k + c, c * c) for c in range(1, 5)])), f"i{k}", T1)
        run_rule_scoring(store, now=T1)
    for table in ("processed", "predictions"):
        assert store.overlapping_runs(table) == []
        assert "Aggregate" not in getattr(store, table)()._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    recompute_keys(store, store.raw(), now=T2)
    assert store.overlapping_runs("processed") == [1, 2, 3, 4] and store.processed().count() == 12
    assert store.predictions().count() == 3 and store.predictions().filter("run_id = 4").count() == 1


def test_failed_recompute_is_logged(store, make):
    store.ingest(make(arrivals([reading(None, 1, c, c * c) for c in range(1, 9)])), "a", T1)
    run_rule_scoring(store, now=T1)
    error = "no room " * 1000

    def stop(run_id):
        raise RuntimeError(error)

    with pytest.raises(RuntimeError):
        recompute_keys(store, store.raw(), now=T2, before_commit=stop)
    failed = store.runs().filter("run_id = 2").first()
    assert (failed.status, failed.notes, failed.checkpoint_after) == ("FAILED", error, 8)
    assert store.processed().count() == 8 and store.predictions().filter("run_id = 2").count() == 0
    assert recompute_keys(store, store.raw(), now=T2)["prediction_rows"] == 1


def test_marks_are_folded(store, make, monkeypatch):
    from gearwatch.plans import store as module
    monkeypatch.setattr(module, "MARK_FOLDERS", 3)
    for k in range(9):
        rows = [reading(None, e, k + 1, k) for e in range(k % 3, 4)] + [reading(None, 0, 1, 5)]
        store.ingest(make(arrivals(rows)), f"i{k}", T1)
        assert len(store._mark_folders()) <= 3 + 1
        truth = {r.engine_id: r.c for r in store.raw().groupBy("engine_id").agg(F.max("time_in_cycles").alias("c")).collect()}
        assert {r.engine_id: r._mark for r in store.newest_cycles().collect()} == truth
    assert store.ingests().filter("full_marks = 1").count() >= 2
    assert store.raw().groupBy(*NATURAL_KEY).count().filter("count > 1").count() == 0


def test_an_ingest_moves_the_readings_once(spark, store, make):
    """Keys and places are put in order; the readings are staged as they came and joined to their ids."""
    store.ingest(make(arrivals([reading(None, e, c, 10 * e + c) for e in (1, 2) for c in (1, 2, 3)])), "a", T1)
    again = [reading(None, 3, 1, 31), reading(None, 1, 2, 99), reading(None, 3, 1, 98), reading(None, 2, 0, 20)]
    assert store.ingest(make(arrivals(again, 10)).repartition(3), "b", T1)["inserted"] == 2
    for step in ("firsts", "ordered"):
        columns = spark.read.parquet(f"{store.root}/staging/{step}/ingest_id=b").columns
        assert columns and not set(columns) & set(READINGS)
    raw = {r.raw_id: (r.engine_id, r.time_in_cycles, r.s2, r.s21) for r in store.raw().collect()}
    assert raw == {**{i + 1: (e, c, 10.0 * e + c, 10.0 * e + c) for i, (e, c) in enumerate((e, c) for e in (1, 2) for c in (1, 2, 3))},
                   7: (3, 1, 31.0, 31.0), 8: (2, 0, 20.0, 20.0)}


@pytest.mark.parametrize("limit", [0, 10**6])
def test_ids_do_not_depend_on_how_they_are_joined(spark, store, folder, monkeypatch, limit):
    from gearwatch.plans import store as module
    monkeypatch.setattr(module, "BROADCAST_ROWS", limit)
    rows = telemetry(spark, folder).withColumn("arrival_seq", F.col("raw_id") - 1)
    store.ingest(rows.drop("raw_id").repartition(7, "s3"), "a", T1)
    wanted = sorted((r.raw_id, *(getattr(r, c) for c in NATURAL_KEY), r.s2) for r in rows.collect())
    assert [(r.raw_id, *(getattr(r, c) for c in NATURAL_KEY), r.s2) for r in store.raw().orderBy("raw_id").collect()] == wanted


def test_a_tail_is_written_only_where_much_is_behind_it(store, make):
    """Runs of like size read the readings behind the last tail; a small run after large ones begins a new tail."""
    names, rows, first = [], [reading(None, e, c, (c * 7) % 13) for c in range(1, 61) for e in (1, 2)], 0
    for k, size in enumerate((80, 20, 4, 4)):
        store.ingest(make(arrivals(rows[first:first + size], first)), f"i{k}", T1)
        first += size
        assert run_rule_scoring(store, now=T1)["context_rows"] == (0, 80, 100, 100)[k]
        names.append(folder_names(store.spark, f"{store.root}/tails"))
    assert sorted(r.raw_id for r in store.tail(4).collect()) == list(range(first - 100 + 1, first + 1))
    assert names == [[], [], ["run_id=3"], ["run_id=3"]]
    whole = build_features(clean_telemetry(store.raw(), unique_ids=True)).orderBy("raw_id").select(*DERIVED).collect()
    got = store.processed().orderBy("raw_id").select(*DERIVED).collect()
    np.testing.assert_allclose(np.array(got, float), np.array(whole, float), atol=1e-9)
