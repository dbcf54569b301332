import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import reading
from gearwatch.operators import metrics, ml
from gearwatch.operators.clean import clean_telemetry
from gearwatch.operators.features import build_features, training_columns
from gearwatch.plans.model_run import latest_inputs, run_trained_model
from gearwatch.plans.rule_run import run_rule_scoring
from gearwatch.plans.store import Store
from gearwatch.schema import MODEL_INPUTS
from gearwatch.sources.fixtures import telemetry


def fake():
    class Fake:
        classes_ = [0, 1]

        def predict_proba(self, inputs):
            assert list(inputs.columns) == ["s2"]
            return [[0.1, 0.9] if v > 642 else [0.75, 0.25] for v in inputs["s2"]]

    return Fake()


def plain():
    class Plain:
        def predict(self, inputs):
            return inputs["s2"] / 1000 + 0.5

    return Plain()


def scored_rows(make):
    return make([reading(1, 1, 100, 0, s2=642.1), reading(2, 2, 120, 0, s2=641.2)])


def test_positive_class_is_used(make):
    rows = ml.predict_foreign(fake(), scored_rows(make), ["s2"]).orderBy("raw_id").collect()
    assert [(r.risk_score, r.risk_level, r.predicted_rul) for r in rows] == [(0.9, "HIGH", None), (0.25, "LOW", None)]


def test_predictions_without_probabilities_are_clipped(make):
    rows = ml.predict_foreign(plain(), scored_rows(make), ["s2"]).collect()
    assert {r.risk_score for r in rows} == {1.0}


@pytest.mark.parametrize("classes,place", [([0, 1], 1), ([1, 0], 0), (["0", "1"], 1), (["ok", "bad"], 1), ([0], 0), ([], 0)])
def test_positive_index(classes, place):
    assert ml.positive_index(classes) == place


def test_missing_features_are_named(make):
    with pytest.raises(ValueError, match="s3_x, s4_x"):
        ml.require_features(scored_rows(make), ["s2", "s3_x", "s4_x"])


def test_model_inputs_and_training_columns(make):
    assert len(MODEL_INPUTS) == 45
    features = build_features(clean_telemetry(scored_rows(make)))
    assert set(training_columns(features).columns) == set(MODEL_INPUTS)


def test_split_keeps_engines_whole(spark, folder):
    rows = telemetry(spark, folder).select("engine_id", "raw_id")
    train, test = ml.split_engines(rows)
    left = {r[0] for r in train.select("engine_id").distinct().collect()}
    right = {r[0] for r in test.select("engine_id").distinct().collect()}
    total = rows.select("engine_id").distinct().count()
    assert not left & right and len(left) == int(total * 0.7) and len(left | right) == total
    assert {r[0] for r in ml.split_engines(rows)[0].select("engine_id").distinct().collect()} == left
    members, others = ml.split_members(rows, rows.filter("engine_id < 5"))
    assert members.count() + others.count() == rows.count() and others.filter("engine_id < 5").isEmpty()


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4, "label int, prediction int")
    assert metrics.binary_metrics(df).first() == pytest.approx((3 / 5, 3 / 4, 7 / 10))
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert report["1"].support == 4 and report["0"].precision == pytest.approx(4 / 5)
    assert report["macro avg"].recall == pytest.approx((3 / 4 + 4 / 6) / 2)
    assert report["weighted avg"].recall == pytest.approx(report["accuracy"].precision)
    nothing = spark.createDataFrame([(0, 0)], "label int, prediction int")
    assert metrics.binary_metrics(nothing).first() == (0.0, 0.0, 1.0)


def test_training_rows_are_dealt_evenly(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ml, "DEALT_ABOVE", 100)
    monkeypatch.setattr(ml, "FILE_ROWS", 60)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 500, 1, 1).selectExpr("id", "id % 2 AS label")
    table = ml.training_table(rows, str(tmp_path / "large"), 500)
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) % cores == 0 and max(sizes) <= 70 and max(sizes) - min(sizes) <= 1 and sorted(r.id for r in table.collect()) == list(range(500))
    read = table.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(read) % cores == 0 and max(read) - min(read) <= 4
    small = ml.training_table(rows.limit(80), str(tmp_path / "small"), 80)
    assert small.count() == 80 and len(small.inputFiles()) == 1


def test_kept_node_ids_give_the_same_trees(spark, folder):
    rows = ml.with_label(build_features(clean_telemetry(telemetry(spark, folder), unique_ids=True)), 2).cache()
    kept, sent = (ml.train(rows, ml.forest(6, depth=6).setCacheNodeIds(keep)) for keep in (True, False))
    assert ml.forest().getCacheNodeIds()
    trees = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in (kept, sent)]
    assert trees[0] == trees[1] and "If" in trees[0]
    rows.unpersist()


def test_trained_run(spark, folder, tmp_path):
    features = build_features(clean_telemetry(telemetry(spark, folder), unique_ids=True))
    model = ml.train(ml.with_label(features, 2), ml.forest(trees=5, depth=4))
    path = str(tmp_path / "model")
    ml.save_model(model, path)
    assert ml.model_features(ml.load_model(spark, path)) == MODEL_INPUTS
    with pytest.raises(FileNotFoundError):
        ml.load_model(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        ml.model_features(object())

    store = Store(spark, str(tmp_path / "store")).create()
    noon = dt.datetime(2024, 3, 1, 12, 0)
    assert run_trained_model(store, path, respect_schedule=True, as_of=dt.datetime(2024, 3, 1, 12, 1))["status"] == "SKIPPED"
    assert store.runs().count() == 0
    empty = run_trained_model(store, path, as_of=noon)
    assert (empty["status"], empty["prediction_rows"]) == ("SUCCESS", 0)

    store.ingest(telemetry(spark, folder).withColumn("arrival_seq", F.col("raw_id") - 1).drop("raw_id"), "all", noon)
    run_rule_scoring(store, now=noon)
    limited = latest_inputs(store.processed(), MODEL_INPUTS, 3).collect()
    assert [(r.source_file, r.engine_id) for r in limited] == sorted((r.source_file, r.engine_id) for r in limited) and len(limited) == 3
    result = run_trained_model(store, path, respect_schedule=True, as_of=noon)
    machines = store.processed().select("source_file", "engine_id").distinct().count()
    assert result["prediction_rows"] == machines and store.checkpoint()["last_processed_raw_id"] == 1000
    by_model = {r.model_version: r["count"] for r in store.predictions().groupBy("model_version").count().collect()}
    assert by_model == {"demo-v1": machines, "trees-trained-v1": machines}
    with pytest.raises(FileNotFoundError):
        run_trained_model(store, str(tmp_path / "none"), as_of=noon)
    assert store.runs().orderBy(F.col("run_id").desc()).first().status == "FAILED"


def test_a_trained_run_does_not_resolve_rule_runs(spark, folder, tmp_path):
    """Predictions of one rule run and one trained run over the same ids are read without combining versions."""
    store = Store(spark, str(tmp_path / "store")).create()
    rows = telemetry(spark, folder).withColumn("arrival_seq", F.col("raw_id")).drop("raw_id")
    total = rows.count()
    for part, (low, high) in enumerate([(0, total // 2), (total // 2, total)]):
        store.ingest(rows.filter(F.col("arrival_seq").between(low + 1, high)), f"p-{part}")
        run_rule_scoring(store)
    label = ml.with_label(store.processed(), 2).select("label", *MODEL_INPUTS)
    ml.save_model(ml.train(label, ml.forest(3, depth=3)), str(tmp_path / "model"))
    run_trained_model(store, str(tmp_path / "model"), "check")
    assert store.overlapping_runs("predictions") == store.overlapping_runs("alerts") == []
    plan = store.predictions()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.replace("Aggregate [run_id", "").replace("Aggregate [ingest_id", "")
    once = store.predictions().count()
    run_trained_model(store, str(tmp_path / "model"), "check")
    assert len(store.overlapping_runs("predictions")) == 2 and store.predictions().count() == once


def test_node_ids_are_kept_only_where_memory_holds_them(spark, folder, monkeypatch):
    """Ids beyond the memory lay on the disk three times over, 400 bytes a row each."""
    rows = ml.with_label(build_features(clean_telemetry(telemetry(spark, folder), unique_ids=True)), 2).select("label", *MODEL_INPUTS).cache()
    assert ml.block_memory(spark) > 1 << 20
    forest, boosted = ml.forest(6, depth=6), ml.boosted(2)
    assert ml.ids_in_memory(forest, rows, MODEL_INPUTS) is forest and ml.ids_in_memory(boosted, rows, MODEL_INPUTS) is boosted
    kept, names, fitted = ml.train(rows, forest), MODEL_INPUTS, []
    monkeypatch.setattr(ml, "block_memory", lambda _: 1000 * 100)
    plain = ml.ids_in_memory
    monkeypatch.setattr(ml, "ids_in_memory", lambda *a: fitted.append(plain(*a)) or fitted[-1])
    sent = ml.train(rows, forest, names)
    assert not fitted[0].getCacheNodeIds() and forest.getCacheNodeIds() and fitted[0].getNumTrees() == 6
    trees = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in (kept, sent)]
    assert trees[0] == trees[1] and "If" in trees[0]
    rows.unpersist()


def test_training_tables_and_store_tables_leave_no_shuffle_files(spark, make, tmp_path):
    from pathlib import Path

    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    files = lambda: {p.name for folder in folders for p in Path(folder).rglob("shuffle_*.data")}
    before = files()
    assert ml.training_table(spark.range(200_000), str(tmp_path / "t"), 200_000).count() == 200_000
    store = Store(spark, str(tmp_path / "store")).create()
    rows = build_features(clean_telemetry(make([reading(k, k % 5, k, k, inserted_at=None) for k in range(1, 50)]), unique_ids=True))
    before |= files()
    assert ml.training_table(spark.range(200_000), str(tmp_path / "u"), 200_000) and files() <= before
    store.write("processed", rows.withColumn("processed_at", F.lit(None).cast("timestamp")).withColumn("inserted_at", F.lit(None).cast("timestamp")), 1)
    assert files() <= before
