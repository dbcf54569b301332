"""Scoring with keyed state against the incremental run over the same batches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gearwatch import schema as S
from gearwatch.plans.rule_run import run_rule_scoring
from gearwatch.plans.store import Store
from gearwatch.sources.fixtures import telemetry
from gearwatch.streaming import stateful


def source(spark, path):
    return spark.readStream.schema(S.RAW).option("maxFilesPerTrigger", 1).parquet(path)


def rounded(rows):
    return sorted(tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in rows)


def test_state_equals_the_incremental_run(spark, folder, tmp_path):
    """Late cycles, machines that pause, and a query that is stopped and started again after every file."""
    rows = telemetry(spark, folder).withColumn("slot", F.col("raw_id") % 7 % 3)  # batches that interleave in time
    store, files, out = Store(spark, str(tmp_path / "store")).create(), str(tmp_path / "in"), str(tmp_path / "out")
    features = ["raw_id", *S.DERIVED, "demo_rul"]
    wanted, scored = [], []
    for k in range(3):
        batch = rows.filter(F.col("slot") == k).drop("slot")
        store.ingest(batch.withColumn("arrival_seq", F.col("raw_id")).drop("raw_id"), f"b{k}")
        run_rule_scoring(store)
        low, high = store.ingests().filter(F.col("ingest_id") == f"b{k}").select("from_raw_id", "to_raw_id").first()
        store.raw_between(low - 1, high).select(*S.RAW.names).coalesce(1).write.mode("append").parquet(files)
        stateful.score_with_state(source(spark, files), out, str(tmp_path / "offsets")).awaitTermination()
        wanted = store.processed().select(*features).collect()
        scored = store.predictions().select("raw_id", "risk_score", "risk_level", "predicted_rul").collect()
    assert rounded(stateful.scored_batches(spark, out, "features").select(*features).collect()) == rounded(wanted)
    found = stateful.scored_batches(spark, out, "predictions")
    assert rounded(found.select("raw_id", "risk_score", "risk_level", "predicted_rul").collect()) == rounded(scored)
    assert found.select("batch_id").distinct().count() == 3
    alerts = stateful.scored_batches(spark, out, "alerts").select("raw_id", "severity", "message")
    assert sorted(alerts.collect()) == sorted(store.alerts().select("raw_id", "severity", "message").collect())


def test_the_state_holds_the_newest_rows_only(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="needs 4 earlier"):
        stateful.keyed_features(source(spark, folder), 5, 3)
    files, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = telemetry(spark, folder).orderBy("raw_id")
    half = rows.count() // 2
    results = []
    for tail in (4, 50):
        for low, high in ((0, half), (half, 2 * half + 1)):
            rows.filter((F.col("raw_id") > low) & (F.col("raw_id") <= high)).coalesce(1).write.mode("append").parquet(f"{files}{tail}")
        stateful.score_with_state(source(spark, f"{files}{tail}"), f"{out}{tail}", str(tmp_path / f"offsets{tail}"), tail_rows=tail).awaitTermination()
        results.append(rounded(stateful.scored_batches(spark, f"{out}{tail}", "features").select("raw_id", *S.DERIVED).collect()))
    assert results[0] == results[1] and len(results[0]) == rows.count()
    with pytest.raises(FileNotFoundError):
        stateful.scored_batches(spark, str(tmp_path / "nothing"), "features")


def test_rolling_equals_a_plain_version():
    values = np.random.default_rng(1).normal(size=(30, 2)) * 100
    for window in (1, 2, 5, 40):
        mean, deviation, change = stateful.rolling(values, window)
        for i in range(30):
            seen = values[max(0, i - window + 1):i + 1]
            assert np.allclose(mean[i], seen.mean(axis=0)) and np.allclose(deviation[i], seen.std(axis=0, ddof=1) if len(seen) > 1 else 0)
            assert np.allclose(change[i], values[i] - values[i - 1] if i else 0)


class Entries:
    """A map state that counts what is asked of it."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value


def test_a_bucket_of_machines_is_one_frame_and_few_entries():
    names = [c for c in S.PROCESSED_COLUMNS if c in S.RAW.names]
    rows = pd.DataFrame({c: np.arange(600.0) for c in names}).assign(
        raw_id=np.arange(600), source_file=[f"s{i % 2}" for i in range(600)], engine_id=np.arange(600) // 6, time_in_cycles=np.arange(600) % 6, block=np.arange(600) // 6 % 4)
    processor = stateful.KeyedFeatures(5, 50)
    processor.blocks = Entries()
    found = pd.concat([*processor.handleInputRows((0,), iter([rows[:240], rows[240:400]]), None), *processor.handleInputRows((0,), iter([rows[400:]]), None)])
    assert processor.blocks.calls <= 16 and sorted(found["raw_id"]) == list(range(600))
    assert list(found.columns) == stateful.OUTPUT.names
    series = rows.groupby(["source_file", "engine_id"])["s2"]
    wanted = series.transform(lambda s: s.rolling(5, 1).mean())
    assert np.allclose(found.sort_values("raw_id")["rolling_avg_s2"], wanted)
