import re

from gearwatch.operators.clean import clean_telemetry, first_by
from gearwatch.operators.features import build_features, latest_per_key
from gearwatch.operators.scoring import score_latest
from gearwatch.plans.reports import latest_predictions
from gearwatch.plans.rule_run import new_rows
from gearwatch.sources.fixtures import telemetry
from pyspark.sql import functions as F
import pytest


def plan(df, final=False):
    if final:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if final else text


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "raw")
    telemetry(spark, folder).write.parquet(path)
    return lambda: spark.read.parquet(path)


def test_features_need_one_shuffle(stored):
    text = plan(build_features(clean_telemetry(stored(), unique_ids=True), rows=1000))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in text and "Python" not in text


def test_search_for_hot_keys_disappears_when_there_are_none(stored):
    text = plan(build_features(clean_telemetry(stored(), unique_ids=True)), final=True)
    assert text.count("Exchange hashpartitioning") == 1
    assert "Union" not in text and "BroadcastHashJoin" not in text


def test_hot_key_segments_are_in_the_shuffle_key(stored):
    text = plan(build_features(clean_telemetry(stored(), unique_ids=True), hot_rows=5))
    assert re.search(r"Exchange hashpartitioning\(source_file#\d+, engine_id#\d+, _segment#\d+L", text)
    assert text.count("SinglePartition") == 0


def test_latest_row_is_cut_before_the_shuffle(stored):
    text = plan(latest_per_key(stored()))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_dedup_is_cut_before_the_shuffle(stored):
    text = plan(first_by(stored(), ["raw_id"], [F.col("inserted_at")]))
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_scoring_reads_only_what_it_needs(stored):
    text = plan(score_latest(clean_telemetry(stored(), unique_ids=True)))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "s1:" not in schema and "op_setting" not in schema and "s2:" in schema
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_incremental_filter_reaches_the_scan(stored):
    text = plan(new_rows(stored(), 400, 700))
    assert "GreaterThan(raw_id,400)" in text and "LessThanOrEqual(raw_id,700)" in text


def test_newest_rows_use_top_k(spark, stored):
    rows = stored().selectExpr("raw_id AS id", "inserted_at AS prediction_time", "'LOW' AS risk_level", "engine_id")
    text = plan(latest_predictions(rows, "LOW", "1-9"))
    assert "TakeOrderedAndProject" in text
    assert text.index("Filter") < text.index("TakeOrderedAndProject")
