"""Checkpointed incremental run of the rule scorer."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from gearwatch import schema as S
from gearwatch.operators.clean import clean_telemetry
from gearwatch.operators.features import build_features, last_rows, latest_per_key
from gearwatch.operators.scoring import score_alerts, score_risk
from gearwatch.operators.skew import HOT_ROWS, broadcast_if_small
from gearwatch.plans.store import TAIL_ROWS, Store, utc_now
from gearwatch.schema import CYCLE, ENGINE, KEY, SOURCE, Thresholds

#: A run writes a tail when it looks back on more readings behind the last one than this many times its own.
LOOK_BACK = 4


def new_rows(raw: DataFrame, after: int, up_to: int | None = None) -> DataFrame:
    """Rows past the checkpoint; the range reaches the scan."""
    rows = raw.filter(F.col("raw_id") > after)
    return rows if up_to is None else rows.filter(F.col("raw_id") <= up_to)


def batch_facts(rows: DataFrame) -> DataFrame:
    """Row count, id range and newest insert time of a batch."""
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.min("raw_id").alias("from_raw_id"),
                    F.max("raw_id").alias("to_raw_id"), F.max("inserted_at").alias("last_inserted_at"))


def context_rows(raw: DataFrame, batch: DataFrame, checkpoint: int, rows: int) -> DataFrame:
    """Newest ``rows`` older rows of every key in the batch; none without checkpoint or look-back.

    A small key list is broadcast and filters the history first. A large one is joined after
    the history is cut to the newest rows per key, which happens on the map side.
    """
    history = raw.filter(F.col("raw_id") <= checkpoint)
    if checkpoint <= 0 or rows <= 0:
        return history.filter(F.lit(False))
    keys, small = broadcast_if_small(batch.select(*KEY).distinct())
    if small:
        return last_rows(history.join(keys, KEY, "left_semi"), rows)
    return last_rows(history, rows).join(keys, KEY, "left_semi")


def newest_readings(store: Store, checkpoint: int, rows: int, run_id: int) -> DataFrame:
    """Readings up to the checkpoint that hold the newest ``TAIL_ROWS`` of every key.

    Where many have come since the last tail, beside the tail and this run's ``rows``, they are cut to a new
    tail first. So what a run reads does not grow with the history, and few runs write a tail.
    """
    history, held, behind = store.look_back(checkpoint)
    if behind <= max(LOOK_BACK * rows, held):
        return history
    return store.write("tails", last_rows(history, TAIL_ROWS), run_id)


def only_new(features: DataFrame, after: int) -> DataFrame:
    """Feature rows of the new batch: ids past the checkpoint."""
    return features.filter(F.col("raw_id") > after)


def rows_of_batch(features: DataFrame, batch: DataFrame) -> DataFrame:
    """Feature rows whose raw id is in the batch, for batches that are not an id range."""
    return features.join(batch.select("raw_id"), "raw_id", "left_semi")


def result_ids(df: DataFrame, base: int, first_raw_id: int) -> DataFrame:
    """Ids that are unique in the table, grow by run and do not change when a task is retried."""
    return df.withColumn("id", F.col("raw_id") - F.lit(first_raw_id) + F.lit(base + 1))


def write_results(store: Store, scored: DataFrame, alerts_of: Callable[[DataFrame], DataFrame], run_id: int,
                  at: dict, first_raw_id: int, model: str, now: datetime) -> dict:
    """Write predictions of a run, then the alerts drawn from the written predictions.

    Returns their counts and the last ids given out.
    """
    time = F.lit(now).cast("timestamp")
    rows = result_ids(scored, at["last_prediction_id"], first_raw_id).select(
        "*", F.lit(model).alias("model_version"), time.alias("prediction_time"), time.alias("created_at"),
        F.col(CYCLE).alias("latest_cycle"))
    predictions = store.write("predictions", rows, run_id)
    opened = alerts_of(predictions.withColumnRenamed("latest_cycle", CYCLE))
    rows = result_ids(opened, at["last_alert_id"], first_raw_id).select(
        "*", F.lit(model).alias("model_version"), time.alias("created_at"))
    alerts = store.write("alerts", rows, run_id)
    found = written_counts(predictions=predictions, alerts=alerts)
    return {"prediction_rows": found["predictions"][0], "alert_rows": found["alerts"][0], "model_version": model,
            "last_prediction_id": found["predictions"][1], "last_alert_id": found["alerts"][1]}


def written_counts(**tables: DataFrame) -> dict[str, tuple[int, int | None]]:
    """Row count and highest id of several written tables in one job."""
    parts = []
    for name, df in tables.items():
        last = F.max("id") if "id" in df.columns else F.lit(None).cast("bigint")
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), last.alias("last_id")).select(F.lit(name).alias("name"), "rows", "last_id"))
    return {r.name: (r.rows, r.last_id) for r in reduce(DataFrame.unionByName, parts).collect()}


def late_rows(context: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of a batch below a cycle of their key that was already processed."""
    newest, _ = broadcast_if_small(context.groupBy(*KEY).agg(F.max(CYCLE).alias("_newest")))
    return batch.join(newest, KEY).filter(F.col(CYCLE) < F.col("_newest")).drop("_newest")


def run_rule_scoring(store: Store, run_type: str = "manual", window_cycles: int = S.CONTEXT_ROWS, *,
                     cuts: Thresholds = Thresholds(), model: str = S.RULE_MODEL, up_to: int | None = None,
                     hot_rows: int = HOT_ROWS, now: datetime | None = None,
                     before_commit: Callable[[int], None] | None = None) -> dict:
    """Process raw rows past the checkpoint and commit features, scores, alerts and position.

    On an error the outputs stay invisible, the run is logged as FAILED, the checkpoint does
    not move and the error is raised again. Without new rows the run succeeds and writes nothing.
    """
    now = now or utc_now()
    at = store.position(S.RULE_PIPELINE)
    before = at["checkpoint"]
    run = store.start_run(S.RULE_PIPELINE, run_type, now, at, before)
    run_id, facts = run["run_id"], {"raw_rows_used": 0}
    try:
        rows, low, high, last = batch_facts(store.raw_between(before, up_to)).first()
        if not rows:
            # Fixed value: the wording of run notes is stored and read by people and scripts.
            notes = f"No new raw rows to process; checkpoint={before}; context_cycles={window_cycles}"
            store.finish_run(run, "SUCCESS", now, checkpoint_after=before, notes=notes)
            return {"run_id": run_id, "status": "SUCCESS", "raw_rows_used": 0, "processed_rows": 0,
                    "prediction_rows": 0, "alert_rows": 0, "checkpoint_before": before, "checkpoint_after": before}
        facts = {"raw_rows_used": rows, "from_raw_id": low, "to_raw_id": high}
        batch, context_count = store.raw_between(before, high), 0
        frame = batch
        if before > 0 and window_cycles > 0:
            history = newest_readings(store, before, rows, run_id) if window_cycles <= TAIL_ROWS else store.raw()
            context = store.write("context", context_rows(history, batch, before, window_cycles), run_id)
            context_count = context.count()
            frame = context.unionByName(batch)
        features = only_new(build_features(clean_telemetry(frame, unique_ids=True), rows=rows + context_count,
                                           hot_rows=hot_rows), before)
        processed = store.write("processed", features.withColumn("processed_at", F.lit(now).cast("timestamp")), run_id)
        processed_count = processed.count()
        scored = score_risk(latest_per_key(processed), cuts, keep=["raw_id", SOURCE, ENGINE, CYCLE])
        results = write_results(store, scored, lambda df: score_alerts(df, cuts), run_id, at, low, model, now)
        notes = "; ".join([
            f"processed_rows={processed_count}", f"prediction_rows={results['prediction_rows']}",
            f"alerts={results['alert_rows']}", f"new_raw_rows={rows}", f"context_rows={context_count}",
            f"from_raw_id={low}", f"to_raw_id={high}", f"checkpoint_before={before}", f"checkpoint_after={high}",
            f"context_cycles={window_cycles}"])
        if before_commit:
            before_commit(run_id)
        store.finish_run(run, "SUCCESS", now, checkpoint_after=high, last_inserted_at=last, notes=notes, **facts, **results)
        return {"run_id": run_id, "status": "SUCCESS", "raw_rows_used": rows, "processed_rows": processed_count,
                "prediction_rows": results["prediction_rows"], "alert_rows": results["alert_rows"], "from_raw_id": low,
                "to_raw_id": high, "checkpoint_before": before, "checkpoint_after": high, "context_rows": context_count}
    except Exception as error:
        store.finish_run(run, "FAILED", now, checkpoint_after=before, notes=str(error), **facts)
        raise


def recompute_keys(store: Store, keys: DataFrame, *, cuts: Thresholds = Thresholds(), model: str = S.RULE_MODEL,
                   hot_rows: int = HOT_ROWS, now: datetime | None = None,
                   before_commit: Callable[[int], None] | None = None) -> dict:
    """Rebuild the processed rows of some keys from all their readings, e.g. after late cycles.

    The newest row of each of these keys is scored again, relative to the highest signal among
    them, and alerts are drawn from it. An error leaves a FAILED row and nothing else.
    """
    now = now or utc_now()
    at = store.position(S.RULE_PIPELINE)
    before = at["checkpoint"]
    run = store.start_run(S.RULE_PIPELINE, "recompute", now, at, before)
    run_id = run["run_id"]
    try:
        wanted, _ = broadcast_if_small(keys.select(*KEY).distinct())
        rows = store.raw_between(0, before).join(wanted, KEY, "left_semi")
        features = build_features(clean_telemetry(rows, unique_ids=True), hot_rows=hot_rows)
        written = store.write("processed", features.withColumn("processed_at", F.lit(now).cast("timestamp")), run_id)
        count, low, high = written.agg(F.count(F.lit(1)), F.min("raw_id"), F.max("raw_id")).first()
        scored = score_risk(latest_per_key(written), cuts, keep=["raw_id", SOURCE, ENGINE, CYCLE])
        results = write_results(store, scored, lambda df: score_alerts(df, cuts), run_id, at, low or 0, model, now)
        if before_commit:
            before_commit(run_id)
        store.finish_run(run, "SUCCESS", now, checkpoint_after=before, raw_rows_used=count, from_raw_id=low, to_raw_id=high,
                         notes=f"recomputed_rows={count}; prediction_rows={results['prediction_rows']}; alerts={results['alert_rows']}", **results)
        return {"run_id": run_id, "status": "SUCCESS", "processed_rows": count,
                "prediction_rows": results["prediction_rows"], "alert_rows": results["alert_rows"]}
    except Exception as error:
        store.finish_run(run, "FAILED", now, checkpoint_after=before, notes=str(error))
        raise
