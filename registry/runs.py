"""Checks of the stored runs: incremental scoring, commits, upserts, reports, audit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from gearwatch.functions.numbers import clip
from gearwatch.operators import quality
from gearwatch.operators.scoring import apply_probability, probability_alerts
from gearwatch.plans import reports, totals
from gearwatch.plans.rule_run import recompute_keys, run_rule_scoring, write_results
from gearwatch.plans.store import Store
from gearwatch.schema import KEY, NATURAL_KEY, TRACKED_SENSORS
from gearwatch.sources.fixtures import telemetry
from registry import oracle as O
from registry.common import Checks, arrivals, new_store, scored_store
from registry.oracle import r6, with_

checks = Checks()
ID = ["raw_id", *NATURAL_KEY]
IDS = ", ".join(ID)
T1, T2 = dt.datetime(2024, 3, 1, 7, 0), dt.datetime(2024, 3, 1, 12, 0)
_DERIVED = [f"{k}_{s}" for s in TRACKED_SENSORS for k in ("rolling_avg", "rolling_std", "delta")]
_memo: dict[tuple[str, str, str], Store] = {}


def _r6(columns: list[str]) -> str:
    return ", ".join(f"{r6(c)} + 0.0 AS {c}" for c in columns)


def _once(build):
    """Build a store once per session and table folder."""
    def get(spark, folder) -> Store:
        key = (spark.sparkContext.applicationId, folder, build.__name__)
        if key not in _memo:
            _memo[key] = build(spark, folder)
        return _memo[key]
    return get


# -- incremental runs -------------------------------------------------------------------------

@checks.add("incremental_features", with_(O.BATCHED, f"SELECT {IDS}, run_id, {_r6(_DERIVED)}, demo_rul FROM features"))
def incremental_features(spark, folder):
    return scored_store(spark, folder).processed().select(*ID, "run_id", *_DERIVED, "demo_rul")


@checks.add("incremental_scores", with_(O.BATCHED, "SELECT id, raw_id, run_id, 'demo-v1' AS model_version, source_file, engine_id, "
                                        "time_in_cycles AS latest_cycle, risk_score, predicted_rul, risk_level, recommended_action FROM predictions"))
def incremental_scores(spark, folder):
    return scored_store(spark, folder).predictions().drop("created_at", "prediction_time")


@checks.add("incremental_alerts", with_(O.BATCHED, "SELECT id, raw_id, run_id, source_file, engine_id, severity, message, false AS is_resolved FROM alerts"))
def incremental_alerts(spark, folder):
    return scored_store(spark, folder).alerts().drop("created_at", "model_version")


_FACTS = O.BATCHED + """,
context AS (SELECT b.run_id, count(*) AS n FROM batch_facts b, (SELECT raw_id, source_file, engine_id FROM batched) h
  WHERE h.raw_id < b.low AND EXISTS (SELECT 1 FROM batched o WHERE o.run_id = b.run_id AND o.source_file = h.source_file AND o.engine_id = h.engine_id)
    AND (SELECT count(*) FROM batched l WHERE l.source_file = h.source_file AND l.engine_id = h.engine_id AND l.raw_id > h.raw_id AND l.raw_id < b.low) < 50
  GROUP BY b.run_id),
run_rows AS (SELECT b.run_id, b.n, b.low, b.high, b.low - 1 AS before, coalesce(c.n, 0) AS context_n,
  (SELECT count(*) FROM predictions p WHERE p.run_id = b.run_id) AS predicted, (SELECT count(*) FROM alerts a WHERE a.run_id = b.run_id) AS alerted
  FROM batch_facts b LEFT JOIN context c USING (run_id))"""
_RUN = """SELECT CAST(run_id AS BIGINT) AS run_id, 'SUCCESS' AS status, n AS raw_rows_used, low AS from_raw_id, high AS to_raw_id, before AS checkpoint_before, high AS checkpoint_after,
'processed_rows=' || n || '; prediction_rows=' || predicted || '; alerts=' || alerted || '; new_raw_rows=' || n || '; context_rows=' || context_n ||
'; from_raw_id=' || low || '; to_raw_id=' || high || '; checkpoint_before=' || before || '; checkpoint_after=' || high || '; context_cycles=50' AS notes FROM run_rows"""
_RUN_COLUMNS = ["run_id", "status", "raw_rows_used", "from_raw_id", "to_raw_id", "checkpoint_before", "checkpoint_after", "notes"]


@checks.add("run_log_latest", with_(_FACTS, _RUN))
def run_log_latest(spark, folder):
    return scored_store(spark, folder).runs().select(*_RUN_COLUMNS)


@checks.add("latest_runs", with_(_FACTS, _RUN + " ORDER BY run_id DESC LIMIT 10"))
def latest_runs(spark, folder):
    return reports.latest_runs(scored_store(spark, folder).runs()).select(*_RUN_COLUMNS)


@checks.add("checkpoint_advance", """SELECT 'rule_scoring' AS pipeline_name, max(event_id) + 1 AS last_processed_raw_id,
strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_processed_inserted_at FROM events""")
def checkpoint_advance(spark, folder):
    return scored_store(spark, folder).checkpoints().drop("updated_at")


@checks.add("ingest_log", """WITH b AS (SELECT *, CASE WHEN event_id < n * 4 // 10 THEN 0 WHEN event_id < n * 7 // 10 THEN 1 ELSE 2 END AS part
  FROM events, (SELECT count(*) AS n FROM events))
SELECT 'batch-' || part AS ingest_id, count(*) AS consumed, count(*) AS inserted, CAST(0 AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS skipped,
  min(event_id) + 1 AS from_raw_id, max(event_id) + 1 AS to_raw_id FROM b GROUP BY part""")
def ingest_log(spark, folder):
    return scored_store(spark, folder).ingests().drop("committed_at", "full_marks")


# -- failure, retry, empty batch --------------------------------------------------------------

def _fail(run_id: int) -> None:
    raise RuntimeError("stopped before commit")


@_once
def _retried(spark, folder) -> Store:
    """All rows ingested; run 1 fails before its commit, run 2 succeeds, run 3 finds nothing new."""
    store = new_store(spark, "retried")
    store.ingest(arrivals(spark, folder), "all", now=T1)
    try:
        run_rule_scoring(store, now=T1, before_commit=_fail)
    except RuntimeError:
        pass
    run_rule_scoring(store, now=T1)
    run_rule_scoring(store, now=T2)
    return store


@checks.add("failed_run_invisible", """SELECT CAST(run_id AS BIGINT) AS run_id, status, CASE WHEN run_id = 3 THEN 0 ELSE n END AS raw_rows_used,
  CAST(CASE WHEN run_id = 3 THEN n ELSE 0 END AS BIGINT) AS checkpoint_before, CAST(CASE WHEN run_id = 1 THEN 0 ELSE n END AS BIGINT) AS checkpoint_after,
  CAST(CASE WHEN run_id = 2 THEN n ELSE 0 END AS BIGINT) AS visible_rows
FROM (SELECT count(*) AS n FROM events), (VALUES (1, 'FAILED'), (2, 'SUCCESS'), (3, 'SUCCESS')) r(run_id, status)""")
def failed_run_invisible(spark, folder):
    store = _retried(spark, folder)
    visible = store.processed().groupBy("run_id").agg(F.count(F.lit(1)).alias("visible_rows"))
    return (store.runs().join(visible, "run_id", "left")
            .select("run_id", "status", "raw_rows_used", "checkpoint_before", "checkpoint_after", F.coalesce("visible_rows", F.lit(0)).alias("visible_rows")))


@checks.add("committed_view", with_(O.SCORES, f"SELECT {IDS.replace('time_in_cycles', 'time_in_cycles AS latest_cycle')}, risk_score, risk_level FROM scored"))
def committed_view(spark, folder):
    return _retried(spark, folder).predictions().select("raw_id", *KEY, "latest_cycle", "risk_score", "risk_level")


@checks.add("empty_batch", """SELECT CAST(3 AS BIGINT) AS run_id, 'SUCCESS' AS status, CAST(0 AS BIGINT) AS raw_rows_used,
'No new raw rows to process; checkpoint=' || count(*) || '; context_cycles=50' AS notes FROM events""")
def empty_batch(spark, folder):
    return _retried(spark, folder).runs().filter("run_id = 3").select("run_id", "status", "raw_rows_used", "notes")


# -- upserts ----------------------------------------------------------------------------------

@checks.add("upsert_processed", with_(O.FEATURES, f"SELECT {IDS}, {_r6(['rolling_avg_s2', 'delta_s2'])}, demo_rul FROM features"))
def upsert_processed(spark, folder):
    store = _recomputed(spark, folder)
    return store.processed().select(*ID, "rolling_avg_s2", "delta_s2", "demo_rul")


@_once
def _recomputed(spark, folder) -> Store:
    """Two incremental runs, then every key rebuilt from all its readings."""
    store, rows = new_store(spark, "recomputed"), arrivals(spark, folder)
    store.ingest(rows, "all", now=T1)
    run_rule_scoring(store, now=T1, up_to=store.ingests().agg(F.max("to_raw_id")).first()[0] // 2)
    run_rule_scoring(store, now=T1)
    recompute_keys(store, store.raw(), now=T2)
    return store


def _model_results(store: Store, rows: DataFrame, value, at: dt.datetime) -> None:
    position = store.position("trained_model")
    run = store.start_run("trained_model", "check", at, position)
    top = rows.agg(F.max("value").alias("v")).scalar()
    scored = apply_probability(rows, clip(value / top, 0.0, 1.0))
    written = write_results(store, scored, probability_alerts, run["run_id"], position, 1, "m1", at)
    store.finish_run(run, "SUCCESS", at, **written)


@_once
def _rescored(spark, folder) -> Store:
    """All rows scored by event value, two alerts resolved, then the upper half scored again."""
    store = new_store(spark, "rescored")
    events = spark.read.parquet(f"{folder}/events.parquet").select((F.col("event_id") + 1).alias("raw_id"), "value")
    rows = telemetry(spark, folder).select(*ID).join(events, "raw_id")
    _model_results(store, rows, F.col("value") * 2, T1)
    low, high = store.alerts().agg(F.min("id"), F.max("id")).first()
    store.resolve_alert(low, T1)
    store.resolve_alert(high, T1)
    half = events.count() // 2
    _model_results(store, rows.filter(F.col("raw_id") > half), F.col("value") * 3, T2)
    return store


_RESCORED = O.TELEMETRY + """,
tops AS (SELECT max(value) AS v, max(value) FILTER (event_id >= n // 2) AS w, any_value(n) AS n FROM events, (SELECT count(*) AS n FROM events)),
twice AS (SELECT t.raw_id, t.source_file, t.engine_id, t.time_in_cycles, t.raw_id > n // 2 AS again,
  round_even(least(value * 2 / v, 1.0) * 1e6, 0) / 1e6 AS first_score, round_even(least(value * 3 / w, 1.0) * 1e6, 0) / 1e6 AS second_score
  FROM telemetry t JOIN events e ON e.event_id + 1 = t.raw_id, tops)"""


@checks.add("upsert_predictions", with_(_RESCORED, f"""SELECT raw_id AS id, {IDS.replace('time_in_cycles', 'time_in_cycles AS latest_cycle')}, CAST(CASE WHEN again THEN 2 ELSE 1 END AS BIGINT) AS run_id,
CASE WHEN again THEN second_score ELSE first_score END AS risk_score, '2024-03-01 07:00:00.000000' AS created_at,
CASE WHEN again THEN '2024-03-01 12:00:00.000000' ELSE '2024-03-01 07:00:00.000000' END AS prediction_time FROM twice"""))
def upsert_predictions(spark, folder):
    return _rescored(spark, folder).predictions().select(
        "id", "raw_id", *KEY, "latest_cycle", "run_id", "risk_score", "created_at", "prediction_time")


_ALERTS_AGAIN = _RESCORED + """,
firsts AS (SELECT raw_id, first_score FROM twice WHERE first_score >= 0.8),
base AS (SELECT max(raw_id) AS b, min(raw_id) AS a FROM firsts),
merged AS (SELECT t.raw_id, CASE WHEN t.first_score >= 0.8 THEN t.raw_id ELSE t.raw_id + b END AS id, t.engine_id,
  CAST(CASE WHEN again AND second_score >= 0.8 THEN 2 ELSE 1 END AS BIGINT) AS run_id,
  CASE WHEN again AND second_score >= 0.8 THEN '2024-03-01 12:00:00.000000' ELSE '2024-03-01 07:00:00.000000' END AS created_at,
  t.raw_id IN (a, b) AND NOT (again AND second_score >= 0.8) AS is_resolved
  FROM twice t, base WHERE t.first_score >= 0.8 OR (again AND second_score >= 0.8))"""


@checks.add("upsert_alerts_reset", with_(_ALERTS_AGAIN, "SELECT * FROM merged"))
def upsert_alerts_reset(spark, folder):
    return _rescored(spark, folder).alerts().select("raw_id", "id", "engine_id", "run_id", "created_at", "is_resolved")


@checks.add("resolve_alert", with_(_ALERTS_AGAIN, "SELECT is_resolved, count(*) AS alerts, min(id) AS first_id FROM merged GROUP BY ALL"))
def resolve_alert(spark, folder):
    return _rescored(spark, folder).alerts().groupBy("is_resolved").agg(F.count(F.lit(1)).alias("alerts"), F.min("id").alias("first_id"))


# -- reports ----------------------------------------------------------------------------------

_COUNTS = with_(O.BATCHED, """SELECT 'raw_rows' AS metric, count(*) AS rows FROM batched
UNION ALL SELECT 'processed_rows', count(*) FROM batched UNION ALL SELECT 'prediction_rows', count(*) FROM predictions
UNION ALL SELECT 'active_alerts', count(*) FROM alerts""")


@checks.add("headline_counts", _COUNTS)
def headline_counts(spark, folder):
    store = scored_store(spark, folder)
    return reports.headline_counts(store.raw(), store.processed(), store.predictions(), store.alerts())


_NEWEST = """newest AS (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY engine_id ORDER BY prediction_time DESC, id DESC) = 1)"""


_LEVELS = with_(O.BATCHED + ",\n" + _NEWEST, """SELECT l.level AS risk_level, count(n.engine_id) AS engines,
round_even(count(n.engine_id) / (SELECT count(*) FROM newest) * 1000, 0) / 10 AS share
FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('LOW')) l(level) LEFT JOIN newest n ON n.risk_level = l.level GROUP BY ALL""")


@checks.add("risk_distribution", _LEVELS)
def risk_distribution(spark, folder):
    return reports.risk_distribution(scored_store(spark, folder).predictions())


_SHOWN = "risk_score, risk_level, time_in_cycles AS latest_cycle, recommended_action"


@checks.add("engine_history", with_(O.BATCHED, f"SELECT id, strftime(prediction_time, '%Y-%m-%d %H:%M:%S.%f') AS prediction_time, {_SHOWN} FROM predictions WHERE engine_id = 7"))
def engine_history(spark, folder):
    return reports.engine_history(scored_store(spark, folder).predictions(), 7)


_STATUS = with_(O.BATCHED + ",\n" + _NEWEST, f"SELECT engine_id, {_SHOWN} FROM newest")


@checks.add("engine_status", _STATUS)
def engine_status(spark, folder):
    return reports.engine_status(scored_store(spark, folder).predictions())


_TOP = "top AS (SELECT * FROM predictions ORDER BY prediction_time DESC, id DESC LIMIT 200)"
_PICK = "risk_level = 'LOW' AND (engine_id BETWEEN 3 AND 50 OR engine_id = 60)"


@checks.add("latest_predictions_filtered", with_(O.BATCHED + ",\n" + _TOP, f"SELECT id, run_id, source_file, engine_id, {_SHOWN} FROM top WHERE {_PICK}"))
def latest_predictions_filtered(spark, folder):
    rows = reports.latest_predictions(scored_store(spark, folder).predictions(), "LOW", "50-3, 60, x, 1-2-3, -5")
    return rows.select("id", "run_id", *KEY, "risk_score", "risk_level", "latest_cycle", "recommended_action")


@checks.add("predictions_shown", with_(O.BATCHED + ",\n" + _TOP, f"SELECT count(*) FILTER ({_PICK}) AS shown, count(*) AS total FROM top"))
def predictions_shown(spark, folder):
    return reports.shown_counts(scored_store(spark, folder).predictions(), "LOW", "50-3, 60, x, 1-2-3, -5")


@checks.add("active_alerts", with_(O.BATCHED, "SELECT id, run_id, source_file, engine_id, severity, message FROM alerts ORDER BY created_at DESC, id DESC LIMIT 25"))
def active_alerts(spark, folder):
    return reports.active_alerts(scored_store(spark, folder).alerts()).select("id", "run_id", *KEY, "severity", "message")


@checks.add("latest_alerts", with_(O.BATCHED, "SELECT id, source_file, engine_id, severity, message FROM alerts ORDER BY id DESC LIMIT 10"))
def latest_alerts(spark, folder):
    return reports.latest_alerts(scored_store(spark, folder).alerts()).select("id", *KEY, "severity", "message")


@checks.add("latest_raw", with_(O.TELEMETRY, f"SELECT {IDS}, strftime(inserted_at, '%Y-%m-%d %H:%M:%S.%f') AS inserted_at FROM telemetry ORDER BY raw_id DESC LIMIT 10"))
def latest_raw(spark, folder):
    return reports.latest_raw(scored_store(spark, folder).raw()).select(*ID, "inserted_at")


@checks.add("stale_alerts", with_(O.BATCHED, """SELECT id, source_file, engine_id FROM alerts WHERE (source_file, engine_id) IN (
  SELECT (source_file, engine_id) FROM (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY source_file, engine_id ORDER BY prediction_time DESC, id DESC) = 1) WHERE risk_score < 70)"""))
def stale_alerts(spark, folder):
    store = scored_store(spark, folder)
    return quality.stale_alerts(store.alerts(), store.predictions()).select("id", *KEY)


# -- totals kept by the changes of each run ---------------------------------------------------

@checks.add("kept_counts", _COUNTS)
def kept_counts(spark, folder):
    return totals.headline_counts(scored_store(spark, folder))


@checks.add("kept_levels", _LEVELS)
def kept_levels(spark, folder):
    return totals.risk_distribution(scored_store(spark, folder))


@checks.add("kept_status", _STATUS)
def kept_status(spark, folder):
    return totals.engine_status(scored_store(spark, folder))


@checks.add("kept_counts_rescored", with_(_ALERTS_AGAIN, """SELECT 'raw_rows' AS metric, CAST(0 AS BIGINT) AS rows UNION ALL SELECT 'processed_rows', 0
UNION ALL SELECT 'prediction_rows', count(*) FROM twice UNION ALL SELECT 'active_alerts', count(*) FROM merged WHERE NOT is_resolved"""))
def kept_counts_rescored(spark, folder):
    return totals.headline_counts(_rescored(spark, folder))


@checks.add("kept_levels_rescored", with_(_RESCORED + """,
newest AS (SELECT CASE WHEN again THEN second_score ELSE first_score END AS score FROM twice
  QUALIFY row_number() OVER (PARTITION BY engine_id ORDER BY again DESC, raw_id DESC) = 1),
levels AS (SELECT CASE WHEN score >= 0.8 THEN 'HIGH' WHEN score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM newest)""", """
SELECT l.level AS risk_level, count(n.risk_level) AS engines, round_even(count(n.risk_level) / (SELECT count(*) FROM levels) * 1000, 0) / 10 AS share
FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('LOW')) l(level) LEFT JOIN levels n ON n.risk_level = l.level GROUP BY ALL"""))
def kept_levels_rescored(spark, folder):
    return totals.risk_distribution(_rescored(spark, folder))


# -- audit ------------------------------------------------------------------------------------

@checks.add("constraint_audit", with_(O.TELEMETRY + """,
flawed AS (SELECT raw_id, CASE WHEN (raw_id - 1) % 41 != 0 THEN source_file END AS source_file, CASE WHEN (raw_id - 1) % 37 != 0 THEN engine_id END AS engine_id, time_in_cycles FROM telemetry
  UNION ALL SELECT raw_id, source_file, engine_id, time_in_cycles FROM telemetry WHERE (raw_id - 1) % 10 = 0),
child AS (SELECT raw_id * 2 AS raw_id FROM telemetry)""", """
SELECT 'raw' AS table_name, 'not_null source_file' AS rule, count(*) FILTER (source_file IS NULL) AS violations FROM flawed
UNION ALL SELECT 'raw', 'not_null engine_id', count(*) FILTER (engine_id IS NULL) FROM flawed
UNION ALL SELECT 'raw', 'unique raw_id', count(*) FROM (SELECT raw_id FROM flawed GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'raw', 'unique source_file,engine_id,time_in_cycles', count(*) FROM (SELECT source_file, engine_id, time_in_cycles FROM flawed GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'child', 'reference raw_id', count(*) FROM child WHERE raw_id NOT IN (SELECT raw_id FROM telemetry)
UNION ALL SELECT 'events', 'time_format clock', count(*) FILTER (NOT regexp_matches(strftime(ts, '%-H:%M'), '^([01][0-9]|2[0-3]):[0-5][0-9]')) FROM events"""))
def constraint_audit(spark, folder):
    rows = telemetry(spark, folder).select(*ID)
    event = F.col("raw_id") - 1
    flawed = rows.select("raw_id", F.when(event % 41 != 0, F.col("source_file")).alias("source_file"),
                         F.when(event % 37 != 0, F.col("engine_id")).alias("engine_id"), "time_in_cycles")
    flawed = flawed.unionByName(rows.filter(event % 10 == 0))
    child = rows.select((F.col("raw_id") * 2).alias("raw_id"))
    clocks = spark.read.parquet(f"{folder}/events.parquet").select(F.date_format("ts", "H:mm").alias("clock"))
    return quality.audit([
        quality.not_null(flawed, "raw", ["source_file", "engine_id"]), quality.unique(flawed, "raw", ["raw_id"]),
        quality.unique(flawed, "raw", NATURAL_KEY), quality.references(child, "child", "raw_id", rows, "raw_id"),
        quality.time_format(clocks, "events", "clock")])


@checks.add("store_audit")
def store_audit(spark, folder):
    return quality.audit_store(scored_store(spark, folder))


# -- late readings ----------------------------------------------------------------------------

@_once
def _late_store(spark, folder) -> Store:
    """Four of five readings arrive first, then the others late and every reading once more."""
    store, rows = new_store(spark, "late"), arrivals(spark, folder)
    on_time = F.col("arrival_seq") % 5 != 0
    store.ingest(rows.filter(on_time), "on-time", now=T1)
    store.ingest(rows.filter(~on_time), "late", now=T1)
    store.ingest(rows, "again", now=T2)
    return store


_LATE = O.TELEMETRY + """,
arrived AS (SELECT *, (raw_id - 1) % 5 = 0 AS late FROM telemetry),
stored AS (SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY source_file, engine_id, time_in_cycles ORDER BY late, raw_id) = 1)"""


@checks.add("late_inserts", with_(_LATE, "SELECT row_number() OVER (ORDER BY late, s.raw_id) AS raw_id, source_file, engine_id, time_in_cycles FROM stored s"))
def late_inserts(spark, folder):
    return _late_store(spark, folder).raw().select(*ID)


@checks.add("late_counters", with_(_LATE, """SELECT 'on-time' AS ingest_id, count(*) FILTER (NOT late) AS consumed, (SELECT count(*) FROM stored WHERE NOT late) AS inserted FROM arrived
UNION ALL SELECT 'late', count(*) FILTER (late), (SELECT count(*) FROM stored WHERE late) FROM arrived UNION ALL SELECT 'again', count(*), 0 FROM arrived"""))
def late_counters(spark, folder):
    return _late_store(spark, folder).ingests().select("ingest_id", "consumed", "inserted")
