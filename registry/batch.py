"""Checks of the batch operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from gearwatch.functions import display, levels
from gearwatch.functions.messages import accepted, encode_messages, parse_messages
from gearwatch.functions.numbers import clip
from gearwatch.operators import metrics
from gearwatch.operators.clean import clean_telemetry
from gearwatch.operators.features import latest_per_key
from gearwatch.operators.merge import insert_absent, insert_counts, upsert
from gearwatch.operators.profile import column_profile
from gearwatch.operators.scoring import apply_probability, probability_alerts, score_alerts, score_latest, score_risk
from gearwatch.operators.selection import row_slice
from gearwatch.plans.reports import latest_raw, rows_per_source
from gearwatch.plans.rule_run import batch_facts, context_rows, late_rows, new_rows
from gearwatch.schema import DEFAULT_TIMES, NATURAL_KEY, READINGS, TRACKED_SENSORS
from gearwatch.sources.files import export_csv, read_csv, read_text_telemetry, union_exports, write_text_telemetry
from gearwatch.sources.fixtures import batch_bounds, dirty_text, messages, redelivered, telemetry
from gearwatch.session import scratch_folder
from registry import oracle as O
from registry.common import Checks, clean, features
from registry.oracle import r6, with_

checks = Checks()
ID = ["raw_id", *NATURAL_KEY]
IDS = ", ".join(ID)
READ = ", ".join(READINGS)


def _r6(columns: list[str]) -> str:
    return ", ".join(f"{r6(c)} + 0.0 AS {c}" for c in columns)


# -- flagship, cleaning, features -------------------------------------------------------------

@checks.add("flagship_risk", with_(O.SCORES, f"SELECT {IDS}, risk_score, predicted_rul, risk_level, recommended_action FROM scored"))
def flagship_risk(spark, folder):
    return score_latest(clean(spark, folder))


@checks.add("clean_telemetry", with_(O.CLEAN, f"SELECT {IDS}, {_r6(READINGS)} FROM clean"))
def clean_with_duplicates(spark, folder):
    return clean_telemetry(redelivered(telemetry(spark, folder))).select(*ID, *READINGS)


_NUMBER = f"CASE WHEN regexp_full_match(trim(%s), '{O.NUMBER}') THEN try_cast(trim(%s) AS DOUBLE) END"


@checks.add("clean_dirty_text", with_(O.TELEMETRY + f""",
dirty AS (SELECT raw_id, CASE WHEN (raw_id - 1) % 41 != 0 THEN source_file END AS source_file,
  CASE WHEN (raw_id - 1) % 37 != 0 THEN CAST(engine_id AS VARCHAR) END AS engine_id, time_in_cycles || '.7' AS time_in_cycles,
  {', '.join(f"CASE WHEN (raw_id - 1) % 29 = 0 THEN 'abc' WHEN (raw_id - 1) % 31 = 0 THEN '5d' ELSE CAST({c} AS VARCHAR) END AS {c}" for c in READINGS)}
  FROM telemetry)""", f"""
SELECT raw_id, coalesce(source_file, 'UNKNOWN') AS source_file, CAST(engine_id AS INTEGER) AS engine_id,
  CAST(trunc(CAST(time_in_cycles AS DOUBLE)) AS INTEGER) AS time_in_cycles,
  {', '.join(f"{r6('coalesce(' + _NUMBER.replace('%s', c) + ', 0.0)')} + 0.0 AS {c}" for c in READINGS)}
FROM dirty WHERE engine_id IS NOT NULL"""))
def clean_dirty_text(spark, folder):
    return clean_telemetry(dirty_text(telemetry(spark, folder)), unique_ids=True).select(*ID, *READINGS)


for _kind, _name in (("rolling_avg", "rolling_mean"), ("rolling_std", "rolling_std"), ("delta", "delta")):
    _columns = [f"{_kind}_{s}" for s in TRACKED_SENSORS]

    def _windows(spark, folder, columns=tuple(_columns)):
        return features(spark, folder).select(*ID, *columns)

    checks.add(_name, with_(O.FEATURES, f"SELECT {IDS}, {_r6(_columns)} FROM features"))(_windows)


@checks.add("remaining_cycles", with_(O.FEATURES, f"SELECT {IDS}, demo_rul FROM features"))
def remaining_cycles(spark, folder):
    return features(spark, folder).select(*ID, "demo_rul")


_ALL = O.KEPT + [f"{k}_{s}" for s in TRACKED_SENSORS for k in ("rolling_avg", "rolling_std", "delta")]


@checks.add("feature_table", with_(O.FEATURES, f"SELECT {IDS}, {_r6(_ALL)}, demo_rul FROM features"))
def feature_table(spark, folder):
    return features(spark, folder).select(*ID, *_ALL, "demo_rul")


@checks.add("latest_per_key", with_(O.CLEAN, f"""SELECT {IDS}, {_r6(['s2', 's21'])} FROM clean
QUALIFY row_number() OVER (PARTITION BY source_file, engine_id ORDER BY time_in_cycles DESC, raw_id DESC) = 1"""))
def latest(spark, folder):
    return latest_per_key(clean(spark, folder).select(*ID, "s2", "s21"))


# -- scores and alerts ------------------------------------------------------------------------

@checks.add("score_levels", with_(O.SCORES, "SELECT risk_level, recommended_action, count(*) AS machines, min(risk_score) AS lowest, "
                                  "max(risk_score) AS highest FROM scored GROUP BY ALL"))
def score_levels(spark, folder):
    return score_latest(clean(spark, folder)).groupBy("risk_level", "recommended_action").agg(
        F.count(F.lit(1)).alias("machines"), F.min("risk_score").alias("lowest"), F.max("risk_score").alias("highest"))


@checks.add("score_fixed_reference", with_(O.FEATURES + ",\n" + O.scores().replace("max(signal) OVER ()", "80.0"),
                                           f"SELECT {IDS}, risk_score, predicted_rul, risk_level FROM scored"))
def score_fixed_reference(spark, folder):
    newest = latest_per_key(features(spark, folder))
    return score_risk(newest, reference_max=80.0, keep=ID).select(*ID, "risk_score", "predicted_rul", "risk_level")


@checks.add("score_alerts", with_(O.SCORES, f"SELECT raw_id, source_file, engine_id, risk_level AS severity, {O.RULE_MESSAGE} AS message "
                                  "FROM scored WHERE risk_score >= 70"))
def alerts_of_scores(spark, folder):
    return score_alerts(score_latest(clean(spark, folder)))


def _chances(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select((F.col("event_id") + 1).alias("raw_id"), "value")
    top = events.agg(F.max("value").alias("v")).scalar()
    rows = telemetry(spark, folder).select(*ID).join(events, "raw_id")
    return apply_probability(rows, clip(F.col("value") / top, 0.0, 1.0)).drop("value")


@checks.add("proba_levels", with_(O.PROBABILITY, f"SELECT {IDS}, {r6('risk_score')} + 0.0 AS risk_score, CAST(NULL AS DOUBLE) AS predicted_rul, "
                                  f"risk_level, {O.PROBABILITY_ACTION} AS recommended_action FROM rated"))
def proba_levels(spark, folder):
    return _chances(spark, folder)


@checks.add("proba_alerts", with_(O.PROBABILITY, "SELECT raw_id, source_file, engine_id, risk_level AS severity, "
                                  "'HIGH failure probability for engine ' || engine_id || ' at cycle ' || time_in_cycles || "
                                  "': probability=' || format('{:.4f}', risk_score) AS message FROM rated WHERE risk_level = 'HIGH'"))
def proba_alerts(spark, folder):
    return probability_alerts(_chances(spark, folder))


# -- incremental parts ------------------------------------------------------------------------

@checks.add("incremental_new_rows", with_(O.TELEMETRY, """SELECT count(*) AS rows, min(raw_id) AS from_raw_id, max(raw_id) AS to_raw_id,
strftime(max(inserted_at), '%Y-%m-%d %H:%M:%S.%f') AS last_inserted_at FROM telemetry WHERE raw_id > (SELECT count(*) * 4 // 10 FROM events)"""))
def incremental_new_rows(spark, folder):
    return batch_facts(new_rows(telemetry(spark, folder), batch_bounds(spark, folder)[0]))


@checks.add("context_rows", with_(O.TELEMETRY, f"""SELECT {IDS} FROM telemetry
WHERE raw_id <= (SELECT count(*) * 7 // 10 FROM events) AND (source_file, engine_id) IN
  (SELECT (source_file, engine_id) FROM telemetry WHERE raw_id > (SELECT count(*) * 7 // 10 FROM events))
QUALIFY row_number() OVER (PARTITION BY source_file, engine_id ORDER BY time_in_cycles DESC, raw_id DESC) <= 4"""))
def context(spark, folder):
    rows, bound = telemetry(spark, folder).select(*ID), batch_bounds(spark, folder)[1]
    return context_rows(rows, new_rows(rows, bound), bound, 4)


_LATE = """swapped AS (SELECT raw_id, source_file, engine_id, CASE WHEN engine_id % 7 = 0 AND newest - time_in_cycles <= 1
  THEN 2 * newest - 1 - time_in_cycles ELSE time_in_cycles END AS time_in_cycles
  FROM (SELECT *, max(time_in_cycles) OVER (PARTITION BY source_file, engine_id) AS newest FROM telemetry) WHERE newest > 1)"""


@checks.add("late_cycle_batch", with_(O.TELEMETRY + ",\n" + _LATE, f"""SELECT {IDS} FROM swapped s
WHERE raw_id > (SELECT count(*) * 7 // 10 FROM events) AND time_in_cycles < (SELECT max(o.time_in_cycles) FROM swapped o
  WHERE o.source_file = s.source_file AND o.engine_id = s.engine_id AND o.raw_id <= (SELECT count(*) * 7 // 10 FROM events))"""))
def late_cycle_batch(spark, folder):
    rows, bound = telemetry(spark, folder).select(*ID), batch_bounds(spark, folder)[1]
    newest = rows.groupBy("source_file", "engine_id").agg(F.max("time_in_cycles").alias("newest")).filter("newest > 1")
    swapped = rows.join(newest, ["source_file", "engine_id"]).selectExpr(
        "raw_id", "source_file", "engine_id", "CASE WHEN engine_id % 7 = 0 AND newest - time_in_cycles <= 1 "
        "THEN 2 * newest - 1 - time_in_cycles ELSE time_in_cycles END AS time_in_cycles")
    batch = new_rows(swapped, bound)
    return late_rows(context_rows(swapped, batch, bound, 50), batch).select(*ID)


# -- messages ---------------------------------------------------------------------------------

_PARSED = "arrival_seq, source_file, engine_id, time_in_cycles, s2, reject_reason"


@checks.add("parse_messages", with_(O.PARSED, f"SELECT {_PARSED} FROM parsed"))
def parsed_messages(spark, folder):
    return parse_messages(messages(spark, folder)).selectExpr(*_PARSED.split(", "))


@checks.add("route_rejects", with_(O.PARSED, "SELECT coalesce(reject_reason, 'ok') AS outcome, count(*) AS messages FROM parsed GROUP BY ALL"))
def route_rejects(spark, folder):
    parsed = parse_messages(messages(spark, folder))
    return parsed.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("messages"))


_WIRE = "source_file || ':' || engine_id || ':' || time_in_cycles AS key, source_file, engine_id, time_in_cycles"


@checks.add("message_encode", with_(O.TELEMETRY, f"SELECT {_WIRE}, {_r6(READINGS)} FROM telemetry"))
def message_encode(spark, folder):
    wire = encode_messages(telemetry(spark, folder)).select("key", F.col("value").alias("body"))
    return accepted(parse_messages(wire)).select("key", *NATURAL_KEY, *READINGS)


@checks.add("machine_feed", with_(O.PARSED, f"SELECT {_WIRE.replace('source_file', 'feed')}, s2 FROM (SELECT *, "
                                  "CASE WHEN source_file = 'UNKNOWN' THEN 'MQTT' ELSE source_file END AS feed FROM parsed) "
                                  "WHERE reject_reason IS NULL").replace("feed, engine_id", "feed AS source_file, engine_id"))
def machine_feed(spark, folder):
    from gearwatch.streaming.ingest import machine_feed as normalise
    wire = normalise(messages(spark, folder)).select("key", F.col("value").alias("body"))
    return accepted(parse_messages(wire)).select("key", *NATURAL_KEY, "s2")


# -- inserts and upserts ----------------------------------------------------------------------

def _insert_parts(spark, folder):
    rows = telemetry(spark, folder).select(*ID, "s2").withColumn("arrival_seq", F.col("raw_id"))
    bound = batch_bounds(spark, folder)[0]
    again = rows.filter((F.col("raw_id") - 1) % 10 == 0).selectExpr(
        "raw_id + 1000000000 AS raw_id", *NATURAL_KEY, "s2", "raw_id + 1000000000 AS arrival_seq")
    return rows.filter(F.col("raw_id") <= bound), rows.filter(F.col("raw_id") > bound).unionByName(again)


_INSERT = O.TELEMETRY + """,
target AS (SELECT * FROM telemetry WHERE raw_id <= (SELECT count(*) * 4 // 10 FROM events)),
batch AS (SELECT raw_id, source_file, engine_id, time_in_cycles FROM telemetry WHERE raw_id > (SELECT count(*) * 4 // 10 FROM events)
  UNION ALL SELECT raw_id + 1000000000, source_file, engine_id, time_in_cycles FROM telemetry WHERE (raw_id - 1) % 10 = 0),
inserted AS (SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.source_file = b.source_file
  AND t.engine_id = b.engine_id AND t.time_in_cycles = b.time_in_cycles)
  QUALIFY row_number() OVER (PARTITION BY source_file, engine_id, time_in_cycles ORDER BY raw_id) = 1)"""


@checks.add("raw_insert_absent", with_(_INSERT, f"SELECT {IDS} FROM inserted"))
def raw_insert_absent(spark, folder):
    target, batch = _insert_parts(spark, folder)
    return insert_absent(target, batch, NATURAL_KEY, [F.col("arrival_seq")]).select(*ID)


@checks.add("insert_counters", with_(_INSERT, "SELECT (SELECT count(*) FROM batch) AS consumed, (SELECT count(*) FROM inserted) AS inserted, "
                                     "(SELECT count(*) FROM batch) - (SELECT count(*) FROM inserted) AS duplicates"))
def insert_counters(spark, folder):
    target, batch = _insert_parts(spark, folder)
    return insert_counts(target, batch, NATURAL_KEY, [F.col("arrival_seq")])


@checks.add("upsert_rows", with_(O.TELEMETRY, f"""SELECT {IDS}, {r6("CASE WHEN raw_id > (SELECT count(*) * 4 // 10 FROM events) THEN coalesce(s2, 0.0) + 1 ELSE coalesce(s2, 0.0) END")} + 0.0 AS s2,
CASE WHEN raw_id <= (SELECT count(*) * 7 // 10 FROM events) THEN 1 ELSE 2 END AS first_version FROM telemetry"""))
def upsert_rows(spark, folder):
    low, high, _ = batch_bounds(spark, folder)
    rows = telemetry(spark, folder).select(*ID, F.coalesce("s2", F.lit(0.0)).alias("s2"))
    target = rows.filter(F.col("raw_id") <= high).withColumn("first_version", F.lit(1))
    updates = (rows.filter(F.col("raw_id") > low).withColumn("s2", F.col("s2") + 1).withColumn("first_version", F.lit(2)))
    return upsert(target, updates, ["raw_id"], ["first_version"])


# -- sources, sinks, slices -------------------------------------------------------------------

@checks.add("text_source", with_(O.TELEMETRY, f"SELECT source_file, engine_id, time_in_cycles, {_r6(READINGS)} FROM telemetry"))
def text_source(spark, folder):
    path = scratch_folder(spark, "text")
    write_text_telemetry(telemetry(spark, folder), path)
    lines = read_text_telemetry(spark, f"{path}/*")
    name = F.regexp_extract(F.input_file_name(), r"source_file=([^/]+)/", 1)
    return lines.withColumn("source_file", name)


@checks.add("export_rows", with_(O.FEATURES, f"SELECT {IDS}, {_r6(['s2', 'rolling_avg_s2'])}, demo_rul FROM features"))
def export_rows(spark, folder):
    path = scratch_folder(spark, "export")
    rows = features(spark, folder).select(*ID, "s2", "rolling_avg_s2", "demo_rul")
    export_csv(rows, path, "raw_id")
    return read_csv(spark, path, rows.schema)


@checks.add("multi_source_union", with_(O.FEATURES, f"SELECT {IDS}, {_r6(['s2', 'delta_s2'])}, demo_rul FROM features"))
def multi_source_union(spark, folder):
    rows = features(spark, folder).select(*ID, "s2", "delta_s2", "demo_rul")
    paths = []
    for split in (F.col("engine_id") % 2 == 0, F.col("engine_id") % 2 != 0):
        paths.append(scratch_folder(spark, "export"))
        export_csv(rows.filter(split), paths[-1], None)
    return union_exports([read_csv(spark, path, rows.schema) for path in paths])


@checks.add("replay_slice", with_(O.TELEMETRY, f"SELECT {IDS} FROM telemetry ORDER BY raw_id LIMIT 500 OFFSET 200"))
def replay_slice(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select((F.col("event_id") + 1).alias("raw_id"))
    wanted = row_slice(events, "raw_id", 201, 500).agg(F.min("raw_id"), F.max("raw_id")).first()
    return telemetry(spark, folder).select(*ID).filter(F.col("raw_id").between(*wanted))


@checks.add("feed_latest", with_(O.TELEMETRY, "SELECT raw_id, source_file, engine_id, time_in_cycles FROM telemetry WHERE source_file = 'click' "
                                 "ORDER BY raw_id DESC LIMIT 5"))
def feed_latest(spark, folder):
    return latest_raw(telemetry(spark, folder).select(*ID), 5, "click")


@checks.add("rows_per_source", with_(O.TELEMETRY, "SELECT source_file, count(*) AS rows FROM telemetry GROUP BY ALL"))
def source_counts(spark, folder):
    return rows_per_source(telemetry(spark, folder))


# -- training helpers, profiles, metrics ------------------------------------------------------

@checks.add("label_counts", with_(O.FEATURES, "SELECT CAST(demo_rul <= 15 AS INTEGER) AS label, count(*) AS rows FROM features GROUP BY ALL"))
def label_counts(spark, folder):
    return metrics.label_counts(features(spark, folder), levels.failure_label(F.col("demo_rul")))


def _guesses(spark, folder):
    return features(spark, folder).select((F.col("demo_rul") <= 2).cast("int").alias("label"), (F.col("s2") >= 60).cast("int").alias("prediction"))


_GUESS = O.FEATURES + ",\nguesses AS (SELECT CAST(demo_rul <= 2 AS INTEGER) AS label, CAST(s2 >= 60 AS INTEGER) AS prediction FROM features)"


@checks.add("binary_metrics", with_(_GUESS, f"""SELECT {r6('count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (prediction = 1)')} AS precision,
{r6('count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1)')} AS recall, {r6('count(*) FILTER (label = prediction) / count(*)')} AS accuracy FROM guesses"""))
def binary_metrics(spark, folder):
    return metrics.binary_metrics(_guesses(spark, folder))


@checks.add("class_report", with_(_GUESS + """,
classes AS (SELECT c.class, (SELECT count(*) FROM guesses WHERE label = c.class) AS support, (SELECT count(*) FROM guesses WHERE prediction = c.class) AS guessed,
  (SELECT count(*) FROM guesses WHERE label = c.class AND prediction = c.class) AS hit FROM (SELECT DISTINCT label AS class FROM guesses) c),
rates AS (SELECT *, hit / guessed AS precision, hit / support AS recall, 2 * (hit / guessed) * (hit / support) / (hit / guessed + hit / support) AS f1 FROM classes)""", f"""
SELECT CAST(class AS VARCHAR) AS class, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1, support FROM rates
UNION ALL SELECT 'accuracy', {r6('sum(hit) / sum(support)')}, {r6('sum(hit) / sum(support)')}, {r6('sum(hit) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM rates
UNION ALL SELECT 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM rates
UNION ALL SELECT 'weighted avg', {r6('sum(precision * support) / sum(support)')}, {r6('sum(recall * support) / sum(support)')}, {r6('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM rates"""))
def class_report(spark, folder):
    return metrics.class_report(_guesses(spark, folder))


_PROFILED = ["time_in_cycles", "op_setting_1", "s2", "s3", "s7", "s11", "s21"]


@checks.add("column_profile", with_(O.TELEMETRY, "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{'int' if c == 'time_in_cycles' else 'double'}' AS column_type, count({c}) AS non_null, {r6(f'avg({c})')} AS mean, "
    f"{r6(f'stddev_samp({c})')} AS std, {r6(f'min({c})')} AS min, {r6(f'quantile_cont({c}, 0.25)')} AS q25, {r6(f'quantile_cont({c}, 0.5)')} AS q50, "
    f"{r6(f'quantile_cont({c}, 0.75)')} AS q75, {r6(f'max({c})')} AS max FROM telemetry" for c in _PROFILED)))
def profile(spark, folder):
    return column_profile(telemetry(spark, folder), _PROFILED)


# -- schedule and display ---------------------------------------------------------------------

@checks.add("schedule_gate", "SELECT event_id, strftime(ts, '%H:%M') AS clock FROM events WHERE strftime(ts, '%H:%M') IN ('07:00', '12:00', '17:00')")
def schedule_gate(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.filter(display.is_scheduled(F.col("ts"), DEFAULT_TIMES)).select("event_id", display.clock_text(F.col("ts")).alias("clock"))


@checks.add("schedule_options", """WITH slots AS (SELECT CAST(i AS INTEGER) AS slot, TIMESTAMP '2000-01-01' + to_minutes(i * 30) AS start_at FROM range(48) r(i))
SELECT slot, strftime(start_at, '%H:%M') AS value_24h, strftime(start_at, '%I:%M %p') AS display_12h, count(event_id) AS events
FROM slots LEFT JOIN events ON slot = hour(ts) * 2 + minute(ts) // 30 GROUP BY ALL""")
def schedule_options(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    per_slot = events.groupBy((F.hour("ts") * 2 + F.floor(F.minute("ts") / 30)).cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("events"))
    return display.half_hour_slots(spark).join(per_slot, "slot", "left").withColumn("events", F.coalesce("events", F.lit(0)))


@checks.add("probability_display", "SELECT event_id, CASE WHEN event_id % 13 = 0 THEN '-' WHEN value / 40 <= 1 THEN format('{:.2f}%', value / 40 * 100) "
            "ELSE format('{:.2f}', value / 40) END AS shown FROM events")
def probability_display(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    value = F.when(F.col("event_id") % 13 != 0, F.col("value") / 40)
    return events.select("event_id", display.probability_text(value).alias("shown"))


@checks.add("display_fields", with_(O.SCORES, """SELECT raw_id, upper(risk_level[1]) || lower(risk_level[2:]) AS level_title, format('{:.2f}', risk_score) AS score_text,
format('{:,}', raw_id) AS id_text, 'predictions_' || strftime(inserted_at, '%Y%m%d_%H%M%S') || '.csv' AS file_name
FROM scored JOIN (SELECT raw_id, inserted_at FROM telemetry) USING (raw_id)"""))
def display_fields(spark, folder):
    times = spark.read.parquet(f"{folder}/events.parquet").select((F.col("event_id") + 1).alias("raw_id"), "ts")
    return score_latest(clean(spark, folder)).join(times, "raw_id").select(
        "raw_id", display.level_title(F.col("risk_level")).alias("level_title"), display.two_decimals(F.col("risk_score")).alias("score_text"),
        display.thousands(F.col("raw_id")).alias("id_text"), display.export_name(F.col("ts")).alias("file_name"))
