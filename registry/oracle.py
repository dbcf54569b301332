"""SQL text shared by the checks, written for DuckDB over the given tables."""

from __future__ import annotations

# Fixed values, written out here so that a wrong text or list in the engine shows.
SCORE_ACTIONS = {
    "CRITICAL": "Stop machine and inspect before operation.",
    "HIGH": "Schedule urgent inspection during the nearest safe stop.",
    "MEDIUM": "Monitor during the next prediction window.",
    "LOW": "Continue normal operation.",
}
PROBABILITY_ACTIONS = {
    "HIGH": "Schedule urgent inspection during the nearest safe stop.",
    "MEDIUM": "Monitor this engine closely in the next prediction run.",
    "LOW": "Continue normal operation.",
}
SENSORS = [f"s{i}" for i in range(1, 22)]
READINGS = ["op_setting_1", "op_setting_2", "op_setting_3"] + SENSORS
FLAT_SENSORS = ["s1", "s5", "s6", "s10", "s16", "s18", "s19"]
TRACKED_SENSORS = ["s2", "s3", "s4", "s7", "s11", "s12", "s15", "s20", "s21"]
KEPT = [c for c in READINGS if c not in FLAT_SENSORS]
NUMBER = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def r6(expression: str) -> str:
    return f"round_even(({expression}) * 1e6, 0) / 1e6"


def cases(column: str, texts: dict[str, str]) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items()) + " END"


def _sensors() -> str:
    return ", ".join(
        f"CASE WHEN event_id % 17 != {i % 17} THEN CAST(value AS DOUBLE) * {i} / 10 + ((event_id * {i + 3}) % 97) END AS s{i}"
        for i in range(1, len(SENSORS) + 1))


TELEMETRY = f"""telemetry AS (
  SELECT event_id + 1 AS raw_id, event_type AS source_file, CAST(user_id AS INTEGER) AS engine_id,
         CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS INTEGER) AS time_in_cycles,
         {', '.join(f'CAST((event_id * {j}) % 10 AS DOUBLE) / 10 AS op_setting_{j}' for j in (1, 2, 3))},
         {_sensors()}, ts AS inserted_at
  FROM events)"""

CLEAN = TELEMETRY + f""",
clean AS (
  SELECT raw_id, source_file, engine_id, time_in_cycles, {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in READINGS)}, inserted_at
  FROM telemetry)"""


def features(source: str = "clean", name: str = "features", rul_over: str = "source_file, engine_id") -> str:
    """Feature table of a clean frame; ``rul_over`` is the group whose newest cycle counts."""
    parts = []
    for s in TRACKED_SENSORS:
        parts += [f"avg({s}) OVER last5 AS rolling_avg_{s}",
                  f"coalesce(stddev_samp({s}) OVER last5, 0.0) AS rolling_std_{s}",
                  f"coalesce({s} - lag({s}) OVER history, 0.0) AS delta_{s}"]
    return f"""{name} AS (
  SELECT *, {', '.join(parts)},
         max(time_in_cycles) OVER (PARTITION BY {rul_over}) - time_in_cycles AS demo_rul
  FROM {source}
  WINDOW history AS (PARTITION BY source_file, engine_id ORDER BY time_in_cycles, raw_id),
         last5 AS (PARTITION BY source_file, engine_id ORDER BY time_in_cycles, raw_id
                   ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""


FEATURES = CLEAN + ",\n" + features()

SIGNAL = ("(" + " + ".join(f"abs(delta_{s})" for s in TRACKED_SENSORS) + ") / 9.0 * 2.0 + ("
          + " + ".join(f"abs(rolling_std_{s})" for s in TRACKED_SENSORS) + ") / 9.0")

LEVEL = ("CASE WHEN risk_score >= 90 THEN 'CRITICAL' WHEN risk_score >= 70 THEN 'HIGH' "
         "WHEN risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END")


def scores(source: str = "features", batch: str | None = None) -> str:
    """Latest row per key (and batch) with its rule score."""
    group = f"source_file, engine_id{', ' + batch if batch else ''}"
    over = f"PARTITION BY {batch}" if batch else ""
    columns = f"raw_id, source_file, engine_id, time_in_cycles{', ' + batch if batch else ''}"
    return f"""latest AS (
  SELECT {columns}, {SIGNAL} AS signal FROM {source}
  QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY time_in_cycles DESC, raw_id DESC) = 1),
rated AS (
  SELECT {columns}, CASE WHEN max(signal) OVER ({over}) = 0 THEN 0.0 ELSE
    round_even(least(greatest(signal / max(signal) OVER ({over}) * 100.0, 0.0), 100.0) * 100.0, 0) / 100.0 END AS risk_score
  FROM latest),
scored AS (
  SELECT *, round_even(greatest(100.0 - risk_score, 0.0) * 100.0, 0) / 100.0 AS predicted_rul, {LEVEL} AS risk_level,
         {cases(LEVEL, SCORE_ACTIONS)} AS recommended_action
  FROM rated)"""


SCORES = FEATURES + ",\n" + scores()

RULE_MESSAGE = ("risk_level || ' risk for engine ' || engine_id || ' at cycle ' || time_in_cycles || ': score=' || "
                "CAST(risk_score AS VARCHAR)")

# Three batches of 40 %, 30 % and 30 % of the rows, each scored after its arrival.
BATCHED = CLEAN + """,
total AS (SELECT count(*) AS n FROM events),
batched AS (
  SELECT clean.*, CASE WHEN raw_id <= n * 4 // 10 THEN 1 WHEN raw_id <= n * 7 // 10 THEN 2 ELSE 3 END AS run_id
  FROM clean, total),
""" + features("batched", "features", "source_file, engine_id, run_id") + ",\n" + scores("features", "run_id") + """,
batch_facts AS (
  SELECT run_id, min(raw_id) AS low, max(raw_id) AS high, count(*) AS n, max(inserted_at) AS last_at FROM batched GROUP BY run_id),
predictions AS (
  SELECT s.raw_id AS id, s.*, b.last_at AS prediction_time FROM scored s JOIN batch_facts b USING (run_id)),
alert_base AS (
  SELECT s.run_id, max(s.raw_id) - any_value(b.low) + 1 AS span, any_value(b.low) AS low
  FROM scored s JOIN batch_facts b USING (run_id) WHERE s.risk_score >= 70 GROUP BY s.run_id),
alerts AS (
  SELECT CAST(p.raw_id - a.low + 1 + coalesce((SELECT sum(span) FROM alert_base e WHERE e.run_id < a.run_id), 0) AS BIGINT) AS id,
         p.raw_id, p.run_id, p.source_file, p.engine_id, p.risk_level AS severity, p.prediction_time AS created_at,
         """ + RULE_MESSAGE + """ AS message
  FROM predictions p JOIN alert_base a USING (run_id) WHERE p.risk_score >= 70)"""

# The event value scaled to 0..1 by its maximum stands in for a model probability.
PROBABILITY = TELEMETRY + f""",
top AS (SELECT max(value) AS v FROM events),
chances AS (
  SELECT t.raw_id, t.source_file, t.engine_id, t.time_in_cycles, round_even(e.value / top.v * 1e6, 0) / 1e6 AS risk_score
  FROM telemetry t JOIN events e ON t.raw_id = e.event_id + 1, top),
rated AS (
  SELECT *, CASE WHEN risk_score >= 0.8 THEN 'HIGH' WHEN risk_score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM chances)"""

PROBABILITY_ACTION = cases("risk_level", PROBABILITY_ACTIONS)

# JSON messages made from events; the case number decides what is wrong with a message.
MESSAGES = """messages AS (
  SELECT event_id AS arrival_seq, event_id, event_type, user_id, value, event_id % 23 AS kind,
    CASE event_id % 23
      WHEN 0 THEN 'not json ' || event_id
      WHEN 1 THEN '[' || event_id || ']'
      WHEN 2 THEN '{"source_file":"' || event_type || '","time_in_cycles":' || event_id || '}'
      WHEN 3 THEN '{"engine_id":"x","time_in_cycles":' || event_id || '}'
      WHEN 4 THEN '{"source_file":"' || event_type || '","engine_id":' || user_id || ',"time_in_cycles":' || event_id || '.7}'
      WHEN 5 THEN '{"source_file":"","source":"B","engine_id":' || user_id || ',"time_in_cycles":' || event_id || '}'
      WHEN 6 THEN '{"engine_id":"' || user_id || '","time_in_cycles":' || event_id || '}'
      WHEN 7 THEN '{"engine_id":null,"time_in_cycles":' || event_id || '}'
      WHEN 8 THEN '{"engine_id":' || user_id || ',"time_in_cycles":' || event_id || ',"s2":"abc"}'
      ELSE '{"source_file":"' || event_type || '","engine_id":' || user_id || ',"time_in_cycles":' || event_id
           || ',"s2":' || event_id || '.25}' END AS body
  FROM events)"""

PARSED = MESSAGES + f""",
docs AS (SELECT arrival_seq, body, CASE WHEN json_valid(body) THEN body::JSON END AS doc FROM messages),
fields AS (
  SELECT arrival_seq, doc, json_type(doc) AS doc_type,
    json_extract_string(doc, '$.engine_id') AS engine_text, json_type(doc, '$.engine_id') AS engine_type,
    json_extract_string(doc, '$.time_in_cycles') AS cycle_text, json_type(doc, '$.time_in_cycles') AS cycle_type,
    coalesce(nullif(json_extract_string(doc, '$.source_file'), ''), nullif(json_extract_string(doc, '$.source'), ''), 'UNKNOWN') AS source_file,
    json_extract_string(doc, '$.s2') AS s2_text
  FROM docs),
typed AS (
  SELECT arrival_seq, doc, doc_type, source_file, s2_text,
    CASE WHEN engine_type = 'VARCHAR' THEN CASE WHEN regexp_full_match(trim(engine_text), '[+-]?[0-9]+') THEN try_cast(trim(engine_text) AS INTEGER) END
         ELSE CAST(trunc(try_cast(engine_text AS DOUBLE)) AS INTEGER) END AS engine_id,
    CASE WHEN cycle_type = 'VARCHAR' THEN CASE WHEN regexp_full_match(trim(cycle_text), '[+-]?[0-9]+') THEN try_cast(trim(cycle_text) AS INTEGER) END
         ELSE CAST(trunc(try_cast(cycle_text AS DOUBLE)) AS INTEGER) END AS time_in_cycles,
    CASE WHEN regexp_full_match(trim(s2_text), '{NUMBER}') THEN try_cast(trim(s2_text) AS DOUBLE) END AS s2
  FROM fields),
parsed AS (
  SELECT arrival_seq, source_file, engine_id, time_in_cycles, s2,
    CASE WHEN doc IS NULL THEN 'bad_json' WHEN doc_type <> 'OBJECT' THEN 'not_object' WHEN engine_id IS NULL THEN 'bad_engine'
         WHEN time_in_cycles IS NULL THEN 'bad_cycle' WHEN s2_text IS NOT NULL AND s2 IS NULL THEN 'bad_sensor' END AS reject_reason
  FROM typed)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
