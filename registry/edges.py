"""Checks at the borders: colliding numbers, odd texts, extreme values, short windows, limits that bind."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gearwatch.operators import ml
from gearwatch.operators.profile import column_profile
from gearwatch.operators.scoring import score_latest
from gearwatch.plans import reports
from gearwatch.plans.model_run import latest_inputs
from gearwatch.plans.rule_run import recompute_keys, run_rule_scoring
from gearwatch.plans.store import Store
from gearwatch.schema import NATURAL_KEY, TEXT_COLUMNS
from gearwatch.session import scratch_folder
from gearwatch.sources.files import dataset_path, export_csv, read_csv, read_text_telemetry
from gearwatch.sources.fixtures import telemetry
from gearwatch.operators.quality import audit_store
from registry import oracle as O
from registry.common import Checks, arrivals, clean, features, new_store, scored_store
from registry.oracle import r6, with_

checks = Checks()
T1, T2 = dt.datetime(2024, 3, 1, 7, 0), dt.datetime(2024, 3, 1, 12, 0)


# -- ids and files ----------------------------------------------------------------------------

@checks.add("ingest_ids_unique", """SELECT CAST(part AS VARCHAR) AS ingest_id, count(*) AS readings, count(*) AS ids,
min(place) AS first_id, max(place) AS last_id, CAST(0 AS BIGINT) AS out_of_order
FROM (SELECT event_id % 2 AS part, row_number() OVER (ORDER BY event_id % 2, event_id) AS place FROM events) GROUP BY part""")
def ingest_ids_unique(spark, folder):
    """Five partitions that count by themselves, so every number comes up to five times."""
    store, rows = new_store(spark, "colliding"), arrivals(spark, folder)
    numbered = (rows.withColumn("arrival_part", (F.col("arrival_seq") % 10).cast("string"))
                .withColumn("arrival_seq", F.expr("arrival_seq div 10")))
    for part in (0, 1):
        store.ingest(numbered.filter(F.col("arrival_part").cast("int") % 2 == part), str(part), now=T1)
    order = numbered.select(*NATURAL_KEY, F.col("arrival_seq").alias("_seq"))
    raw = store.raw().join(order, NATURAL_KEY)
    log = store.ingests().select("ingest_id", "from_raw_id", "to_raw_id")
    owned = raw.join(F.broadcast(log), F.col("raw_id").between(F.col("from_raw_id"), F.col("to_raw_id")))
    # Ids grow with the number: the largest id of a number is below the smallest of the next.
    spans = owned.groupBy("ingest_id", "_seq").agg(F.count("*").alias("n"), F.countDistinct("raw_id").alias("ids"), F.min("raw_id").alias("low"), F.max("raw_id").alias("high"))
    later = spans.select("ingest_id", (F.col("_seq") - 1).alias("_seq"), F.col("low").alias("next_low"))
    return (spans.join(later, ["ingest_id", "_seq"], "left").groupBy("ingest_id")
            .agg(F.sum("n").alias("readings"), F.sum("ids").alias("ids"), F.min("low").alias("first_id"), F.max("high").alias("last_id"),
                 F.count_if(F.col("next_low") <= F.col("high")).alias("out_of_order")))


_TEXT = {
    "spark": r"""CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN concat('a,"b"', char(10), event_id) WHEN 3 THEN concat(char(13), char(10), event_type)
             WHEN 4 THEN r'\N' WHEN 5 THEN concat(r'\n', event_id) WHEN 6 THEN concat(' ', event_type, char(9)) WHEN 7 THEN '""' ELSE event_type END""",
    "duckdb": r"""CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'a,"b"' || chr(10) || event_id WHEN 3 THEN chr(13) || chr(10) || event_type
              WHEN 4 THEN '\N' WHEN 5 THEN '\n' || event_id WHEN 6 THEN ' ' || event_type || chr(9) WHEN 7 THEN '""' ELSE event_type END""",
}


@checks.add("export_text", f"SELECT event_id, hex({_TEXT['duckdb']}) AS text_hex, {_TEXT['duckdb']} IS NULL AS is_null FROM events")
def export_text(spark, folder):
    path = scratch_folder(spark, "texts")
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_id", f"{_TEXT['spark']} AS t")
    export_csv(rows, path, "event_id")
    return read_csv(spark, path, rows.schema).select("event_id", F.hex("t").alias("text_hex"), F.col("t").isNull().alias("is_null"))


@checks.add("file_sources", with_(O.TELEMETRY, f"""SELECT 'FD00' || (engine_id % 4 + 1) AS source_file, count(*) AS rows, sum(time_in_cycles) AS cycles,
{r6('sum(s2)')} AS s2, {r6('max(op_setting_3)')} AS op_setting_3 FROM telemetry GROUP BY ALL"""))
def file_sources(spark, folder):
    """Each data set as a text file in its default place, or in a place of its own, read back by name."""
    root, other = scratch_folder(spark, "datasets"), scratch_folder(spark, "elsewhere")
    rows, frames, own = telemetry(spark, folder), [], {"fd003": f"{other}/third.txt"}
    for number in range(4):
        path = dataset_path(f"fd00{number + 1}", own, None, root)
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in TEXT_COLUMNS]
        rows.filter(F.col("engine_id") % 4 == number).select(F.concat_ws(" ", *fields, F.lit(" ")).alias("value")).write.text(path)
        frames.append(read_text_telemetry(spark, path, f"FD00{number + 1}"))
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union.groupBy("source_file").agg(F.count("*").alias("rows"), F.sum("time_in_cycles").alias("cycles"), F.sum("s2").alias("s2"), F.max("op_setting_3").alias("op_setting_3"))


_PICKED = "risk_level = 'LOW' AND (engine_id BETWEEN 3 AND 50 OR engine_id = 60)"


@checks.add("export_filtered", with_(O.BATCHED, f"""SELECT id, source_file, engine_id, risk_score, recommended_action
FROM (SELECT * FROM predictions ORDER BY prediction_time DESC, id DESC LIMIT 200) WHERE {_PICKED}"""))
def export_filtered(spark, folder):
    """The filtered prediction table, exported in id order and read back."""
    path = scratch_folder(spark, "filtered")
    rows = reports.latest_predictions(scored_store(spark, folder).predictions(), "LOW", "3-50, 60")
    export_csv(rows, path, "id")
    return read_csv(spark, path, rows.schema).select("id", "source_file", "engine_id", "risk_score", "recommended_action")


@checks.add("export_order", """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM events""")
def export_order(spark, folder):
    """Processed rows are written in id order: no part file begins below the end of the one before it."""
    from gearwatch import jobs
    path = scratch_folder(spark, "ordered")
    rows = jobs.table(scored_store(spark, folder), "processed")
    export_csv(rows, path, "id")
    back = read_csv(spark, path, rows.schema).select("id", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).cast("int").alias("part"))
    ends = back.groupBy("part").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    pairs = ends.alias("a").join(ends.alias("b"), F.col("a.part") < F.col("b.part"), "left")
    wrong = pairs.filter("b.low <= a.high").agg(F.count("*").alias("n")).scalar()
    return ends.agg(F.sum("n").alias("rows")).withColumn("out_of_order", wrong)


# -- windows and profiles ---------------------------------------------------------------------

def _window_scores(window: int) -> str:
    return O.FEATURES.replace("ROWS BETWEEN 4 PRECEDING", f"ROWS BETWEEN {window - 1} PRECEDING") + ",\n" + O.scores()


@checks.add("score_window_1", with_(_window_scores(1), "SELECT raw_id, risk_score, risk_level FROM scored"))
def score_window_1(spark, folder):
    return score_latest(clean(spark, folder), 1).select("raw_id", "risk_score", "risk_level")


@checks.add("score_window_12", with_(_window_scores(12), "SELECT raw_id, risk_score, risk_level FROM scored"))
def score_window_12(spark, folder):
    return score_latest(clean(spark, folder), 12).select("raw_id", "risk_score", "risk_level")


_SPREAD = ("CASE event_id % 50 WHEN 0 THEN CAST('infinity' AS DOUBLE) WHEN 1 THEN CAST('-infinity' AS DOUBLE) WHEN 2 THEN NULL "
           "ELSE (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END) * CAST('1e' || (event_id % 401 - 200) AS DOUBLE) * (1 + event_id % 7) END")


def _scale(value: str) -> str:
    """Sign and power of ten: results are compared to six places, which would hide small values."""
    return f"sign({value}) * (300 + log10(abs({value})))"


_TIED = {"halves": "CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 2.0 END", "one_value": "7.0", "mostly_zero": "CASE WHEN event_id % 50 = 0 THEN event_id / 8.0 ELSE 0.0 END", "whole": "user_id",
         "quarters": "event_id % 4"}


@checks.add("profile_ties", "\nUNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(v) AS non_null, min(v) AS min, {r6('quantile_cont(v, 0.25)')} AS q25, {r6('quantile_cont(v, 0.5)')} AS q50, {r6('quantile_cont(v, 0.75)')} AS q75, max(v) AS max "
    f"FROM (SELECT CAST({expression} AS DOUBLE) AS v FROM events)" for name, expression in _TIED.items()))
def profile_ties(spark, folder):
    """Columns of few values, with quartiles between two of them."""
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr(*[f"CAST({expression} AS DOUBLE) AS {name}" for name, expression in _TIED.items()])
    return column_profile(rows, list(_TIED)).select("column_name", "non_null", "min", "q25", "q50", "q75", "max")


@checks.add("profile_extremes", f"""SELECT count(v) AS non_null, min(v) AS low, max(v) AS high, {r6(_scale("quantile_disc(v, 0.25)"))} AS near_q25, {r6(_scale("median(v)"))} AS q50
FROM (SELECT {_SPREAD} AS v FROM events)""")
def profile_extremes(spark, folder):
    """Infinities and values from 1e-200 to 1e200; the lower quartile as the value at its rank."""
    from gearwatch.operators.profile import order_statistics
    rows = spark.read.parquet(f"{folder}/events.parquet").selectExpr(f"{_SPREAD.replace(chr(39) + '1e' + chr(39) + ' || (event_id % 401 - 200)', 'concat(' + chr(39) + '1e' + chr(39) + ', event_id % 401 - 200)')} AS v")
    profile = column_profile(rows, ["v"]).select("non_null", F.col("min").alias("low"), F.col("max").alias("high"), F.expr(_scale("q50")).alias("q50"))
    count = profile.first().non_null
    rank = -(-count // 4)
    return profile.withColumn("_value", F.lit(order_statistics(rows, {"v": [rank]})["v", rank])).withColumn("near_q25", F.expr(_scale("_value"))).drop("_value")


# -- runs -------------------------------------------------------------------------------------

def _recomputed(spark, folder) -> Store:
    store, rows = new_store(spark, "rescored-keys"), arrivals(spark, folder)
    store.ingest(rows, "all", now=T1)
    run_rule_scoring(store, now=T1)
    recompute_keys(store, store.raw(), now=T2)
    return store


@checks.add("rescored_keys", with_(O.SCORES, "SELECT raw_id, source_file, engine_id, time_in_cycles AS latest_cycle, risk_score, risk_level, CAST(2 AS BIGINT) AS run_id FROM scored"))
def rescored_keys(spark, folder):
    return _recomputed(spark, folder).predictions().select("raw_id", "source_file", "engine_id", "latest_cycle", "risk_score", "risk_level", "run_id")


@checks.add("short_look_back", with_(O.BATCHED, "SELECT run_id, count(*) AS rows FROM batched GROUP BY ALL"))
def short_look_back(spark, folder):
    """Runs that look back on four rows per key write every row once; longer keys cut the look-back."""
    store = new_store(spark, "short")
    from registry.common import batches
    for number, batch in enumerate(batches(spark, folder)):
        store.ingest(batch, f"b{number}", now=T1)
        run_rule_scoring(store, now=T1, window_cycles=4)
    return store.processed().groupBy("run_id").agg(F.count("*").alias("rows"))


@checks.add("many_runs", """SELECT CAST(r AS BIGINT) AS run_id, 'SUCCESS' AS status FROM range(14) t(i), (SELECT i + 1 AS r) WHERE r > 4""")
def many_runs(spark, folder):
    """Fourteen runs, of which the report shows ten; all but the first find nothing new."""
    store, rows = new_store(spark, "many"), arrivals(spark, folder)
    store.ingest(rows, "all", now=T1)
    for _ in range(14):
        run_rule_scoring(store, now=T1)
    return reports.latest_runs(store.runs()).select("run_id", "status")


@checks.add("audit_rules", "SELECT CAST(34 AS BIGINT) AS rules, CAST(0 AS BIGINT) AS violations")
def audit_rules(spark, folder):
    return audit_store(scored_store(spark, folder)).agg(F.count("*").alias("rules"), F.sum("violations").alias("violations"))


# -- models -----------------------------------------------------------------------------------

@checks.add("split_rules", """SELECT count(DISTINCT user_id) AS engines, CAST(floor(count(DISTINCT user_id) * 0.7) AS BIGINT) AS train_engines,
CAST(0 AS BIGINT) AS in_both, count(*) AS rows FROM events""")
def split_rules(spark, folder):
    train, test = ml.split_engines(features(spark, folder).select("engine_id", "raw_id"))
    sides = train.withColumn("side", F.lit(1)).unionByName(test.withColumn("side", F.lit(0)))
    each = sides.groupBy("engine_id").agg(F.min("side").alias("low"), F.max("side").alias("high"), F.count("*").alias("n"))
    return each.agg(F.count("*").alias("engines"), F.count_if(F.col("low") == 1).alias("train_engines"),
                    F.count_if(F.col("low") != F.col("high")).alias("in_both"), F.sum("n").alias("rows"))


@checks.add("member_split", "SELECT CAST(user_id % 3 = 0 AS INTEGER) AS side, count(DISTINCT user_id) AS engines, count(*) AS rows FROM events GROUP BY ALL")
def member_split(spark, folder):
    rows = features(spark, folder).select("engine_id", "raw_id")
    inside, outside = ml.split_members(rows, rows.filter("engine_id % 3 = 0").select("engine_id"))
    both = inside.withColumn("side", F.lit(1)).unionByName(outside.withColumn("side", F.lit(0)))
    return both.groupBy("side").agg(F.countDistinct("engine_id").alias("engines"), F.count("*").alias("rows"))


def _predict_only():
    """A stand-in model without chances: its prediction is cut to 0..1."""
    class CycleCount:
        def predict(self, inputs):
            return (inputs["time_in_cycles"].to_numpy() - 2) / 4

    return CycleCount()


@checks.add("predict_only_score", with_(O.CLEAN, """SELECT raw_id, round_even(greatest(least((time_in_cycles - 2) / 4, 1.0), 0.0) * 1e6, 0) / 1e6 AS risk_score,
CASE WHEN time_in_cycles >= 6 THEN 'HIGH' WHEN time_in_cycles >= 4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM clean"""))
def predict_only_score(spark, folder):
    rows = features(spark, folder).select(*ml.REQUIRED, "s2")
    return ml.predict_foreign(_predict_only(), rows, ["time_in_cycles", "s2"]).select("raw_id", "risk_score", "risk_level")


@checks.add("limited_inputs", with_(O.CLEAN, """SELECT raw_id, source_file, engine_id, time_in_cycles FROM clean
QUALIFY row_number() OVER (PARTITION BY source_file, engine_id ORDER BY time_in_cycles DESC, raw_id DESC) = 1 ORDER BY source_file, engine_id LIMIT 40"""))
def limited_inputs(spark, folder):
    return latest_inputs(features(spark, folder), ["time_in_cycles", "s2"], 40).select(*ml.REQUIRED)


@checks.add("model_levels", with_(O.CLEAN, """SELECT raw_id, source_file, engine_id, time_in_cycles, true AS in_range, true AS level_fits, true AS action_fits FROM clean
QUALIFY row_number() OVER (PARTITION BY source_file, engine_id ORDER BY time_in_cycles DESC, raw_id DESC) = 1"""))
def model_levels(spark, folder):
    """What must hold of any trained model's results, whatever its trees."""
    from registry.models import model_score
    scored = model_score(spark, folder)
    level = F.when(F.col("risk_score") >= 0.8, "HIGH").when(F.col("risk_score") >= 0.5, "MEDIUM").otherwise("LOW")
    action = F.create_map(*[F.lit(x) for pair in O.PROBABILITY_ACTIONS.items() for x in pair])[F.col("risk_level")]
    return scored.select(*ml.REQUIRED, F.col("risk_score").between(0.0, 1.0).alias("in_range"), (F.col("risk_level") == level).alias("level_fits"),
                         (F.col("recommended_action") == action).alias("action_fits"))
