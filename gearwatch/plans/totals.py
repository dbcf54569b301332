"""Totals of the result tables, kept by the changes of each run.

A run that wrote results adds its signed changes to the totals of the run before it: rows whose key
is new, alerts that it opened or opened again, and engines that moved from one risk level to
another. It also keeps the newest prediction of every engine it touched. Both are written before
the run commits, and the run log names the run whose totals are in force. Readers open a few small
files instead of the tables; resolved alerts are subtracted from the log of resolutions.

Only what may be changed is compared: runs of the same model whose id ranges overlap, and the engines
in the run. Where a run dates the newest prediction of an engine back, the next one may be any
older row; such a run leaves no totals, and the next run counts everything once, as does the first
run of a store whose runs have none. One writer at a time, as in the store.
"""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F, types as T

from gearwatch import schema as S
from gearwatch.operators.clean import first_by
from gearwatch.plans import reports
from gearwatch.schema import ENGINE
from gearwatch.session import path_exists

if TYPE_CHECKING:
    from gearwatch.plans.store import Store

#: State folders after which a run writes the newest predictions of all engines again.
STATE_FOLDERS = 16

TOTALS = T.StructType([T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()), T.StructField("rows", T.LongType())])
_KEPT = ["raw_id", "model_version", "id", "prediction_time", "risk_score", "risk_level", "latest_cycle", "recommended_action"]
NEWEST = T.StructType([f for f in S.PREDICTIONS.fields if f.name in (ENGINE, *_KEPT)])
_KEYS = {"processed": ["raw_id"], "predictions": ["raw_id", "model_version"], "alerts": ["raw_id", "model_version"]}
_Counts = dict[tuple[str, str], int]


def in_force(store: Store) -> int | None:
    """The run whose totals hold now; 0 before the first run, None when everything has to be counted."""
    last, run = store.committed_runs().agg(F.max("run_id"), F.max_by("totals_run", "run_id")).first()
    return 0 if last is None else run


def counted(store: Store, run: int) -> _Counts:
    """The totals that a run left, one row per table and risk level."""
    if not run:
        return {}
    rows = store.spark.read.schema(TOTALS).parquet(f"{store.root}/totals/run_id={run}").collect()
    return {(r.kind, r.name): r.rows for r in rows}


def _state_folders(store: Store, run: int, first: int) -> list[str]:
    rows = store.committed_runs().filter((F.col("totals_run") == F.col("run_id")) & F.col("run_id").between(first, run)).select("run_id").collect()
    paths = [f"{store.root}/newest/run_id={r.run_id}" for r in rows]
    return [p for p in paths if path_exists(store.spark, p)]


def _newest(store: Store, folders: list[str]) -> DataFrame:
    """Newest prediction per engine; a later run's row has taken the earlier ones into account."""
    if not folders:
        return store.spark.createDataFrame([], NEWEST)
    rows = store.spark.read.schema(T.StructType(NEWEST.fields + [T.StructField("run_id", T.LongType())])).option("basePath", f"{store.root}/newest").parquet(*folders)
    return rows.groupBy(ENGINE).agg(F.max_by(F.struct(*_KEPT), "run_id").alias("_n")).select(ENGINE, "_n.*")


def closed_since(store: Store, run: int) -> int:
    """Open alerts that were resolved after a run."""
    return store.resolutions().filter(F.col("after_run_id") >= run).agg(F.coalesce(F.sum("closed"), F.lit(0))).first()[0]


def _recounted(store: Store) -> _Counts:
    counts = reports.headline_counts(store.raw(), store.processed(), store.predictions(), store.alerts()).collect()
    names = {"processed_rows": "processed", "prediction_rows": "predictions", "active_alerts": "alerts"}
    levels = reports.latest_per_engine(store.predictions()).groupBy("risk_level").agg(F.count(F.lit(1)).alias("rows")).collect()
    return ({("table", names[r.metric]): r.rows for r in counts if r.metric in names}
            | {("level", r.risk_level): r.rows for r in levels})


def _earlier(store: Store, table: str, run: dict) -> list[int]:
    """Committed runs that may hold a key of this run's rows."""
    rows = store.committed_runs()
    low, high, model = run.get("from_raw_id"), run.get("to_raw_id"), run.get("model_version")
    if low is not None:
        rows = rows.filter(F.col("from_raw_id").isNull() | ((F.col("from_raw_id") <= high) & (F.col("to_raw_id") >= low)))
    if table != "processed" and model is not None:
        rows = rows.filter(F.col("model_version").isNull() | (F.col("model_version") == model))
    ids = [r.run_id for r in rows.select("run_id").collect()]
    return [i for i in ids if path_exists(store.spark, f"{store.root}/{table}/run_id={i}")]


def _between(rows: DataFrame, run: dict) -> DataFrame:
    return rows if run.get("from_raw_id") is None else rows.filter(F.col("raw_id").between(run["from_raw_id"], run["to_raw_id"]))


def advance(store: Store, run: dict) -> int | None:
    """Write the totals as they are with this run, which is about to commit; returns the run whose totals hold then."""
    run_id, before = run["run_id"], in_force(store)
    tables = [t for t in _KEYS if path_exists(store.spark, f"{store.root}/{t}/run_id={run_id}")]
    if not tables:
        return before
    base = _recounted(store) if before is None else counted(store, before)
    if before:
        base["table", "alerts"] = base.get(("table", "alerts"), 0) - closed_since(store, before)
    changes, first = [], run_id
    for table in tables:
        new = store.of_run(table, run_id)
        earlier = _earlier(store, table, run)
        if earlier:
            held = store.alerts().filter(~F.col("is_resolved")) if table == "alerts" else store.of_runs(table, earlier)
            new = new.join(_between(held, run).select(*_KEYS[table]), _KEYS[table], "left_anti")
        changes.append(new.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("table").alias("kind"), F.lit(table).alias("name"), "rows"))
    if "predictions" in tables:
        folders = _state_folders(store, before, base.get(("state", "from"), 0)) if before else []
        state = reports.latest_per_engine(store.predictions()).select(*NEWEST.names) if before is None else _newest(store, folders)
        full = before is None or len(folders) >= STATE_FOLDERS
        moved = _advance_newest(store, run, state, full)
        if moved is None:
            return None
        changes.append(moved)
        first = run_id if full or not before else base["state", "from"]
    elif before:
        first = base.get(("state", "from"), run_id)
    elif before is None:
        return None  # the state of a store without totals starts with a run that predicts
    for r in reduce(DataFrame.unionByName, changes).collect():
        base[r.kind, r.name] = base.get((r.kind, r.name), 0) + r.rows
    base["state", "from"] = first
    rows = [(kind, name, n) for (kind, name), n in sorted(base.items(), key=repr)]
    store.spark.createDataFrame(rows, TOTALS).coalesce(1).write.mode("overwrite").parquet(f"{store.root}/totals/run_id={run_id}")
    return run_id


def _advance_newest(store: Store, run: dict, state: DataFrame, full: bool) -> DataFrame | None:
    """Write the newest predictions of the run's engines; returns the engines each level won or lost.

    None when the newest prediction of an engine was dated back.
    """
    keys, run_id = _KEYS["predictions"], run["run_id"]
    mine = store.of_run("predictions", run_id).select(*NEWEST.names)
    earlier = _earlier(store, "predictions", run)
    if earlier:  # a prediction keeps its first id
        ids = _between(store.of_runs("predictions", earlier), run).groupBy(*keys).agg(F.min("id").alias("_first"))
        mine = mine.join(ids, keys, "left").withColumn("id", F.least("id", "_first")).drop("_first")
    again = mine.select(*keys, F.col("prediction_time").alias("_again"))
    old = state.join(mine.select(ENGINE).distinct(), ENGINE, "left_semi").join(again, keys, "left")
    if earlier and not old.filter(F.col("_again") < F.col("prediction_time")).isEmpty():
        return None
    rows = mine.unionByName(old.filter("_again IS NULL").drop("_again"))
    rows = first_by(rows, [ENGINE], [F.col("prediction_time").desc(), F.col("id").desc()]).select(*NEWEST.names)
    if full:
        rows = rows.unionByName(state.join(mine.select(ENGINE).distinct(), ENGINE, "left_anti").select(*NEWEST.names))
    path = f"{store.root}/newest/run_id={run_id}"
    rows.write.mode("overwrite").parquet(path)
    now = store.spark.read.schema(NEWEST).parquet(path)
    was = state.join(now.select(ENGINE), ENGINE, "left_semi").select("risk_level", F.lit(-1).alias("change"))
    return (now.select("risk_level", F.lit(1).alias("change")).unionByName(was).groupBy("risk_level")
            .agg(F.sum("change").alias("rows")).select(F.lit("level").alias("kind"), F.col("risk_level").alias("name"), "rows"))


# -- readers ----------------------------------------------------------------------------------

def headline_counts(store: Store) -> DataFrame:
    """``reports.headline_counts`` from the kept totals and the ingest log."""
    run = in_force(store)
    if run is None:
        return reports.headline_counts(store.raw(), store.processed(), store.predictions(), store.alerts())
    found = counted(store, run)
    raw = store.ingests().agg(F.coalesce(F.sum("inserted"), F.lit(0))).first()[0]
    shown = [("raw_rows", raw), ("processed_rows", found.get(("table", "processed"), 0)), ("prediction_rows", found.get(("table", "predictions"), 0)),
             ("active_alerts", found.get(("table", "alerts"), 0) - closed_since(store, run))]
    return store.spark.createDataFrame(shown, "metric string, rows bigint")


def risk_distribution(store: Store) -> DataFrame:
    """``reports.risk_distribution`` from the kept totals."""
    run = in_force(store)
    if run is None:
        return reports.risk_distribution(store.predictions())
    found = {name: n for (kind, name), n in counted(store, run).items() if kind == "level" and n}
    rows = [(level, found.get(level, 0)) for level in dict.fromkeys([*reports.LEVELS, *found])]
    return reports.with_shares(store.spark.createDataFrame(rows, "risk_level string, engines bigint"))


def engine_status(store: Store) -> DataFrame:
    """``reports.engine_status`` from the kept newest predictions."""
    run = in_force(store)
    if run is None:
        return reports.engine_status(store.predictions())
    folders = _state_folders(store, run, counted(store, run)["state", "from"]) if run else []
    return _newest(store, folders).select(ENGINE, *reports.STATUS)
