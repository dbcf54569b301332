"""Run-versioned Parquet tables with a marker-row commit.

Data of a run goes to ``<table>/run_id=N``. The SUCCESS row in the run log, written last,
makes all tables of the run visible at once; data of a failed or lost run is never read.
Upserts are appended and resolved when read. One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from gearwatch import schema as S
from gearwatch.functions.display import TIME_TEXT
from gearwatch.functions.messages import accepted, rejected
from gearwatch.operators.clean import first_by
from gearwatch.operators.membership import build_filter, possible
from gearwatch.operators.features import last_rows
from gearwatch.operators.skew import BROADCAST_ROWS, broadcast_if_small
from gearwatch.plans import totals
from gearwatch.schema import CYCLE, KEY, NATURAL_KEY, READINGS
from gearwatch.session import folder_names, path_exists, shuffles_freed, tune

#: Ingests after which one writes the marks of all keys again.
MARK_FOLDERS = 16
#: Late rows that are looked up in all filters before the others are.
PROBE_ROWS = 1000
COMPRESSION = "zstd"
#: Readings per key that a tail holds for the runs after it; a longer look-back reads the whole history.
TAIL_ROWS = max(50, S.CONTEXT_ROWS)

_PLACE = ["_part", "_place"]
_MARKS = T.StructType([f for f in S.RAW.fields if f.name in NATURAL_KEY])
_BY_RUN = {"processed": S.PROCESSED, "predictions": S.PREDICTIONS, "alerts": S.ALERTS, "context": S.RAW, "tails": S.RAW}
_FILTERS = T.StructType([T.StructField("buckets", T.LongType()), T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())])
_BY_INGEST = {"raw": S.RAW, "marks": _MARKS, "quarantine": S.QUARANTINE, "filters": _FILTERS}
_LOGS = {"runs": S.RUNS, "ingests": S.INGESTS, "resolutions": S.RESOLUTIONS, "schedule": S.SCHEDULE}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Store:
    """Tables of one deployment under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = tune(spark)
        self.root = root.rstrip("/")

    # -- layout -----------------------------------------------------------------------------

    def create(self) -> "Store":
        """Write the empty ingest log, which streams follow; other tables start with their first write."""
        self._nothing(S.INGESTS).write.mode("ignore").parquet(f"{self.root}/ingests")
        return self

    def _nothing(self, schema: T.StructType) -> DataFrame:
        columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
        return self.spark.range(0).selectExpr(*columns)

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path) else self._nothing(schema)

    def _log(self, name: str) -> DataFrame:
        return self._read(name, _LOGS[name])

    def _append_log(self, name: str, row: dict) -> None:
        columns = [F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in _LOGS[name].fields]
        self.spark.range(0, 1, 1, 1).select(*columns).write.mode("append").parquet(f"{self.root}/{name}")

    def _versions(self, table: str) -> DataFrame:
        if table in _BY_RUN:
            return self._read(table, T.StructType(_BY_RUN[table].fields + [T.StructField("run_id", T.LongType())]))
        return self._read(table, T.StructType(_BY_INGEST[table].fields + [T.StructField("ingest_id", T.StringType())]))

    # -- raw readings -----------------------------------------------------------------------

    def ingests(self) -> DataFrame:
        return self._log("ingests")

    def _by_ingest(self, table: str) -> DataFrame:
        return self._versions(table).join(self.ingests().select("ingest_id"), "ingest_id", "left_semi")

    def raw(self) -> DataFrame:
        """Committed raw readings."""
        return self._by_ingest("raw").drop("ingest_id")

    def raw_between(self, after: int, up_to: int | None = None) -> DataFrame:
        """Committed raw readings with ``after < raw_id <= up_to``; only folders that hold such ids are opened."""
        wanted = F.col("to_raw_id") > after
        if up_to is not None:
            wanted &= F.col("from_raw_id") <= up_to
        folders = [f"{self.root}/raw/ingest_id={r[0]}" for r in self.ingests().filter(wanted).select("ingest_id").collect()]
        if not folders:
            return self._nothing(S.RAW)
        rows = self.spark.read.schema(S.RAW).parquet(*folders).filter(F.col("raw_id") > after)
        return rows if up_to is None else rows.filter(F.col("raw_id") <= up_to)

    def quarantine(self) -> DataFrame:
        """Rejected messages with their reason."""
        return self._by_ingest("quarantine")

    def _mark_folders(self) -> list[str]:
        """Folders of the marks of all keys: those since the last ingest that wrote the marks of every key."""
        log = self.ingests().filter("to_raw_id IS NOT NULL")
        since = log.filter("full_marks = 1").agg(F.coalesce(F.max("to_raw_id"), F.lit(0))).first()[0]
        return [f"{self.root}/marks/ingest_id={r[0]}" for r in log.filter(F.col("to_raw_id") >= since).select("ingest_id").collect()]

    def newest_cycles(self) -> DataFrame:
        """Highest stored cycle per key, from the marks of at most ``MARK_FOLDERS`` ingests."""
        folders = self._mark_folders()
        marks = self.spark.read.schema(_MARKS).parquet(*folders) if folders else self._nothing(_MARKS)
        return marks.groupBy(*KEY).agg(F.max(CYCLE).alias("_mark"))

    def absent(self, rows: DataFrame) -> DataFrame:
        """Rows whose natural key is not stored yet.

        A cycle above the newest stored cycle of its key cannot be stored, so only late rows are
        looked up, first in the Bloom filter of every ingest. Only the raw folders of ingests that
        may hold one of them are opened; none when there are no late rows or all are new.
        """
        marked = rows.join(self.newest_cycles(), KEY, "left")
        late = F.coalesce(F.col(CYCLE) <= F.col("_mark"), F.lit(False))
        fresh, behind = marked.filter(~late), marked.filter(late)
        if behind.isEmpty():
            return fresh.drop("_mark")
        stored = self._folders_with(behind)
        if stored:
            held = self.spark.read.schema(S.RAW).parquet(*stored).select(*NATURAL_KEY)
            behind = behind.join(held, NATURAL_KEY, "left_anti")
        return fresh.unionByName(behind).drop("_mark")

    def _folders_with(self, rows: DataFrame) -> list[str]:
        """Raw folders that may hold a natural key of ``rows``: those whose filter has it, and those without a filter."""
        ingests = self.ingests().filter("inserted > 0").select("ingest_id")
        filters = self._by_ingest("filters")
        every = {r[0] for r in ingests.collect()}
        known = {r[0] for r in ingests.join(filters.select("ingest_id").distinct(), "ingest_id", "left_anti").collect()}
        # A redelivery hits its folders with any few rows; only the other filters are searched for all rows.
        for asked in (F.broadcast(rows.select(*NATURAL_KEY).limit(PROBE_ROWS)), rows):
            if known == every:
                break
            left = filters.filter(~F.col("ingest_id").isin(*known)) if known else filters
            known |= {r[0] for r in possible(asked, NATURAL_KEY, left).select("ingest_id").distinct().collect()}
        return [f"{self.root}/raw/ingest_id={i}" for i in sorted(known)]

    def ingest(self, batch: DataFrame, ingest_id: str, now: datetime | None = None) -> dict:
        """Insert the first arrival of every absent natural key; return the counters.

        ``batch`` needs ``arrival_seq``, which grows with arrival, and the reading columns. It may
        repeat, also for files or partitions that count by themselves; ``arrival_part`` then tells
        them apart, and equal arrivals are ordered by part and natural key. Raw ids are given out
        here, without gaps, in that order. Rows with a ``reject_reason`` are quarantined. A
        committed ``ingest_id`` is not inserted again.
        """
        here = F.col("ingest_id") == ingest_id
        base, known = self.ingests().agg(F.coalesce(F.max("to_raw_id"), F.lit(0)),
                                         F.max(F.when(here, F.struct(*S.INGESTS.names)))).first()
        if known:
            return known.asDict()
        now = now or utc_now()
        if "reject_reason" not in batch.columns:
            batch = batch.withColumn("reject_reason", F.lit(None).cast("string")).withColumn("body", F.lit(None).cast("string"))
        if "inserted_at" not in batch.columns:
            batch = batch.withColumn("inserted_at", F.lit(now).cast("timestamp"))
        if "arrival_part" not in batch.columns:
            batch = batch.withColumn("arrival_part", F.lit(None).cast("string"))
        batch = self._staged(batch, "classified", ingest_id)
        ok = F.col("reject_reason").isNull()
        consumed, skipped = batch.agg(F.count_if(ok), F.count_if(~ok)).first()
        valid = self._with_places(accepted(batch))
        slim = valid.select("arrival_seq", "arrival_part", *NATURAL_KEY, *_PLACE)
        firsts = first_by(slim, NATURAL_KEY, [F.col("arrival_seq"), F.col("arrival_part")])
        new = self.absent(self._staged(firsts, "firsts", ingest_id)) if base else firsts
        path = f"{self.root}/raw/ingest_id={ingest_id}"
        rows = valid.select(*_PLACE, *NATURAL_KEY, *READINGS, F.col("inserted_at").cast("timestamp"))
        (rows.join(self._ids(new, base, ingest_id), _PLACE).select(*S.RAW.names)
         .sortWithinPartitions(*NATURAL_KEY).write.mode("overwrite").parquet(path, compression=COMPRESSION))
        written = self.spark.read.schema(S.RAW).parquet(path)
        inserted, low, high = written.agg(F.count(F.lit(1)), F.min("raw_id"), F.max("raw_id")).first()
        if inserted and (low, high) != (base + 1, base + inserted):
            raise RuntimeError(f"ingest {ingest_id!r} gave {inserted} readings the ids {low} to {high}")
        full = len(self._mark_folders()) >= MARK_FOLDERS
        marks = written.select(*NATURAL_KEY)
        if full:
            marks = marks.unionByName(self.newest_cycles().withColumnRenamed("_mark", CYCLE))
        (marks.groupBy(*KEY).agg(F.max(CYCLE).alias(CYCLE))
         .write.mode("overwrite").parquet(f"{self.root}/marks/ingest_id={ingest_id}"))
        if inserted:
            build_filter(written, NATURAL_KEY, inserted).write.mode("overwrite").parquet(f"{self.root}/filters/ingest_id={ingest_id}")
        if skipped:
            rejected(batch).write.mode("overwrite").parquet(f"{self.root}/quarantine/ingest_id={ingest_id}")
        row = {"ingest_id": ingest_id, "consumed": consumed, "inserted": inserted, "duplicates": consumed - inserted,
               "skipped": skipped, "from_raw_id": low, "to_raw_id": high, "committed_at": now, "full_marks": int(full)}
        self._append_log("ingests", row)
        return row

    def _staged(self, df: DataFrame, step: str, ingest_id: str) -> DataFrame:
        """A step of an ingest, written and read back; an ingest that is tried again writes it anew.

        Every task writes one file, so the number of a file and the place in it tell rows apart.
        """
        path = f"{self.root}/staging/{step}/ingest_id={ingest_id}"
        df.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)

    def _with_places(self, staged: DataFrame) -> DataFrame:
        """Staged rows with the number of their file and their place in it."""
        part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
        return staged.select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_place"))

    def _ids(self, new: DataFrame, base: int, ingest_id: str) -> DataFrame:
        """The places of ``new`` with consecutive raw ids above ``base`` in arrival order.

        Only keys and places are put in order and written; a row's id is its place in the
        ordered files. The files are fixed, so a retried task gives the same ids. The
        readings are joined to them by place, so they are shuffled once, and not at all where
        the ids can be sent to every task.
        """
        ordered = self._staged(new.orderBy("arrival_seq", "arrival_part", *NATURAL_KEY).select(*[F.col(c).alias(f"_from{c}") for c in _PLACE]), "ordered", ingest_id)
        placed = self._with_places(ordered)
        before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
        starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size")).select(
            "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
        starts, _ = broadcast_if_small(starts)
        numbered = placed.join(starts, "_part").select(
            *[F.col(f"_from{c}").alias(c) for c in _PLACE], (F.col("_before") + F.col("_place") + F.lit(base + 1)).alias("raw_id"))
        # Places are spread evenly, and a part of the ids is far smaller than that of the readings.
        return F.broadcast(numbered) if ordered.count() <= BROADCAST_ROWS else numbered.hint("shuffle_hash")

    # -- run log ----------------------------------------------------------------------------

    def runs(self) -> DataFrame:
        """Latest row per run."""
        log = self._log("runs")
        return log.groupBy("run_id").agg(F.max_by(F.struct(*log.columns), "seq").alias("r")).select("r.*").drop("seq")

    def position(self, pipeline: str) -> dict:
        """Last run id, ids given out by committed runs and checkpoint of a pipeline, in one read of the log."""
        done, zero = F.col("status") == "SUCCESS", F.lit(0)
        mine = done & (F.col("pipeline_name") == pipeline) & F.col("to_raw_id").isNotNull() & (F.col("run_type") != "recompute")
        return self._log("runs").agg(
            F.coalesce(F.max("run_id"), zero).alias("last_run_id"),
            F.coalesce(F.max(F.when(done, F.col("last_prediction_id"))), zero).alias("last_prediction_id"),
            F.coalesce(F.max(F.when(done, F.col("last_alert_id"))), zero).alias("last_alert_id"),
            F.max(F.when(mine, F.col("run_id"))).alias("last_working_run"),
            F.coalesce(F.max(F.when(mine, F.col("checkpoint_after"))), zero).alias("checkpoint")).first().asDict()

    def start_run(self, pipeline: str, run_type: str, now: datetime, at: dict, checkpoint_before: int | None = None) -> dict:
        """Log a RUNNING row; ``at`` is the position the run starts from."""
        run = {"run_id": at["last_run_id"] + 1, "seq": 0, "pipeline_name": pipeline, "run_type": run_type,
               "scheduled_time": now, "started_at": now, "status": "RUNNING", "raw_rows_used": 0,
               "checkpoint_before": checkpoint_before}
        self._append_log("runs", run)
        return run

    def finish_run(self, run: dict, status: str, now: datetime, **fields) -> dict:
        """Final row of a run; with status SUCCESS it commits the run, with the totals as they are then."""
        row = {**run, "seq": 1, "status": status, "finished_at": now, **fields}
        if status == "SUCCESS":
            row["totals_run"] = totals.advance(self, row)
        self._append_log("runs", row)
        return row

    def checkpoint(self, pipeline: str = S.RULE_PIPELINE) -> dict:
        """Forward-only position: the highest id of the committed runs and its insert time."""
        row = self.checkpoints().filter(F.col("pipeline_name") == pipeline).first()
        return row.asDict() if row else {"pipeline_name": pipeline, "last_processed_raw_id": 0,
                                         "last_processed_inserted_at": None, "updated_at": None}

    def checkpoints(self) -> DataFrame:
        done = self._log("runs").filter("status = 'SUCCESS' AND to_raw_id IS NOT NULL AND checkpoint_after IS NOT NULL AND run_type <> 'recompute'")
        return done.groupBy("pipeline_name").agg(
            F.max("checkpoint_after").alias("last_processed_raw_id"),
            F.max_by("last_inserted_at", F.struct("checkpoint_after", "run_id")).alias("last_processed_inserted_at"),
            F.max("finished_at").alias("updated_at"))

    # -- results ----------------------------------------------------------------------------

    def write(self, table: str, df: DataFrame, run_id: int) -> DataFrame:
        """Write one table of a run; returns the written rows, read back."""
        path = f"{self.root}/{table}/run_id={run_id}"
        schema = _BY_RUN[table]
        with shuffles_freed(df.sparkSession):
            df.select(*schema.names).write.mode("overwrite").parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(schema).parquet(path)

    def look_back(self, up_to: int, run_id: int | None = None) -> tuple[DataFrame, int, int]:
        """Readings up to an id that hold the newest of every key; the rows of the tail among them, and all others.

        These are the newest tail that a committed run up to ``run_id`` left and the readings behind
        its last id. Readings below that id which are not in the tail are no newest ones.
        """
        done = {r.run_id for r in self.committed_runs().filter(F.col("checkpoint_after") <= up_to).select("run_id").collect()}
        names = folder_names(self.spark, f"{self.root}/tails")
        left = [n for n in (int(name.split("=")[1]) for name in names if name.startswith("run_id=")) if n in done and (run_id is None or n <= run_id)]
        if not left:
            return self.raw_between(0, up_to), 0, up_to
        tail = self.of_run("tails", max(left))
        held, last = tail.agg(F.count(F.lit(1)), F.coalesce(F.max("raw_id"), F.lit(0))).first()
        return tail.unionByName(self.raw_between(last, up_to)), held, up_to - last

    def tail(self, run_id: int | None) -> DataFrame | None:
        """The newest readings per key as of a run, or None when there is no such run."""
        run = self.committed_runs().filter(F.col("run_id") == run_id).first() if run_id is not None else None
        return last_rows(self.look_back(run.checkpoint_after, run_id)[0], TAIL_ROWS) if run and run.checkpoint_after is not None else None

    def committed_runs(self) -> DataFrame:
        """The final row of every successful run."""
        return self._log("runs").filter("status = 'SUCCESS'")

    def committed(self, table: str) -> DataFrame:
        """Every version written by a successful run."""
        return self._versions(table).join(self.committed_runs().select("run_id"), "run_id", "left_semi")

    def of_run(self, table: str, run_id: int) -> DataFrame:
        """What one run wrote, committed or not."""
        return self.spark.read.schema(_BY_RUN[table]).parquet(f"{self.root}/{table}/run_id={run_id}")

    def of_runs(self, table: str, run_ids: list[int]) -> DataFrame:
        """What some runs wrote; other folders are not opened."""
        return self.spark.read.schema(_BY_RUN[table]).parquet(*[f"{self.root}/{table}/run_id={i}" for i in run_ids])

    def overlapping_runs(self, table: str) -> list[int]:
        """Runs whose rows of a table may be written by another run as well.

        The run log has the id range of every run. Ranges are swept in order; a run that wrote
        without a range may overlap with all others. Predictions and alerts of different models
        have different keys, so these are swept by model; a run without one counts for every
        model. One row per run reaches the driver.
        """
        done = self._log("runs").filter("status = 'SUCCESS'")
        if table == "processed":
            done = done.filter(F.col("pipeline_name") == S.RULE_PIPELINE)
        else:
            done = done.filter(F.col("last_prediction_id" if table == "predictions" else "last_alert_id").isNotNull())
        ranges = done.select("run_id", "from_raw_id", "to_raw_id", "model_version").collect()
        models = {r.model_version for r in ranges if r.model_version is not None} if table != "processed" else set()
        found: set[int] = set()
        for model in models or {None}:
            mine = [r for r in ranges if model is None or r.model_version in (model, None)]
            open_ended = [r.run_id for r in mine if r.from_raw_id is None and path_exists(self.spark, f"{self.root}/{table}/run_id={r.run_id}")]
            known = sorted((r.from_raw_id, r.to_raw_id, r.run_id) for r in mine if r.from_raw_id is not None)
            if open_ended:
                everything = open_ended + [run for *_, run in known]
                found |= set(everything) if len(everything) > 1 else set()
                continue
            reach, reaching = None, None
            for low, high, run in known:
                if reach is not None and low <= reach:
                    found |= {run, reaching}
                if reach is None or high > reach:
                    reach, reaching = high, run
        return sorted(found)

    def _resolved(self, table: str, columns: list[str], resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Committed rows with versions resolved; rows of runs that overlap with no other are read as they are."""
        rows, again = self.committed(table), self.overlapping_runs(table)
        if not again:
            return rows.select(*columns)
        repeated = F.col("run_id").isin(again)
        return rows.filter(~repeated).select(*columns).unionByName(resolve(rows.filter(repeated)).select(*columns))

    def processed(self) -> DataFrame:
        """Processed rows, one per raw id: the latest. Only a recompute run covers ids again."""
        columns = [*S.PROCESSED.names, "run_id"]
        return self._resolved("processed", columns, lambda rows: first_by(rows, ["raw_id"], [F.col("run_id").desc()]))

    def predictions(self) -> DataFrame:
        """One row per raw id and model: first id and creation time, everything else latest."""
        keys = ["raw_id", "model_version"]
        latest = [c for c in [*S.PREDICTIONS.names, "run_id"] if c not in (*keys, "id", "created_at")]

        def resolve(rows: DataFrame) -> DataFrame:
            return (rows.groupBy(*keys)
                    .agg(F.min("id").alias("id"), F.min("created_at").alias("created_at"),
                         F.max_by(F.struct(*latest), "run_id").alias("_latest"))
                    .select("id", *keys, "created_at", "_latest.*"))

        return self._resolved("predictions", ["id", *keys, "created_at", *latest], resolve)

    def alerts(self) -> DataFrame:
        """One row per raw id and model; a new write reopens a resolved alert."""
        keys = ["raw_id", "model_version"]
        latest = [c for c in [*S.ALERTS.names, "run_id"] if c not in (*keys, "id")]

        def resolve(rows: DataFrame) -> DataFrame:
            return (rows.groupBy(*keys).agg(F.min("id").alias("id"), F.max_by(F.struct(*latest), "run_id").alias("_latest"))
                    .select("id", *keys, "_latest.*"))

        merged = self._resolved("alerts", ["id", *keys, *latest], resolve)
        closed = self.resolutions().groupBy(F.col("alert_id").alias("id")).agg(F.max("after_run_id").alias("_closed"))
        return (merged.join(closed, "id", "left")
                .withColumn("is_resolved", F.coalesce(F.col("_closed") >= F.col("run_id"), F.lit(False))).drop("_closed"))

    def resolutions(self) -> DataFrame:
        """The log of resolved alerts; ``closed`` is 1 where the alert was open until then."""
        return self._log("resolutions")

    def resolve_alert(self, alert_id: int, now: datetime | None = None) -> None:
        last = self._log("runs").filter("status = 'SUCCESS'").agg(F.coalesce(F.max("run_id"), F.lit(0))).first()[0]
        named = self.committed("alerts").filter(F.col("id") == alert_id).select("raw_id", "model_version").first()
        closed = 0
        if named:
            same = (F.col("raw_id") == named.raw_id) & F.col("model_version").eqNullSafe(named.model_version)
            closed = int(not self.alerts().filter(same & (F.col("id") == alert_id) & ~F.col("is_resolved")).isEmpty())
        self._append_log("resolutions", {"alert_id": alert_id, "after_run_id": last, "resolved_at": now or utc_now(), "closed": closed})

    # -- schedule ---------------------------------------------------------------------------

    def schedule(self) -> DataFrame:
        """The current three run times."""
        return self._log("schedule").orderBy(F.col("version").desc()).limit(1)

    def schedule_times(self) -> list[str]:
        row = self.schedule().first()
        return [row.time_1, row.time_2, row.time_3] if row else list(S.DEFAULT_TIMES)

    def set_schedule(self, time_1: str, time_2: str, time_3: str, now: datetime | None = None) -> None:
        for text in (time_1, time_2, time_3):
            if len(text) > 5 or not re.match(TIME_TEXT, text):
                raise ValueError(f"not an HH:MM time: {text!r}")
        version = self._log("schedule").agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
        self._append_log("schedule", {"version": version, "time_1": time_1, "time_2": time_2, "time_3": time_3,
                                      "updated_at": now or utc_now()})

