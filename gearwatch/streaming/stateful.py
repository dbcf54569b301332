"""Scoring of a stream of readings that keeps its look-back as state.

The newest readings of every machine are kept as state, so a micro-batch needs neither the history nor a
tail of all machines. Results of a micro-batch go to folders of its number, so a batch that is run again
replaces what it wrote, and a query that is started again from its checkpoint goes on as if it had not
stopped.

A call of Python costs milliseconds and a look into the state about one. So machines are dealt by hash to
buckets, each of which is one call in a micro-batch, and the machines of a bucket to blocks, each
of which is one entry of the state. A micro-batch reads and writes the blocks of its machines. The
numbers of buckets and blocks belong to the checkpoint.

Rows equal those of the incremental run over the same batches. All rows of one bucket in one
micro-batch are ordered in one task; the source's files per trigger bound them.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from gearwatch import schema as S
from gearwatch.operators.clean import clean_telemetry
from gearwatch.operators.features import latest_per_key
from gearwatch.operators.scoring import score_alerts, score_risk
from gearwatch.plans.rule_run import TAIL_ROWS
from gearwatch.schema import CYCLE, ENGINE, KEY, SOURCE, TRACKED_SENSORS, Thresholds
from gearwatch.session import path_exists

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

_KINDS = {f.name: f.dataType for f in S.RAW.fields}
_KINDS |= {c: T.DoubleType() for c in S.DERIVED} | {"demo_rul": T.IntegerType()}
OUTPUT = T.StructType([T.StructField(c, _KINDS[c]) for c in S.PROCESSED_COLUMNS])
#: What the state keeps of a reading, packed.
KEPT = np.dtype([("raw_id", "<i8"), ("cycle", "<i4"), ("sensors", "<f8", (len(TRACKED_SENSORS),))])
#: Entry of the state: [source, engine, readings] of a block's machines, and the readings in that order.
BLOCK = T.StructType([T.StructField("machines", T.StringType()), T.StructField("rows", T.BinaryType())])
BUCKETS, BLOCKS = 256, 64
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rolling(values: np.ndarray, window: int, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and sample deviation of the last ``window`` rows, and change from the row before, per column.

    ``place`` is each row's place in its series, where several series follow one another.
    """
    place = np.arange(len(values)) if place is None else place

    def ago(k: int) -> np.ndarray:
        return np.where((place >= k)[:, None], np.roll(values, k, axis=0), np.nan)

    count = np.minimum(place + 1, window)[:, None]
    reach = range(min(window, int(place.max(initial=0)) + 1) - 1, -1, -1)
    mean = sum((np.nan_to_num(ago(k), posinf=np.inf, neginf=-np.inf) for k in reach), np.zeros(values.shape)) / count
    spread = sum((np.nan_to_num((ago(k) - mean) ** 2, posinf=np.inf) for k in reach), np.zeros(values.shape))
    deviation = np.where(count > 1, np.sqrt(spread / np.maximum(count - 1, 1)), 0.0)
    change = np.where((place > 0)[:, None], values - np.roll(values, 1, axis=0), 0.0)
    return mean, deviation, change


class KeyedFeatures(StatefulProcessor):
    """Features of the new readings of a bucket's machines, from them and the newest earlier ones."""

    def __init__(self, window: int, tail_rows: int) -> None:
        self.window, self.tail_rows = window, tail_rows

    def init(self, handle) -> None:
        self.blocks = handle.getMapState("blocks", T.StructType([T.StructField("block", T.IntegerType())]), BLOCK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        group = new.groupby(list(KEY), sort=False).ngroup().to_numpy()
        fresh_machines = {}
        for place, (block, machine, engine) in enumerate(new.loc[~new.duplicated(list(KEY)), ["block", *KEY]].itertuples(index=False, name=None)):
            fresh_machines.setdefault(int(block), {})[machine, int(engine)] = place
        # Machines of a block stand together, the known ones first.
        machines, counts, earlier, spans, code_of = [], [], [], {}, np.empty(group.max() + 1, np.int64)
        for block, found in fresh_machines.items():
            held, first = self.blocks.getValue((block,)), len(machines)
            for machine, engine, count in json.loads(held[0]) if held else []:
                machines.append((machine, engine))
                counts.append(count)
            if held:
                earlier.append(np.frombuffer(bytes(held[1]), KEPT))
            known = {m: first + i for i, m in enumerate(machines[first:])}
            for m, place in found.items():
                if m not in known:
                    known[m] = len(machines)
                    machines.append(m)
                    counts.append(0)
                code_of[place] = known[m]
            spans[block] = first, len(machines)
        mine = np.empty(len(new), KEPT)
        mine["raw_id"], mine["cycle"], mine["sensors"] = new["raw_id"], new[CYCLE], new[list(TRACKED_SENSORS)].to_numpy(float)
        readings = np.concatenate([*earlier, mine])
        code = np.concatenate([np.repeat(np.arange(len(machines)), counts), code_of[group]])
        source = np.arange(len(readings)) - (len(readings) - len(new))  # row of ``new``; below 0: an earlier reading
        order = np.lexsort((readings["raw_id"], readings["cycle"], code))
        readings, code, source = readings[order], code[order], source[order]
        ends = np.searchsorted(code, np.arange(len(machines)), side="right")
        starts = np.concatenate([[0], ends[:-1]])
        kept, at = np.minimum(ends - starts, self.tail_rows), np.arange(len(code))
        newest = ends[code] - at <= self.tail_rows
        for block, (low, high) in spans.items():
            span = slice(starts[low], ends[high - 1])
            named = [[*m, int(n)] for m, n in zip(machines[low:high], kept[low:high])]
            self.blocks.updateValue((block,), (json.dumps(named), readings[span][newest[span]].tobytes()))
        mean, deviation, change = rolling(readings["sensors"], self.window, at - starts[code])
        fresh = source >= 0
        taken = source[fresh]
        made = {"demo_rul": (readings["cycle"][ends[code] - 1] - readings["cycle"])[fresh], **{c: new[c].to_numpy()[taken] for c in OUTPUT.names if c in new.columns}}
        for i, sensor in enumerate(TRACKED_SENSORS):
            made |= {f"rolling_avg_{sensor}": mean[fresh, i], f"rolling_std_{sensor}": deviation[fresh, i], f"delta_{sensor}": change[fresh, i]}
        for name, kind in (("raw_id", np.int64), (ENGINE, np.int32), (CYCLE, np.int32), ("demo_rul", np.int32)):
            made[name] = made[name].astype(kind)
        yield pd.DataFrame({name: made[name] for name in OUTPUT.names})

    def close(self) -> None:
        pass


def keyed_features(readings: DataFrame, window: int = S.ROLLING_ROWS, tail_rows: int = TAIL_ROWS, buckets: int = BUCKETS, blocks: int = BLOCKS) -> DataFrame:
    """Feature rows of a stream of raw readings."""
    if tail_rows < window - 1:
        raise ValueError(f"a window of {window} rows needs {window - 1} earlier ones; {tail_rows} are kept")
    rows = clean_telemetry(readings, unique_ids=True).select(*[c for c in S.PROCESSED_COLUMNS if c in S.RAW.names])
    dealt = (rows.withColumn("hash", F.xxhash64(*KEY)).withColumn("bucket", F.expr(f"pmod(hash, {buckets}L)"))
             .withColumn("block", F.expr(f"CAST(pmod(hash div {buckets}L, {blocks}L) AS INT)")).drop("hash"))
    return dealt.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=KeyedFeatures(window, tail_rows), outputStructType=OUTPUT, outputMode="append", timeMode="none")


def score_with_state(readings: DataFrame, folder: str, checkpoint: str, *, window: int = S.ROLLING_ROWS, tail_rows: int = TAIL_ROWS,
                     cuts: Thresholds = Thresholds(), drain: bool = True, interval: str = "60 seconds") -> StreamingQuery:
    """Features, risk scores and alerts of each micro-batch, under ``folder``; scores are relative to the batch."""
    spark, name = readings.sparkSession, "spark.sql.streaming.stateStore.providerClass"

    def score(batch: DataFrame, batch_id: int) -> None:
        session, place = batch.sparkSession, f"batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{folder}/features/{place}")
        features = session.read.schema(OUTPUT).parquet(f"{folder}/features/{place}")
        scored = score_risk(latest_per_key(features), cuts, keep=["raw_id", SOURCE, ENGINE, CYCLE])
        scored.write.mode("overwrite").parquet(f"{folder}/predictions/{place}")
        score_alerts(session.read.schema(scored.schema).parquet(f"{folder}/predictions/{place}"), cuts).write.mode("overwrite").parquet(f"{folder}/alerts/{place}")

    writer = keyed_features(readings, window, tail_rows).writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    before = spark.conf.get(name)
    spark.conf.set(name, STORE)  # a query takes the settings that hold when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before)


def scored_batches(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All rows of features, predictions or alerts, with their batch_id."""
    path = f"{folder}/{table}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no batch was scored under {folder}")
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
