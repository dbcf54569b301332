"""Rolling, variability and change features per machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gearwatch.operators.skew import HOT_ROWS, hot_groups, may_be_hot, with_segments
from gearwatch.schema import CYCLE, DERIVED, FLAT_SENSORS, KEY, ROLLING_ROWS, TRACKED_SENSORS

MAX_LAGS = 9


def time_order(df: DataFrame, descending: bool = False) -> list[Column]:
    names = [CYCLE] + (["raw_id"] if "raw_id" in df.columns else [])
    return [F.col(c).desc() if descending else F.col(c).asc() for c in names]


def last_rows(df: DataFrame, rows: int, keys: list[str] = KEY) -> DataFrame:
    """Newest ``rows`` rows per key; each map task sends on at most that many per key."""
    spark, limit = df.sparkSession, "spark.sql.optimizer.windowGroupLimitThreshold"
    if rows > int(spark.conf.get(limit)):
        spark.conf.set(limit, str(rows))  # up to this many rows per key Spark cuts before the shuffle
    spec = W.partitionBy(*keys).orderBy(*time_order(df, descending=True))
    return df.withColumn("_rank", F.row_number().over(spec)).filter(F.col("_rank") <= rows).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Row with the highest cycle, then the highest raw id, per key."""
    return last_rows(df, 1, keys)


def _add_features(df: DataFrame, partition: list[str], window: int) -> DataFrame:
    """Rolling mean, rolling deviation, change and newest cycle in the partition.

    For short windows the tracked sensors travel as one struct: a handful of ``lag`` calls
    fetch the earlier rows and the statistics are plain arithmetic inside code generation,
    instead of 18 sliding aggregates per row.
    """
    kept = df.columns
    order = ", ".join(c for c in (CYCLE, "raw_id") if c in kept)
    history = f"PARTITION BY {', '.join(partition)} ORDER BY {order}"
    newest = f"max({CYCLE}) OVER (PARTITION BY {', '.join(partition)}) AS _last_cycle"
    packed = df.selectExpr(*kept, f"struct({', '.join(TRACKED_SENSORS)}) AS _now")
    deltas = [f"coalesce({s} - _ago1.{s}, 0.0D) AS delta_{s}" for s in TRACKED_SENSORS]
    averages = [f"rolling_avg_{s}" for s in TRACKED_SENSORS]
    if window > MAX_LAGS:
        rolling = f"{history} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW"
        means = [f"avg({s}) OVER ({rolling}) AS rolling_avg_{s}" for s in TRACKED_SENSORS]
        deviations = [f"coalesce(stddev_samp({s}) OVER ({rolling}), 0.0D) AS rolling_std_{s}" for s in TRACKED_SENSORS]
        rows = packed.selectExpr(*kept, newest, f"lag(_now) OVER ({history}) AS _ago1", *means, *deviations)
        return rows.selectExpr(*kept, "_last_cycle", *averages, *[f"rolling_std_{s}" for s in TRACKED_SENSORS], *deltas)

    ago = [f"_ago{k}" for k in range(1, max(window, 2))]
    rows = packed.selectExpr(*kept, newest, *[f"lag(_now, {k}) OVER ({history}) AS {a}" for k, a in enumerate(ago, 1)])
    used = ago[:window - 1]
    count = " + ".join(["1", *[f"CAST({a} IS NOT NULL AS INT)" for a in used]])
    means = [f"({' + '.join([s, *[f'coalesce({a}.{s}, 0.0D)' for a in used]])}) / ({count}) AS rolling_avg_{s}"
             for s in TRACKED_SENSORS]
    rows = rows.selectExpr(*kept, "_last_cycle", *ago, f"{count} AS _count", *means)

    def deviation(s: str) -> str:
        mean = f"rolling_avg_{s}"
        squares = " + ".join([f"({s} - {mean}) * ({s} - {mean})", *[
            f"coalesce(({a}.{s} - {mean}) * ({a}.{s} - {mean}), 0.0D)" for a in used]])
        return f"CASE WHEN _count > 1 THEN sqrt(({squares}) / (_count - 1)) ELSE 0.0D END AS rolling_std_{s}"

    return rows.selectExpr(*kept, "_last_cycle", *averages, *[deviation(s) for s in TRACKED_SENSORS], *deltas)


def _carried_rows(tagged: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows that precede each segment of a hot key, addressed to that segment.

    Every segment has at least one row, so the wanted rows lie in the previous ``rows``
    segments, and only the last ``rows`` rows of each segment can be among them.
    """
    order = [c for c in (CYCLE, "raw_id") if c in tagged.columns]
    hot = tagged.filter(F.col("_rows").isNotNull()).select(*KEY, "_segment", *order, *TRACKED_SENSORS)
    tails = (last_rows(hot, rows, [*KEY, "_segment"])
             .groupBy(*KEY, "_segment")
             .agg(F.sort_array(F.collect_list(F.struct(*order, *TRACKED_SENSORS))).alias("_tail")))
    by_key = W.partitionBy(*KEY).orderBy("_segment")
    nothing = F.array().cast(tails.schema["_tail"].dataType)
    earlier = F.concat(*[F.coalesce(F.lag("_tail", k).over(by_key), nothing) for k in range(rows, 0, -1)])
    surplus = F.greatest(F.size("_earlier") - rows, F.lit(0))
    return (tails.withColumn("_earlier", earlier)
            .select(*KEY, "_segment", F.explode(F.slice("_earlier", surplus + 1, F.lit(rows))).alias("_row"))
            .select(*KEY, "_segment", "_row.*"))


def build_features(clean: DataFrame, window: int = ROLLING_ROWS, *, rows: int | None = None,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Feature table: kept columns, 27 derived features and the remaining-cycles proxy.

    All windows share one shuffle. Keys above ``hot_rows`` rows are cut into segments of
    ``hot_rows`` cycles; the rows just before a segment are carried into it, so the rolling
    values are those of the whole key. ``rows`` is a known upper bound of the frame's row
    count (or of the rows per key); up to ``hot_rows`` no key can be hot and none is looked for.
    """
    if "rolling_avg_s2" in clean.columns:
        raise ValueError("features are already present")
    kept = [c for c in clean.columns if c not in FLAT_SENSORS]
    frame = clean.select(*kept)
    if not may_be_hot(rows, hot_rows):
        return _add_features(frame, KEY, window).selectExpr(*kept, *DERIVED, f"_last_cycle - {CYCLE} AS demo_rul")

    hot = hot_groups(frame, KEY, hot_rows, F.max(CYCLE).alias("_newest"))
    tagged = with_segments(frame, KEY, CYCLE, hot, hot_rows)
    carried = _carried_rows(tagged, max(window - 1, 1)).withColumn("_carried", F.lit(True))
    frame = tagged.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    return (_add_features(frame.drop("_rows"), [*KEY, "_segment"], window)
            .filter("NOT _carried")
            .selectExpr(*kept, *DERIVED, f"coalesce(_newest, _last_cycle) - {CYCLE} AS demo_rul"))


def missing_features(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if c not in df.columns]


def training_columns(df: DataFrame) -> DataFrame:
    """Only model inputs and label: ids, source, time and remaining cycles are dropped."""
    extra = ["id", "raw_id", "source_file", "processed_at", "inserted_at", "demo_rul", "engine_id"]
    return df.drop(*extra)


__all__ = ["DERIVED", "build_features", "last_rows", "latest_per_key", "missing_features",
           "time_order", "training_columns"]
