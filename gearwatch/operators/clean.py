"""Cleaning of raw telemetry: conform, coerce, drop, fill, deduplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from gearwatch.functions.numbers import double_sql, doubles_sql, finite_sql, quoted, whole_sql
from gearwatch.schema import CYCLE, ENGINE, NATURAL_KEY, READINGS, SOURCE


def conform(df: DataFrame, default_source: str = "UNKNOWN") -> DataFrame:
    """Fixed columns and types in fixed order; absent columns are null, null readings are 0.

    ``raw_id``, ``inserted_at`` and ``arrival_seq`` are kept when present.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    if "raw_id" in types:
        columns.append(f"{whole_sql('raw_id', types['raw_id'], 'BIGINT')} AS raw_id")
    columns += [c for c in ("inserted_at", "arrival_seq") if c in types]
    columns.append(f"coalesce(CAST({SOURCE if SOURCE in types else 'NULL'} AS STRING), {quoted(default_source)}) AS {SOURCE}")
    columns += [f"{whole_sql(c, types.get(c), 'INT')} AS {c}" for c in (ENGINE, CYCLE)]
    texts = [c for c in READINGS if isinstance(types.get(c), T.StringType)]
    columns += [f"coalesce({double_sql(c, types.get(c))}, 0.0D) AS {c}" for c in READINGS if c not in texts]
    if not texts:
        return df.selectExpr(*columns)
    rows = df.selectExpr(*columns, f"{doubles_sql(texts)} AS _values")
    values = {c: f"coalesce({finite_sql(f'_values[{i}]')}, 0.0D) AS {c}" for i, c in enumerate(texts)}
    keys = [c for c in rows.columns if c != "_values" and c not in READINGS]
    return rows.selectExpr(*keys, *[values.get(c, c) for c in READINGS])


def drop_unkeyed(df: DataFrame) -> DataFrame:
    """Rows without engine, cycle or (when present) raw id are dropped."""
    return df.dropna(subset=[c for c in ("raw_id", ENGINE, CYCLE) if c in df.columns])


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key.

    Each map task keeps one row per key before the shuffle, so copies of one key, however
    many, never meet in one task.
    """
    spec = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(spec)).filter(F.col("_rank") == 1).drop("_rank")


def arrival_order(df: DataFrame) -> list[Column]:
    """Arrival order if the frame carries one, else a fixed order of the contents."""
    if "arrival_seq" in df.columns:
        return [F.col("arrival_seq")]
    return [F.col(c).asc_nulls_last() for c in df.columns]


def clean_telemetry(df: DataFrame, *, unique_ids: bool = False, default_source: str = "UNKNOWN") -> DataFrame:
    """Clean frame for feature building.

    Duplicates are removed by raw id, or by natural key when there is no raw id; the first
    arrival stays. Frames read from the raw table have unique ids, so those callers pass
    ``unique_ids=True`` and save the shuffle.
    """
    rows = drop_unkeyed(conform(df, default_source))
    if unique_ids:
        return rows
    keys = ["raw_id"] if "raw_id" in rows.columns else NATURAL_KEY
    return first_by(rows, keys, arrival_order(rows))


def ordered(df: DataFrame) -> DataFrame:
    """Output order: source, engine, cycle and raw id."""
    return df.orderBy(*NATURAL_KEY, *[c for c in ("raw_id",) if c in df.columns])
