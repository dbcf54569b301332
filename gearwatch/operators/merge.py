"""Keyed insert and upsert of one frame into another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gearwatch.operators.clean import first_by


def insert_absent(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First arrival per key of ``batch`` whose key is not in ``target``."""
    return first_by(batch, keys, order).join(target.select(*keys), keys, "left_anti")


def insert_counts(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Consumed, inserted and duplicate rows of an insert."""
    consumed = batch.agg(F.count(F.lit(1)).alias("consumed"))
    inserted = insert_absent(target, batch, keys, order).agg(F.count(F.lit(1)).alias("n")).scalar()
    return consumed.withColumn("inserted", inserted).withColumn("duplicates", F.col("consumed") - F.col("inserted"))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], preserved: list[str] | None = None) -> DataFrame:
    """``updates`` replace target rows of the same key; ``preserved`` columns keep the target's value.

    Both frames have one row per key. Only keys and preserved columns of the target are
    joined to the updates.
    """
    kept = target.join(updates.select(*keys), keys, "left_anti")
    if preserved:
        old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in preserved])
        updates = updates.join(old, keys, "left").select(
            *[F.coalesce(f"_old_{c}", c).alias(c) if c in preserved else F.col(c) for c in updates.columns])
    return kept.unionByName(updates)
