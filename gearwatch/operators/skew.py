"""Splitting of hot groups and size-checked broadcasts.

A group is hot above ``HOT_ROWS`` rows, so a table of N rows has at most N / HOT_ROWS hot
groups. That bound is what makes it safe to broadcast the list of them. Hot groups are cut
into segments along an increasing whole-number position; all other groups stay whole. With
no hot group the list is empty and adaptive execution removes the joins and extra branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

HOT_ROWS = 1_000_000
BROADCAST_ROWS = 200_000


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, *measures: Column) -> DataFrame:
    """Groups above ``hot_rows`` rows, counted with map-side partial aggregation."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *measures)
            .filter(F.col("_rows") > hot_rows))


def with_segments(df: DataFrame, keys: list[str], position: str, hot: DataFrame, width: int) -> DataFrame:
    """Tag rows of hot groups with the ``width``-wide range their position falls in.

    Positions are whole numbers that are unique in a group, so a segment holds at most
    ``width`` rows. Rows of other groups get segment 0.
    """
    segment = F.when(F.col("_rows").isNotNull(), F.floor(F.col(position) / F.lit(width))).otherwise(F.lit(0))
    return df.join(F.broadcast(hot), keys, "left").withColumn("_segment", segment.cast("long"))


def may_be_hot(rows: int | None, hot_rows: int) -> bool:
    """Whether a table of at most ``rows`` rows (None: unknown) can have a hot group at all."""
    return rows is None or rows > hot_rows


def numbered(df: DataFrame, keys: list[str], position: str, name: str, *, rows: int | None = None,
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """1-based row number per group in position order, without one task per hot group.

    ``rows`` is a known upper bound of the table's row count; a small table is numbered directly.
    """
    if not may_be_hot(rows, hot_rows):
        return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(position)))
    hot = hot_groups(df, keys, hot_rows)
    tagged = with_segments(df, keys, position, hot, hot_rows)
    cells = (tagged.filter(F.col("_rows").isNotNull())
             .groupBy(*keys, "_segment").agg(F.count(F.lit(1)).alias("_size")))
    earlier = W.partitionBy(*keys).orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select(*keys, "_segment", F.sum("_size").over(earlier).alias("_before"))
    inside = W.partitionBy(*keys, "_segment").orderBy(position)
    return (tagged.join(offsets, [*keys, "_segment"], "left")
            .withColumn(name, F.coalesce("_before", F.lit(0)) + F.row_number().over(inside))
            .select(*df.columns, name))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint when a count shows it is small, and whether it is."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df) if small else df), small
