"""Row slices, ranks and engine filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 65_536


def slice_bounds(start: int, limit: int | None) -> tuple[int, int | None]:
    """First and last 1-based position of a slice; no limit means to the end."""
    if start < 1:
        raise ValueError("start row must be >= 1")
    if limit is not None and limit < 0:
        raise ValueError("limit must be >= 0")
    return start, None if limit is None else start + limit - 1


def nth_smallest(df: DataFrame, name: str, n: int) -> int | None:
    """The ``n``-th smallest (1-based) value of a whole-number column without a sort.

    Each pass counts rows in at most 65,536 equal ranges and goes on in the one that holds
    the wanted row. 64-bit values need four passes; only the counts reach the driver.
    """
    values = df.select(F.col(name).cast("bigint").alias("v"))
    low, high, total = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if n < 1 or n > total:
        return None
    while low < high:
        width = -(-(high - low + 1) // BUCKETS)
        counts = (values.filter(f"v BETWEEN {low} AND {high}")
                  .groupBy(F.expr(f"(v - {low}) DIV {width}").alias("bucket")).count().orderBy("bucket").collect())
        for bucket, count in counts:
            if n <= count:
                break
            n -= count
        low = low + bucket * width
        high = min(high, low + width - 1)
    return low


def row_slice(df: DataFrame, by: str, start: int = 1, limit: int | None = None) -> DataFrame:
    """Rows at positions ``start`` .. ``start + limit - 1`` in order of a unique whole-number column.

    The positions are turned into two values first, so the result is a plain range filter
    that reaches the scan.
    """
    first, last = slice_bounds(start, limit)
    low = nth_smallest(df, by, first)
    if low is None or limit == 0:
        return df.filter(F.lit(False))
    rows = df.filter(F.col(by) >= low)
    high = None if last is None else nth_smallest(df, by, last)
    return rows if high is None else rows.filter(F.col(by) <= high)


def _whole(text: str) -> int | None:
    try:
        return int(text)
    except ValueError:
        return None


def engine_ranges(text: str) -> list[tuple[int, int]] | None:
    """Ranges of a filter text such as ``3, 10-20``; None when blank, bad parts are ignored."""
    if not text.strip():
        return None
    ranges = []
    for part in (p.strip() for p in text.split(",")):
        single = _whole(part)
        if single is not None and "-" not in part:
            ranges.append((single, single))
            continue
        bounds = [_whole(b) for b in part.split("-")]
        if len(bounds) == 2 and None not in bounds:
            ranges.append((min(bounds), max(bounds)))
    return ranges


def engine_filter(column: Column, text: str) -> Column:
    ranges = engine_ranges(text)
    if ranges is None:
        return F.lit(True)
    condition = F.lit(False)
    for low, high in ranges:
        condition = condition | column.between(low, high)
    return condition
