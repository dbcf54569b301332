"""Column profiles with exact quartiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from gearwatch.session import scratch_folder

#: Values of a range that are gathered and sorted at the end, and the steps that a range is cut into before.
GATHERED, STEPS = 4096, 2000
ACCURACY = 10_000


def order_statistics(df: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """Exact ``n``-th smallest (1-based) non-null values of several columns; NaN is left out.

    Every wanted rank lies in a range of values, at first all of them. A pass estimates the values a
    little below and above the rank inside its range, a second one counts exactly how many values
    are below and at both estimates. The rank is one of them, or the range becomes what lies strictly
    between them (or beyond one), so every round leaves out the values estimated, however many rows
    share them, and as a rule leaves a thousandth of the rows. Ranges of at most
    ``GATHERED`` values are read and sorted. The columns are written once, and no larger part of
    them is sorted or gathered.
    """
    columns = list(wanted)
    path = scratch_folder(df.sparkSession, "profile")
    df.selectExpr(*[f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END AS {c}" for c in columns]).write.parquet(path)
    values = df.sparkSession.read.parquet(path)
    found: dict[tuple[str, int], float] = {}
    totals = values.agg(*[F.count(c) for c in columns]).first()
    # Per target: lowest and highest value, values below the range and values in it.
    ranges = {(c, n): (-math.inf, math.inf, 0, total) for c, total in zip(columns, totals) for n in wanted[c] if 1 <= n <= total}

    def inside(target: tuple[str, int]) -> Column:
        low, high = ranges[target][:2]
        return F.when(F.col(target[0]).between(F.lit(low), F.lit(high)), F.col(target[0]))

    while ranges:
        large = [t for t, r in ranges.items() if r[3] > GATHERED]
        if not large:
            break
        guesses = values.agg(*[F.percentile_approx(inside(t), [max(0.0, p - 1 / STEPS), min(1.0, p + 1 / STEPS)], ACCURACY)
                               for t in large for p in [(t[1] - ranges[t][2]) / ranges[t][3]]]).first()
        counts = values.agg(*[F.count_if(met) for t, (a, b) in zip(large, guesses)
                              for met in (F.col(t[0]) < a, F.col(t[0]) <= a, F.col(t[0]) < b, F.col(t[0]) <= b)]).first()
        for i, target in enumerate(large):
            (low, high, below, rows), (a, b), n = ranges[target], guesses[i], target[1]
            under_a, to_a, under_b, to_b = counts[4 * i:4 * i + 4]
            if n <= under_a:  # a miss of the estimate: go on in the part that holds the rank
                ranges[target] = (low, math.nextafter(a, -math.inf), below, under_a - below)
            elif n <= to_a or under_b < n <= to_b:
                found[target] = a if n <= to_a else b
                del ranges[target]
            elif n <= under_b:
                ranges[target] = (math.nextafter(a, math.inf), math.nextafter(b, -math.inf), to_a, under_b - to_a)
            else:
                ranges[target] = (math.nextafter(b, math.inf), high, to_b, below + rows - to_b)
    if ranges:
        targets = list(ranges)
        lists = values.agg(*[F.sort_array(F.collect_list(inside(t))) for t in targets]).first()
        found |= {t: lists[i][t[1] - ranges[t][2] - 1] for i, t in enumerate(targets)}
    return found


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles (linear) and maximum per column."""
    spark = df.sparkSession
    measures = [m for c in columns for m in (F.count(c), F.avg(c), F.stddev_samp(c), F.min(c), F.max(c))]
    flat = df.agg(*measures).first()
    stats = {c: flat[5 * i:5 * i + 5] for i, c in enumerate(columns)}
    places = {(c, q): (stats[c][0] - 1) * q for c in columns if stats[c][0] for q in (0.25, 0.5, 0.75)}
    wanted: dict[str, set[int]] = {}
    for (c, _), at in places.items():
        wanted.setdefault(c, set()).update((math.floor(at) + 1, math.ceil(at) + 1))
    found = order_statistics(df, {c: sorted(ns) for c, ns in wanted.items()})

    def quantile(c: str, q: float) -> float | None:
        if (c, q) not in places:
            return None
        at = places[(c, q)]
        low, high = found[(c, math.floor(at) + 1)], found[(c, math.ceil(at) + 1)]
        return low if low == high else low + (high - low) * (at - math.floor(at))

    types = dict(df.dtypes)
    rows = [(c, types[c], stats[c][0], stats[c][1], stats[c][2], float(stats[c][3]) if stats[c][3] is not None else None,
             quantile(c, 0.25), quantile(c, 0.5), quantile(c, 0.75),
             float(stats[c][4]) if stats[c][4] is not None else None) for c in columns]
    return spark.createDataFrame(rows, "column_name string, column_type string, non_null bigint, mean double, std double, "
                                       "min double, q25 double, q50 double, q75 double, max double")
