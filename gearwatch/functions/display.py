"""Operator-facing texts and the run schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: accepted HH:MM text. There is no end anchor; the column is five characters wide.
TIME_TEXT = r"^([01][0-9]|2[0-3]):[0-5][0-9]"


def fixed_decimals(value: Column, places: int) -> Column:
    """Text with a fixed number of decimals, rounded from the exact binary value."""
    return F.call_function("format_number", value, F.lit("0." + "0" * places))


def probability_text(value: Column) -> Column:
    """Percent text up to 1, plain two-decimal text above, "-" when there is no number."""
    return (F.when(value.isNull() | F.isnan(value), "-")
            .when(value <= 1.0, F.concat(fixed_decimals(value * 100, 2), F.lit("%")))
            .otherwise(fixed_decimals(value, 2)))


def level_title(level: Column) -> Column:
    return F.initcap(level)


def thousands(count: Column) -> Column:
    return F.format_number(count, 0)


def two_decimals(value: Column) -> Column:
    return fixed_decimals(value, 2)


def export_name(at: Column, prefix: str = "predictions") -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit(".csv"))


def clock_text(at: Column) -> Column:
    return F.date_format(at, "HH:mm")


def is_scheduled(at: Column, times: list[str] | tuple[str, ...]) -> Column:
    return clock_text(at).isin(list(times))


def half_hour_slots(spark: SparkSession) -> DataFrame:
    """The 48 selectable run times with their 24-hour and 12-hour texts."""
    start = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return (spark.range(48)
            .select(F.col("id").cast("int").alias("slot"),
                    (start + F.make_dt_interval(mins=(F.col("id") * 30).cast("int"))).alias("at"))
            .select("slot", F.date_format("at", "HH:mm").alias("value_24h"),
                    F.date_format("at", "hh:mm a").alias("display_12h")))
