"""Numeric coercion and rounding.

Wide column lists are written as SQL text (one ``selectExpr`` call instead of hundreds of
column calls from Python); single columns as column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: the text forms accepted as a number. It keeps out the "5d" and "5f"
# suffixes that a SQL cast would accept.
NUMBER_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_TEXT = "^[+-]?[0-9]+$"


def finite_sql(value: str) -> str:
    """NaN and infinities become null."""
    return f"CASE WHEN abs({value}) < double('inf') THEN {value} END"


def double_sql(name: str, dtype: T.DataType | None) -> str:
    """Number of a text or numeric column; anything else is null.

    A text beyond the double range gives an infinity, which callers drop in a second step.
    """
    if dtype is None or isinstance(dtype, T.NullType):
        return "CAST(NULL AS DOUBLE)"
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN trim({name}) RLIKE '{NUMBER_TEXT}' THEN try_cast(trim({name}) AS DOUBLE) END"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return finite_sql(f"CAST({name} AS DOUBLE)")
    return f"CAST({name} AS DOUBLE)"


def doubles_sql(texts: list[str]) -> str:
    """Array of the numbers of many text columns.

    One small function applied to an array keeps the generated code short; a separate pattern
    match per column would outgrow what the JVM compiles.
    """
    return (f"transform(array({', '.join(texts)}), t -> CASE WHEN trim(t) RLIKE '{NUMBER_TEXT}' "
            f"THEN try_cast(trim(t) AS DOUBLE) END)")


def whole_sql(name: str, dtype: T.DataType | None, target: str) -> str:
    """Whole number, cut toward zero; out-of-range and non-numeric values are null."""
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return f"try_cast({name} AS {target})"
    number = f"try_cast({double_sql(name, dtype)} AS {target})"
    if isinstance(dtype, T.StringType):
        exact = f"CASE WHEN trim({name}) RLIKE '{INTEGER_TEXT}' THEN try_cast(trim({name}) AS {target}) END"
        return f"coalesce({exact}, {number})"
    return number


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    return df.schema[name].dataType if name in df.columns else None


def round_half_even(value: Column, places: int) -> Column:
    """Scale, round half to even, unscale: the rounding of array libraries."""
    scale = F.lit(float(10 ** places))
    return F.rint(value * scale) / scale


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def quoted(text: str) -> str:
    """A text as a SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
