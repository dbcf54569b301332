"""File sources and sinks: whitespace text, CSV, Parquet, dataset paths."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession, Window as W, functions as F, types as T

from gearwatch.functions.numbers import double_sql, whole_sql
from gearwatch.operators.selection import slice_bounds
from gearwatch.operators.skew import broadcast_if_small
from gearwatch.schema import CYCLE, ENGINE, READINGS, SOURCE, TEXT_COLUMNS
from gearwatch.session import path_exists

#: How null is written in CSV; backslashes of texts are escaped, so no text looks like it.
NULL_TEXT = "\\N"

# Fixed value: names of the known datasets.
DATASETS = ("FD001", "FD002", "FD003", "FD004")


def dataset_path(name: str, paths: dict[str, str] | None = None, any_path: str | None = None,
                 folder: str = "data") -> str:
    """Path of a dataset: its own override, else the general override, else the default name."""
    name = name.upper()
    own = {k.upper(): v for k, v in (paths or {}).items()}
    return own.get(name) or any_path or os.path.join(folder, f"train_{name}.txt")


def read_text_telemetry(spark: SparkSession, path: str | list[str], source: str | None = None) -> DataFrame:
    """Headerless whitespace-separated readings; blank lines are dropped.

    ``source`` fills ``source_file``; without it the file name up to the first dot is used.
    """
    name = F.lit(source) if source else F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    lines = (spark.read.text(path).filter("value RLIKE '[^ \\\\t\\\\r]'")
             .select(name.alias(SOURCE), F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ").alias("_parts")))
    return lines.selectExpr(SOURCE, *_text_fields())


def _text_fields() -> list[str]:
    fields = []
    for i, c in enumerate(TEXT_COLUMNS):
        part = f"get(_parts, {i})"
        number = whole_sql(part, T.StringType(), "INT") if c in (ENGINE, CYCLE) else double_sql(part, T.StringType())
        fields.append(f"{number} AS {c}")
    return fields


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Readings of one text file with ``line``, the 1-based position among non-blank lines.

    Rows are counted per file split, the counts are added up in file order, and each split
    starts at its total; no row passes through a single task. There is one start per split, so
    the starts of all but very large sources are broadcast after a count.
    """
    lines = (spark.read.text(path).filter("value RLIKE '[^ \\\\t\\\\r]'")
             .select(F.trim(F.regexp_replace("value", r"\s+", " ")).alias("_text"),
                     F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_at")))
    blocks = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    starts, _ = broadcast_if_small(starts)
    name = F.regexp_extract(F.element_at(F.split("_file", "/"), -1), r"^([^.]+)", 1)
    return (lines.join(starts, ["_file", "_block"])
            .select((F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"),
                    name.alias(SOURCE), F.split("_text", " ").alias("_parts"))
            .selectExpr("line", SOURCE, *_text_fields()))


def replay_lines(spark: SparkSession, path: str, start: int = 1, limit: int | None = None) -> DataFrame:
    """Rows ``start`` .. ``start + limit - 1`` of a text file, in file positions."""
    first, last = slice_bounds(start, limit)
    rows = numbered_lines(spark, path).filter(F.col("line") >= first)
    return rows if last is None else rows.filter(F.col("line") <= last)


def write_text_telemetry(df: DataFrame, path: str) -> None:
    """One folder per source of space-separated lines, the format read above."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in TEXT_COLUMNS]
    (df.select(F.concat_ws(" ", *fields, F.lit(" ")).alias("value"), SOURCE)
     .write.mode("overwrite").partitionBy(SOURCE).text(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        raise FileNotFoundError(f"table not found: {path}")
    return spark.read.parquet(path)


def table_columns(spark: SparkSession, path: str) -> list[str]:
    return read_table(spark, path).columns


def export_csv(df: DataFrame, path: str, order_by: str | None = "id") -> int:
    """Write CSV with a header, ordered when the column exists; returns the row count.

    The sort is a range-partitioned one, so part files are in order and written in parallel.
    Null is written as ``\\N`` and empty text as ``""``. Line breaks and backslashes of texts are
    escaped, so every row is one line and large files can be read in parts; see ``read_csv``.
    """
    if not df.columns:
        raise ValueError("table has no readable columns")
    rows = df.orderBy(order_by) if order_by and order_by in df.columns else df
    written = Observation()
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    texts = _on_texts(rows, [("\\", "\\_"), ("\n", "\\n"), ("\r", "\\r")])
    texts.write.mode("overwrite").csv(path, header=True, escape='"', nullValue=NULL_TEXT, emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return written.get["rows"]


def _on_texts(df: DataFrame, changes: list[tuple[str, str]]) -> DataFrame:
    """Replace pieces of text in all text columns, one change after the other."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            for old, new in changes:
                column = F.replace(column, F.lit(old), F.lit(new))
        columns.append(column.alias(f.name))
    return df.select(*columns)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, infer: bool = True) -> DataFrame:
    """CSV as ``export_csv`` writes it: texts come back as they were, empty text apart from null.

    Without a schema a pass over the data finds the types; without ``infer`` every column is text.
    """
    reader = spark.read.options(header=True, escape='"', nullValue=NULL_TEXT, emptyValue="")
    rows = (reader.schema(schema) if schema else reader.option("inferSchema", infer)).csv(path)
    return _on_texts(rows, [("\\n", "\n"), ("\\r", "\r"), ("\\_", "\\")])


def union_exports(frames: list[DataFrame]) -> DataFrame:
    """Several exports as one training set, matched by column name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


__all__ = ["DATASETS", "READINGS", "dataset_path", "export_csv", "numbered_lines", "read_csv", "read_table",
           "read_text_telemetry", "replay_lines", "table_columns", "table_exists", "union_exports",
           "write_text_telemetry"]
