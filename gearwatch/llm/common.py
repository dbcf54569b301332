"""Small helpers shared by the text operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from gearwatch.session import scratch_folder, shuffles_freed

# Fixed value: what separates words, as a Java and Python character class.
SPACES = r"[\x20\x09-\x0D]+"

LAST = 2**63 - 1


def by_value(module: str) -> None:
    """Ship a module's functions to Python workers with the job, so the package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column) -> Column:
    """Words between blanks; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def positions(count: Column) -> Column:
    """0 .. count - 1, also for a count of 0 or less."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


#: Folders and catalog tables made inside ``noted``, or None outside of it.
_noted: list[tuple[str, str | None]] | None = None


@contextmanager
def noted() -> Iterator[list[tuple[str, str | None]]]:
    """The folders and tables that operators write in the meantime, for ``drop``."""
    global _noted
    before, _noted = _noted, []
    try:
        yield _noted
    finally:
        _noted = before


def new_folder(spark: SparkSession, label: str, table: str | None = None) -> str:
    path = scratch_folder(spark, label)
    if _noted is not None:
        _noted.append((path, table))
    return path


def drop(spark: SparkSession, made: list[tuple[str, str | None]]) -> None:
    """Remove noted folders and tables. Whatever was made of them has to be written before."""
    while made:
        path, table = made.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Bytes of an Arrow batch while scratch tables are written: each running task holds some batches, in the JVM and in Python.
BATCH_BYTES = 8 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``BATCH_BYTES`` for what is written in the meantime, no shuffle files behind it; the session's own settings come back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        with shuffles_freed(spark):
            yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(grouped: DataFrame, key: str, label: str) -> DataFrame:
    """As ``written``, in buckets of ``key``: later joins and groups on it move only the other side.

    ``grouped`` is the result of a group or join by ``key``, so its partitions are these buckets already
    and each bucket is written as one file without another shuffle.
    """
    spark = grouped.sparkSession
    name, buckets = f"{label}_{uuid.uuid4().hex}", shuffle_partitions(spark)
    with small_batches(spark):
        grouped.write.bucketBy(buckets, key).options(path=new_folder(spark, label, name), compression="zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def ranked(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """``df`` with each row's place in ``order``, from 0, in the new column ``name``.

    The rows are sorted by sampled ranges and written, so no value, however frequent or far away,
    brings unrelated rows together. A row's place is its place in its file behind the files before
    it: one row per file is summed up and broadcast, and there are no more files than partitions of
    the shuffle. The files are fixed, so a retried task gives the same places.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    with small_batches(spark):
        df.sort(*order).write.parquet(path, compression="zstd")
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    placed = spark.read.schema(df.schema).parquet(path).select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_row"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_size")).select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")
