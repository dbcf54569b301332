"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# The JVM does not compile methods above 8,000 bytes of bytecode. Rows here are wide, so generated
# stages easily pass that; below the limit Spark falls back to small generated functions, which
# made the feature table four times faster.
METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    """Settings that wide telemetry rows need, for sessions made elsewhere."""
    for name, value in METHOD_LIMIT.items():
        spark.conf.set(name, value)
    return spark


#: Shuffle files go when the statement that made them is done, not when the driver next collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in the meantime are removed with each write; the session's own setting comes back."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def build_session(app: str = "gearwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **METHOD_LIMIT,
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; a local one only on a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"{label}-")
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whichever file system the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none where it is absent."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in files.listStatus(place)] if files.exists(place) else []
