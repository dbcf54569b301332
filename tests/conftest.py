import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gearwatch.schema import READINGS  # noqa: E402
from gearwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


def reading(raw_id, engine, cycle, value, source="FD001", **extra):
    row = {"raw_id": raw_id, "source_file": source, "engine_id": engine, "time_in_cycles": cycle}
    row.update({c: float(value) for c in READINGS})
    row.update(extra)
    return row


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows):
        kinds = {"raw_id": "bigint", "source_file": "string", "engine_id": "int", "time_in_cycles": "int", "arrival_seq": "bigint"}
        names = list(rows[0])
        schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in names)
        return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schema)
    return frame
