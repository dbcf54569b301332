import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearwatch.functions.messages import accepted, encode_messages, parse_messages
from gearwatch.operators.profile import order_statistics
from gearwatch.operators.selection import engine_filter, engine_ranges, nth_smallest, row_slice
from gearwatch.operators.skew import broadcast_if_small
from gearwatch.schema import READINGS, TEXT_COLUMNS
from gearwatch.sources import files, kafka


def test_row_slice_is_one_based(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "value")
    def taken(*args):
        return sorted(r.value for r in row_slice(df, "value", *args).collect())
    assert taken(4, 3) == [4, 5, 6]
    assert taken(8) == [8, 9, 10]
    assert taken(9, 50) == [9, 10]
    assert taken(11, 5) == [] and taken(1, 0) == []
    with pytest.raises(ValueError):
        row_slice(df, "value", 0, 1)
    with pytest.raises(ValueError):
        row_slice(df, "value", 1, -1)


def test_nth_smallest_over_wide_ranges(spark):
    rng = random.Random(3)
    numbers = [rng.randint(0, 2 ** 62) for _ in range(300)] + [5] * 40 + [-7]
    df = spark.createDataFrame([(n,) for n in numbers], "v bigint")
    for n in (1, 2, 20, 41, 42, 170, 341):
        assert nth_smallest(df, "v", n) == sorted(numbers)[n - 1]
    assert nth_smallest(df, "v", 342) is None


def test_order_statistics_are_exact(spark):
    rng = random.Random(4)
    a = [rng.gauss(0, 1e6) for _ in range(400)] + [1e308, -1e308]
    b = [float(rng.randint(0, 5)) for _ in range(402)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    places = [1, 2, 100, 201, 401, 402]
    found = order_statistics(df, {"a": places, "b": places})
    for n in places:
        assert found[("a", n)] == sorted(a)[n - 1]
        assert found[("b", n)] == sorted(b)[n - 1]


@pytest.mark.parametrize("text,ranges", [("", None), ("  ", None), ("47", [(47, 47)]), ("40-90", [(40, 90)]), ("90-40, 3", [(40, 90), (3, 3)]),
                                         ("-5", []), ("1-2-3", []), ("x,", []), ("1, x-3, 5 - 7", [(1, 1), (5, 7)])])
def test_engine_ranges(text, ranges):
    assert engine_ranges(text) == ranges


def test_engine_filter(spark):
    df = spark.range(100)
    assert df.filter(engine_filter(F.col("id"), "")).count() == 100
    assert df.filter(engine_filter(F.col("id"), "x")).count() == 0
    assert df.filter(engine_filter(F.col("id"), "10-5, 50")).count() == 7


def test_broadcast_check(spark):
    assert broadcast_if_small(spark.range(10), 10)[1] is True
    assert broadcast_if_small(spark.range(11), 10)[1] is False


def line(engine, cycle):
    return " ".join([str(engine), str(cycle), *[f"{engine + i / 10}" for i in range(24)]])


def test_text_source(spark, tmp_path):
    path = tmp_path / "FD001.txt"
    path.write_text(line(1, 1) + "  \n\n   \n" + line(1, 2).replace(" ", "   ") + " \n2 7 bad\n")
    rows = files.read_text_telemetry(spark, str(path)).orderBy("engine_id", "time_in_cycles").collect()
    assert [(r.source_file, r.engine_id, r.time_in_cycles, r.s21) for r in rows] == [
        ("FD001", 1, 1, 1 + 23 / 10), ("FD001", 1, 2, 1 + 23 / 10), ("FD001", 2, 7, None)]
    assert rows[2].op_setting_1 is None


def test_line_numbers_over_many_splits(spark, tmp_path):
    path = tmp_path / "FD002.txt"
    path.write_text("".join(line(i // 50, i) + ("\n\n" if i % 7 == 0 else "\n") for i in range(1, 401)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = files.numbered_lines(spark, str(path))
        assert rows.rdd.getNumPartitions() > 1
        assert all(r.line == r.time_in_cycles for r in rows.collect())
        got = sorted(r.time_in_cycles for r in files.replay_lines(spark, str(path), 101, 50).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(range(101, 151))
    with pytest.raises(ValueError):
        files.replay_lines(spark, str(path), 0)


def test_csv_keeps_empty_text_and_null_apart(spark, tmp_path):
    df = spark.createDataFrame([(2, "", 1.5), (1, None, None), (3, 'a "b", c', 2.0)], "id int, t string, v double")
    path = str(tmp_path / "out")
    assert files.export_csv(df, path) == 3
    back = files.read_csv(spark, path, df.schema)
    assert [(r.id, r.v) for r in back.orderBy("id").collect()] == [(1, None), (2, 1.5), (3, 2.0)]
    assert back.filter("id = 3").first().t == 'a "b", c'
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part"))
    first = parts[0].read_text().splitlines()
    assert first[0] == "id,t,v" and first[1].startswith("1,")
    inferred = files.read_csv(spark, path)
    assert dict(inferred.dtypes)["v"] == "double"


def test_missing_table(spark, tmp_path):
    assert not files.table_exists(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, str(tmp_path / "none"))
    spark.range(3).write.parquet(str(tmp_path / "some"))
    assert files.table_columns(spark, str(tmp_path / "some")) == ["id"]


def test_dataset_paths():
    assert files.dataset_path("fd003", folder="/d") == "/d/train_FD003.txt"
    assert files.dataset_path("fd003", any_path="/any.txt") == "/any.txt"
    assert files.dataset_path("fd003", {"FD003": "/own.txt"}, "/any.txt") == "/own.txt"


def test_union_of_exports(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    assert sorted((r.x, r.y) for r in files.union_exports([a, b]).collect()) == [(1, 2), (4, 3)]


def test_broker_options(spark):
    source = kafka.source_options("h:1", "t", 500)
    assert source["startingOffsets"] == "earliest" and source["maxOffsetsPerTrigger"] == "500"
    assert kafka.sink_options("h:1", "t")["kafka.acks"] == "all"
    records = spark.createDataFrame([(p, o, bytearray(b"{}")) for p in range(3) for o in range(4)], "partition int, offset bigint, value binary")
    assert kafka.as_arrivals(records).select("arrival_seq", "arrival_part").distinct().count() == 12


BODIES = [
    ('{"engine_id": 3.7, "time_in_cycles": " 4 ", "s2": 1e3, "source_file": "", "source": "B"}', ("B", 3, 4, 1000.0, None)),
    ("xx", ("UNKNOWN", None, None, None, "bad_json")),
    (None, ("UNKNOWN", None, None, None, "bad_json")),
    ("[1]", ("UNKNOWN", None, None, None, "not_object")),
    ("5", ("UNKNOWN", None, None, None, "not_object")),
    ('{"time_in_cycles": 4}', ("UNKNOWN", None, 4, None, "bad_engine")),
    ('{"engine_id": "3.7", "time_in_cycles": 4}', ("UNKNOWN", None, 4, None, "bad_engine")),
    ('{"engine_id": true, "time_in_cycles": 4}', ("UNKNOWN", 1, 4, None, None)),
    ('{"engine_id": "true", "time_in_cycles": 4}', ("UNKNOWN", None, 4, None, "bad_engine")),
    ('{"engine_id": 1, "time_in_cycles": 3000000000}', ("UNKNOWN", 1, None, None, "bad_cycle")),
    ('{"engine_id": 1, "time_in_cycles": 5, "s2": "5d"}', ("UNKNOWN", 1, 5, None, "bad_sensor")),
    ('{"engine_id": 1, "time_in_cycles": 5, "s2": true}', ("UNKNOWN", 1, 5, None, "bad_sensor")),
    ('{"engine_id": 1, "time_in_cycles": 5, "s2": {"a": 1}}', ("UNKNOWN", 1, 5, None, "bad_sensor")),
    ('{"engine_id": 1, "time_in_cycles": 5, "s2": " -2.5 ", "s3": null}', ("UNKNOWN", 1, 5, -2.5, None)),
    ('{"engine_id": 1, "time_in_cycles": 5, "source": 7, "source_file": 0}', ("7", 1, 5, None, None)),
    ('{"engine_id": 1, "time_in_cycles": 5, "source_file": false, "source": true}', ("True", 1, 5, None, None)),
    ('{"engine_id": 1, "time_in_cycles": 5, "source_file": "false"}', ("false", 1, 5, None, None)),
    ('\n {"engine_id": 1, "time_in_cycles": 5, "extra": [1, 2]}', ("UNKNOWN", 1, 5, None, None)),
]


def test_message_parsing(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], "arrival_seq bigint, body string")
    rows = parse_messages(df).orderBy("arrival_seq").collect()
    for row, (body, expected) in zip(rows, BODIES):
        assert (row.source_file, row.engine_id, row.time_in_cycles, row.s2, row.reject_reason) == expected, body


def test_message_encoding(spark):
    df = spark.createDataFrame([("x", 7, 9, float("nan"), 1.5)], "source_file string, engine_id int, time_in_cycles int, s1 double, s2 double")
    row = encode_messages(df, "fd001").first()
    assert row.key == "FD001:7:9"
    assert '"s1":null' in row.value and '"s2":1.5' in row.value and '"source":"FD001"' in row.value
    assert row.value.index('"engine_id"') < row.value.index('"s21"') < row.value.index('"source_file"')
    back = accepted(parse_messages(encode_messages(df).select(F.lit(1).alias("arrival_seq"), F.col("value").alias("body")))).first()
    assert back.s1 is None and back.s2 == 1.5 and math.isclose(back.engine_id, 7)
    assert set(READINGS) < set(TEXT_COLUMNS)


def test_csv_brings_any_text_back(spark, tmp_path):
    texts = ["", None, " ", "a\nb", "a\r\nb\r", "\\N", "\\n", "\\_", "\\", 'say "x", y', ",", '"', '""', "\ttab ", "ñ 🙂", "null", "#", "a\\\nb"]
    df = spark.createDataFrame([(i, t, None if i % 3 else i / 7) for i, t in enumerate(texts)], "id int, t string, v double")
    path = str(tmp_path / "texts")
    assert files.export_csv(df, path) == len(texts)
    assert sorted(files.read_csv(spark, path, df.schema).collect()) == sorted(df.collect())
    assert [r.t for r in files.read_csv(spark, path, infer=False).orderBy(F.col("id").cast("int")).collect()] == texts


def test_profile_of_extreme_values(spark, monkeypatch):
    from gearwatch.operators import profile
    rng = np.random.default_rng(2)
    values = [float(v) for v in np.concatenate([10.0 ** rng.uniform(-200, 200, 300), -(10.0 ** rng.uniform(-300, 300, 300)), [0.0] * 50, [np.inf] * 4, [-np.inf] * 3])]
    frame = spark.createDataFrame([(v, float(i % 7), None) for i, v in enumerate(values)], "a double, b double, c double").repartition(3)
    wanted = {"a": [1, 3, 4, 100, 300, 340, 500, 653, 654, 657], "b": [1, 200, 657], "c": [1]}
    truth = {"a": sorted(values), "b": sorted(float(i % 7) for i in range(len(values)))}
    for gathered in (4096, 5):
        monkeypatch.setattr(profile, "GATHERED", gathered)
        found = profile.order_statistics(frame, wanted)
        assert found == {(c, n): truth[c][n - 1] for c in "ab" for n in wanted[c]}
    row = profile.column_profile(frame.select("a"), ["a"]).first()
    assert (row.min, row.max, row.q50) == (-np.inf, np.inf, float(np.median(values)))


@pytest.mark.parametrize("values", [[1.0] * 50 + [2.0] * 50, [2.0] * 101, [0.0] * 90 + [float(i) for i in range(10)], [float(i // 25) for i in range(100)], [-np.inf] * 30 + [np.inf] * 30])
def test_ranks_at_the_border_of_equal_values(spark, monkeypatch, values):
    from gearwatch.operators import profile
    monkeypatch.setattr(profile, "GATHERED", 2)
    wanted = [1, 2, len(values) // 4, len(values) // 2, len(values) // 2 + 1, len(values) - 1, len(values)]
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert profile.order_statistics(frame, {"v": wanted}) == {("v", n): sorted(values)[n - 1] for n in wanted}
