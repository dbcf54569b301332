import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gearwatch.operators.membership import SET_BITS, buckets_for, build_filter, possible
from gearwatch.plans.store import Store
from gearwatch.schema import NATURAL_KEY
from conftest import reading

T1 = dt.datetime(2024, 3, 1, 7, 0)


def keys(spark, rows):
    return spark.createDataFrame(rows, "source_file string, engine_id int, time_in_cycles int")


def arrivals(rows):
    return [{**{k: v for k, v in r.items() if k != "raw_id"}, "arrival_seq": i} for i, r in enumerate(rows)]


def test_sizes():
    assert [buckets_for(n) for n in (0, 1, 2730, 2731, 5461, 5462, 10**12)] == [1, 1, 1, 2, 2, 4, 1 << 29]


def test_no_key_is_missed_and_few_are_wrong(spark):
    held = [("a", i, j) for i in range(60) for j in range(100)]
    other = [("b", i, j) for i in range(60) for j in range(100)]
    found = {}
    for name, rows, size in (("small", held[:50], 50), ("large", held[50:], 5950)):
        found[name] = build_filter(keys(spark, rows), NATURAL_KEY, size).withColumn("name", F.lit(name))
    filters = found["small"].unionByName(found["large"])
    assert {r.buckets for r in filters.collect()} == {1, 4}
    hits = possible(keys(spark, held + other), NATURAL_KEY, filters).collect()
    pairs = {(r.name, r.source_file, r.engine_id, r.time_in_cycles) for r in hits}
    assert pairs >= {("small" if n < 50 else "large", *k) for n, k in enumerate(held)}
    assert len(pairs) - len(held) < 120 and len(pairs) == len(hits)


def test_bits_of_a_key(spark):
    bits = build_filter(keys(spark, [("a", 1, 2)] * 3 + [("a", None, 2), (None, 1, 2), ("a", 1, None)]), NATURAL_KEY, 6).collect()
    assert len(bits) == 1 and sum(byte.bit_count() for byte in bits[0].bits) == SET_BITS
    assert possible(keys(spark, [(None, 1, 2), ("a", None, 2)]), NATURAL_KEY, build_filter(keys(spark, [("a", 1, 2)]), NATURAL_KEY, 1)).count() == 0
    nothing = build_filter(keys(spark, []), NATURAL_KEY, 0)
    assert nothing.count() == 0 and possible(keys(spark, [("a", 1, 2)]), NATURAL_KEY, nothing).count() == 0


@pytest.fixture()
def store(spark, tmp_path, make):
    store = Store(spark, str(tmp_path / "store")).create()
    store.ingest(make(arrivals([reading(None, e, c, c) for e in (1, 2) for c in (5, 6, 9)])), "one", T1)
    store.ingest(make(arrivals([reading(None, 3, c, c) for c in (5, 9)])), "two", T1)
    return store


def folders(frame):
    return {part for path in frame.inputFiles() for part in path.split("/") if part.startswith("ingest_id=") and "/raw/" in path}


def test_only_folders_that_may_hold_a_late_reading_are_opened(store, make):
    new = make([reading(7, 9, 1, 1), reading(8, 1, 10, 1)])
    assert not folders(store.absent(new)) and store.absent(new).count() == 2
    missed = make([reading(7, 1, 7, 1), reading(8, 3, 6, 1)])
    assert not folders(store.absent(missed)) and store.absent(missed).count() == 2
    held = make([reading(7, 1, 6, 1), reading(8, 3, 6, 1)])
    assert folders(store.absent(held)) == {"ingest_id=one"}
    assert [(r.engine_id, r.time_in_cycles) for r in store.absent(held).collect()] == [(3, 6)]


def test_ingests_without_a_filter_are_opened(spark, store, make, monkeypatch):
    monkeypatch.setattr("gearwatch.plans.store.build_filter", lambda rows, *_: spark.range(0).selectExpr("id AS buckets", "id AS bucket", "CAST(NULL AS BINARY) AS bits"))
    store.ingest(make(arrivals([reading(None, 4, c, c) for c in (5, 9)])), "three", T1)
    assert folders(store.absent(make([reading(7, 4, 7, 1)]))) == {"ingest_id=three"}
    assert store.absent(make([reading(7, 4, 5, 1)])).count() == 0


def test_random_arrivals_keep_each_reading_once(spark, tmp_path, make):
    rng, store, truth = random.Random(3), Store(spark, str(tmp_path / "mixed")).create(), {}
    for k in range(5):
        batch = [reading(None, rng.randrange(4), rng.randrange(30), 100 * k + n) for n in range(25)]
        for r in batch:
            truth.setdefault((r["engine_id"], r["time_in_cycles"]), r["s2"])
        store.ingest(make(arrivals(batch)), f"i{k}", T1)
    raw = store.raw().collect()
    assert {(r.engine_id, r.time_in_cycles): r.s2 for r in raw} == truth and len(raw) == len(truth)
    assert sorted(r.raw_id for r in raw) == list(range(1, len(raw) + 1))


def test_a_redelivery_searches_no_filter_for_all_rows(store, make, monkeypatch):
    from gearwatch.plans import store as module
    asked = []
    monkeypatch.setattr(module, "possible", lambda rows, keys, filters: asked.append(rows) or possible(rows, keys, filters))
    again = make([reading(7, e, c, 1) for e in (1, 2, 3) for c in (5, 9)])
    assert store.absent(again).count() == 0 and len(asked) == 1
    monkeypatch.setattr(module, "PROBE_ROWS", 1)
    asked.clear()
    assert store.absent(again).count() == 0 and len(asked) == 2
