import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gearwatch.llm import pfair_mix as M
from tests.llm.helpers import SCHEMA, corpus, odd_rows, table


def plain_schedule(slots):
    """Earliest deadline first, one slot after another."""
    period, done, plan = sum(slots), [0] * len(slots), []
    for t in range(period):
        ready = [(math.ceil((d + 1) * period / c), i) for i, (d, c) in enumerate(zip(done, slots)) if d * period // c <= t]
        plan.append(min(ready)[1])
        done[plan[-1]] += 1
    return plan


def sources(spark, sizes):
    rows = [(i, f"t{i}", "en", s, 2) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_schedule_equals_plain_one(spark):
    for slots in ([1], [3, 7], [250, 500, 250], [1, 1, 1, 1, 996], [7, 11, 13, 17, 52]):
        frame = spark.createDataFrame([(slots,)], "slots array<bigint>")
        assert frame.select(M.schedule(F.col("slots"), F.lit(sum(slots)).cast("long"))).first()[0] == plain_schedule(slots)


def test_deviation_stays_below_one_block(spark):
    sizes = {"big": 3000, "mid": 900, None: 300, "small": 170, "tiny": 9}
    rows = M.report(sources(spark, sizes)).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == len({r.position for r in rows}) == sum(sizes.values())
    size = {s: int(math.sqrt(n) * 1000) for s, n in sizes.items()}
    slots = {s: max(1, 1000 * n // sum(size.values())) for s, n in size.items()}
    period, blocks = sum(slots.values()), {}
    for r in rows:
        assert r.release <= r.slot < r.deadline
        assert blocks.setdefault((r.source, r.block), r.slot) == r.slot
    by_slot = {slot: source for (source, _), slot in blocks.items()}
    assert len(by_slot) == len(blocks)
    horizon = max(r.slot for r in rows if r.in_mix) + 1
    given = Counter()
    for t in range(horizon):
        given[by_slot[t]] += 1
        assert all(abs(given[s] - (t + 1) * c / period) < 1 for s, c in slots.items())
    assert horizon not in by_slot or any(not r.in_mix for r in rows)


def test_given_weights(spark):
    rows = M.report(sources(spark, {"a": 800, "b": 800, "c": 80}), {"a": 0.7, "b": 0.2, "c": 0.1, "other": 0.0}).collect()
    first = Counter(r.source for r in rows if r.slot < 50)
    assert first == {"a": 280, "b": 80, "c": 40}


def test_numbers_follow_ids_however_far_apart(spark):
    docs = table(spark, odd_rows(corpus(8)) + [(9 * 10**18, "the highest"), (-9 * 10**18, "the lowest"), (2**62, "between")])
    assert sorted(map(tuple, M.report(docs).collect()), key=repr) == sorted(map(tuple, M.report(docs.repartition(60)).collect()), key=repr)
    by_source = defaultdict(list)
    for r in M.placed(docs).collect():
        by_source[r.source].append(((r.doc_id is None, r.doc_id), r._position))
    for found in by_source.values():
        assert [d for d, _ in sorted(found, key=lambda x: x[1])] == sorted(d for d, _ in found)


def test_ordered_rows_keep_all_columns(spark):
    docs = table(spark, odd_rows(corpus(9))).selectExpr("*", "doc_id AS _block", "text AS row", "1 AS _key")
    ordered = M.in_schedule_order(docs)
    assert ordered.columns == docs.columns
    assert sorted(map(tuple, ordered.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    assert M.report(docs.limit(0)).count() == M.in_schedule_order(docs.limit(0)).count() == 0
