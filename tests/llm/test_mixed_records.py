"""The mix in the rows that the pipeline returns."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gearwatch.llm import pfair_mix
from tests.llm.helpers import SCHEMA


def assert_mixed(rows):
    """Every prefix of positions inside the horizon meets the root weights to within a block."""
    counts = Counter(r.source for r in rows)
    size = {s: int(math.sqrt(n) * 1000) for s, n in counts.items()}
    slots = {s: max(1, 1000 * n // sum(size.values())) for s, n in size.items()}
    period, block = sum(slots.values()), pfair_mix.BLOCK_DOCS
    assert len({r.position for r in rows}) == len(rows)
    inside = sorted((r for r in rows if r.in_mix), key=lambda r: r.position)
    horizon = inside[-1].position // block + 1
    assert len(inside) > 2 * block and all(r.position // block >= horizon for r in rows if not r.in_mix)
    by_slot = {}
    for r in inside:
        assert by_slot.setdefault(r.position // block, r.source) == r.source
    assert sorted(by_slot) == list(range(horizon))
    given = Counter()
    for t in range(horizon):
        given[by_slot[t]] += 1
        assert all(abs(given[s] - (t + 1) * c / period) < 1 for s, c in slots.items())
    return counts, Counter(r.source for r in inside)


def test_run_returns_the_mix(spark, folder):
    assert_mixed(corpus_pipeline.run(spark, folder).collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_mix_does_not_depend_on_the_order_of_files(spark, folder, parts):
    sizes = {"big": 1600, "mid": 500, "small": 300}
    rows = [(i, f"text {i}", "en", s, 6) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, SCHEMA).orderBy(F.xxhash64(F.lit(parts), "doc_id")).repartition(parts)
    found = corpus_pipeline.tokens(spark, docs, folder).collect()
    counts, inside = assert_mixed(found)
    assert counts == sizes and inside["big"] / inside.total() < 0.95 * sizes["big"] / sum(sizes.values())
    place = {r.doc_id: (r._position, r._in_mix) for r in pfair_mix.placed(docs).collect()}
    assert {r.doc_id: (r.position, r.in_mix) for r in found} == place


def test_records_follow_the_slots_of_the_mixing_stage(spark, folder, tmp_path):
    """What the mixing stage decides places the records, also behind files read in another order."""
    rows = [(i, f"text {i}", "en", s, 6) for i, s in enumerate(s for s, n in {"a": 400, "b": 400, None: 80}.items() for _ in range(n))]
    docs, weights = spark.createDataFrame(rows, SCHEMA), {"a": 0.7, "b": 0.2}
    mixed = pfair_mix.in_schedule_order(docs, weights)
    assert mixed.columns == docs.columns
    mixed.write.parquet(f"{tmp_path}/mixed")
    read = spark.read.parquet(f"{tmp_path}/mixed").repartition(5)
    found = corpus_pipeline.tokens(spark, read, folder).collect()
    place = {r.doc_id: (r._position, r._in_mix) for r in pfair_mix.placed(docs, weights).collect()}
    assert {r.doc_id: (r.position, r.in_mix) for r in found} == place
    assert place != {r.doc_id: (r._position, r._in_mix) for r in pfair_mix.placed(docs).collect()}
    inside = Counter(r.source for r in found if r.position < 400)
    assert abs(inside["a"] - 400 * 7 / 9) < pfair_mix.BLOCK_DOCS
