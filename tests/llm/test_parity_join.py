import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearwatch.llm import components, parity_join
from tests.llm.helpers import corpus, odd_rows, prose, table, words


def plain(rows):
    """Components by comparing all pairs of texts."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        ws = words((text or "").translate(lower))
        sets.append({tuple(ws[i:i + 4]) for i in range(len(ws) - 3)} or ({tuple(ws)} if ws else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def families(seed):
    """Groups of near copies around the threshold, chains of small edits, short texts."""
    rng = random.Random(seed)
    texts = []
    for size in (3, 5, 8, 14, 30, 60, 150, 400):
        for _ in range(3):
            base = prose(size, rng.randrange(10**6))
            for copies in range(12):
                body = list(base)
                for _ in range(rng.randrange(0, 1 + max(1, size // 25))):
                    body[rng.randrange(len(body))] = f"e{rng.randrange(10**6)}"
                texts.append(" ".join(body[rng.randrange(2):]))
            for _ in range(8):  # a chain whose ends do not link
                base = list(base)
                base[rng.randrange(len(base))] = f"e{rng.randrange(10**6)}"
                texts.append(" ".join(base).upper())
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed, block, chained", [(1, 256, 1_000_000), (2, 4, 300)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, block, chained):
    monkeypatch.setattr(parity_join, "BLOCK", block)
    monkeypatch.setattr(parity_join, "CHAINED", chained)
    rows = odd_rows(corpus(seed) + families(seed))
    found = parity_join.report(table(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain(rows), key=repr)


def test_whole_small_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, parity_join.report(docs).collect())) == sorted(plain(rows))


def test_one_of_each(spark):
    base = " ".join(prose(120, 5))
    rows = [(9, base), (4, base + " end"), (4, base + " end"), (7, None), (8, ""), (8, ""), (None, "only one without id"), (None, "only one without id"), (None, "another without any id"), (2, "x y")]
    docs = table(spark, rows).selectExpr("*", "1 AS label", "2 AS packed", "3 AS component")
    found = parity_join.one_of_each(docs)
    assert found.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in found.collect()], key=repr) == sorted(
        [(4, base + " end"), (7, None), (8, ""), (8, ""), (None, "only one without id"), (None, "another without any id"), (2, "x y")], key=repr)


def test_empty_table(spark):
    docs = table(spark, ["x"]).limit(0)
    assert parity_join.report(docs).count() == parity_join.one_of_each(docs).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    path = [(k, k + 1) for k in range(0, 60)]
    star = [(1000, k) for k in range(1001, 1100)]
    links = [rng.sample(pair, 2) for pair in path + star + [(5000, 4000), (4000, 4000)]]
    found = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(61)}, **{k: 1000 for k in range(1000, 1100)}, 5000: 4000, 4000: 4000}


def test_linked_sets_share_a_band():
    import numpy as np
    rng = random.Random(4)
    for _ in range(300):
        size = rng.randrange(1, 400)
        a = np.unique(np.array([rng.randrange(2**63) for _ in range(size)], np.uint64))
        drop = rng.randrange(0, 1 + size // 12)
        b = np.unique(np.concatenate([a[drop:], np.array([rng.randrange(2**63) for _ in range(rng.randrange(0, 1 + size // 12))], np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            assert set(parity_join.band_keys(a).tolist()) & set(parity_join.band_keys(b).tolist())


def test_chained_rows_stay_in_order():
    """The rows of a text stay side by side, so that the shuffle of the bands compresses them."""
    rng = np.random.default_rng(5)
    nodes = np.repeat(rng.permutation(40), 25).astype(np.int64)
    keys = rng.integers(0, 300, len(nodes))
    key, a, b, same = parity_join.chained(keys, nodes)
    assert (key == keys).all() and (a == nodes).all()
    for k in np.unique(keys):
        here = sorted(nodes[keys == k])
        linked = sorted((x, y) for x, y, s in zip(a[key == k], b[key == k], same[key == k]) if s)
        assert linked == sorted(zip(here[1:], here)) and (key[~same] == k).sum() == 1


def test_packed_rows_come_back_and_stay_small():
    """Rows of few texts each, as behind many partitions: a row of its own took 36 bytes before compression."""
    rng = np.random.default_rng(6)
    nodes = np.repeat(rng.integers(-2**63, 2**63, 300), rng.integers(1, 4, 300))
    keys = rng.integers(0, 2**parity_join.KEY_BITS, len(nodes)).astype(np.uint64)
    keys[40:60] = keys[0]
    columns = parity_join.chained(keys, nodes)
    same = columns[3]
    own, texts, counts, links = parity_join.packed(*columns)
    assert (parity_join.from_planes(own, parity_join.KEY_BYTES) == keys[~same]).all()
    assert (np.repeat(np.frombuffer(texts, np.int64), parity_join.from_planes(counts, 4).astype(int)) == nodes[~same]).all()
    key, a, b = np.frombuffer(links, np.int64).reshape(3, -1)
    assert set(key) == {int(keys[0])} and len(key) == 20 and set(a) | set(b) <= set(nodes[keys == keys[0]])
    assert len(own + texts + counts) <= 18 * (~same).sum()
    for empty in (np.zeros(len(keys), bool), np.ones(len(keys), bool)):
        own, texts, counts, links = parity_join.packed(*columns[:3], empty)
        assert len(own) == parity_join.KEY_BYTES * (~empty).sum() and len(links) == 24 * empty.sum()


def test_written_tables_leave_no_shuffle_files(spark):
    """Shuffle files stayed until the driver collected its garbage, so a stage held those of all its steps."""
    from pathlib import Path

    from gearwatch.llm.common import written, written_by
    from gearwatch.session import FREE_SHUFFLES

    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    files = lambda: {p.name for folder in folders for p in Path(folder).rglob("shuffle_*.data")}
    setting, grouped = spark.conf.get(FREE_SHUFFLES), spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before = files()
    tables = [written(grouped, "test"), written_by(grouped, "k", "test")]
    assert files() <= before
    assert [t.count() for t in tables] == [10, 10] and spark.conf.get(FREE_SHUFFLES) == setting
    grouped.collect()
