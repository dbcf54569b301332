"""Boosted trees against a plain exact version over the same bins."""

import math

import numpy as np
import pytest

from gearwatch.operators import boosting, ml
from gearwatch.operators.boosting import Settings


def plain_tree(bins, g, h, settings, node=0, depth=0, found=None):
    """(feature, cut bin, missing left) or leaf value by node, trying every cut."""
    found = {} if found is None else found
    total_g, total_h = g.sum(), h.sum()

    def score(a, b):
        return (a / boosting.UNIT) ** 2 / (b / boosting.UNIT + settings.l2)

    best = None
    for f in range(bins.shape[1] if depth < settings.depth else 0):
        for cut in sorted(set(bins[:, f]) - {0}):
            for missing_left in (True, False):
                left = np.where(bins[:, f] == 0, missing_left, bins[:, f] <= cut)
                if left.all() or not left.any() or (not missing_left and not (bins[:, f] == 0).any()):
                    continue
                lg, lh = g[left].sum(), h[left].sum()
                if min(lh, total_h - lh) < settings.least_hessian * boosting.UNIT:
                    continue
                gain = score(lg, lh) + score(total_g - lg, total_h - lh) - score(total_g, total_h)
                if gain > settings.least_gain:
                    best = max(best or (-1,), (gain, missing_left, -f, -int(cut), left.tolist()))
    if best is None:
        found[node] = -settings.rate * (total_g / boosting.UNIT) / (total_h / boosting.UNIT + settings.l2)
        return found
    _, missing_left, f, cut, left = best
    left = np.array(left)
    found[node] = (-f, -cut, missing_left)
    plain_tree(bins[left], g[left], h[left], settings, 2 * node + 1, depth + 1, found)
    plain_tree(bins[~left], g[~left], h[~left], settings, 2 * node + 2, depth + 1, found)
    return found


def table(spark, count, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(count):
        a, b, c = rng.normal(), float(rng.integers(0, 5)), rng.normal()
        y = int(a * (1 if b > 2 else -1) + 0.3 * c + 0.3 * rng.normal() > 0)
        rows.append((y, None if rng.random() < 0.2 else a, b, float("nan") if rng.random() < 0.1 else c, 3.0))
    return spark.createDataFrame(rows, "label int, a double, b double, c double, same double").repartition(5), rows


@pytest.mark.parametrize("settings", [Settings(rounds=3, depth=3), Settings(rounds=1, depth=4, l2=0.0, least_hessian=0.0, rate=1.0), Settings(rounds=1, depth=2, least_gain=3.0)])
def test_trees_equal_a_plain_version(spark, monkeypatch, settings):
    monkeypatch.setattr(boosting, "KEEP_TREES", 2)
    names = ["a", "b", "c", "same"]
    df, rows = table(spark, 400, settings.depth)
    cuts = [[-1.0, -0.5, 0.0, 0.5, 1.0], [0.5, 1.5, 2.5, 3.5], [-1.0, 0.0, 1.0], []]
    model = boosting.fit(df, names, settings=settings, cuts=cuts)
    values = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows])
    y, bins = np.array([r[0] for r in rows], float), model.binned(list(values.T))
    margin = np.zeros(len(rows))
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        wanted = plain_tree(bins, np.rint((p - y) * boosting.UNIT), np.rint(p * (1 - p) * boosting.UNIT), settings)
        for node, expected in wanted.items():
            if isinstance(expected, tuple):
                assert (tree.feature[node], tree.cut[node], bool(tree.missing_left[node])) == expected
            else:
                assert tree.feature[node] == -1 and tree.value[node] == pytest.approx(expected, abs=1e-12)
        margin = margin + tree.value[tree.places(bins, settings.depth)]
    assert len(model.trees) == settings.rounds


def test_fit_learns_and_scores_as_a_foreign_model(spark):
    names = ["a", "b", "c"]
    df, _ = table(spark, 1500, 5)
    test, rows = table(spark, 600, 6)
    model = boosting.fit(df, names, settings=Settings(rounds=12, depth=4, bins=32))
    frame = test.toPandas()
    right = ((model.predict_proba(frame[names])[:, 1] > 0.5) == (frame["label"] == 1)).mean()
    assert right > 0.8
    keyed = test.selectExpr("1L AS raw_id", "'x' AS source_file", "1 AS engine_id", "2 AS time_in_cycles", *names)
    assert {r.risk_score is not None for r in ml.predict_foreign(model, keyed, names).collect()} == {True}
    assert all(len(c) <= 31 for c in model.cuts)


def test_nodes_give_values_and_missing_side(spark):
    rows = [(0, 1.0)] * 10 + [(1, 5.0)] * 10 + [(1, None)] * 10
    df = spark.createDataFrame(rows, "label int, a double")
    model = boosting.fit(df, ["a"], settings=Settings(rounds=1, depth=1), cuts=[[2.0, 7.0]])
    root, left, right = model.nodes(spark).orderBy("node").collect()
    assert (root.feature, root.cut, root.missing_left) == ("a", 2.0, False) and left.value < 0 < right.value
    present = spark.createDataFrame([(0, 1.0)] * 10 + [(1, None)] * 10, "label int, a double")
    root = boosting.fit(present, ["a"], settings=Settings(rounds=1, depth=1), cuts=[[2.0]]).nodes(spark).orderBy("node").first()
    assert (root.feature, root.missing_left) == ("a", False)  # only present against missing


def test_one_class_empty_tables_and_unlabelled_rows(spark):
    schema = "label int, a double"
    one = boosting.fit(spark.createDataFrame([(1, float(i)) for i in range(30)], schema), ["a"], settings=Settings(rounds=2, depth=3))
    assert all((t.feature == -1).all() for t in one.trees) and one.trees[0].value[0] > 0
    none = boosting.fit(spark.createDataFrame([], schema), ["a"], settings=Settings(rounds=2, depth=3))
    assert none.predict_proba(spark.createDataFrame([(1.0,)], "a double").toPandas())[0, 1] == 0.5
    unlabelled = boosting.fit(spark.createDataFrame([(None, 9.0), (1, 1.0)], schema), ["a"], settings=Settings(rounds=1, depth=1))
    assert unlabelled.trees[0].value[0] == pytest.approx(0.3 * 0.5 / 1.25)
    with pytest.raises(ValueError, match="at least one input"):
        boosting.fit(spark.createDataFrame([], schema), [])
    assert math.isinf(boosting.BoostedTrees(["a"], [np.array([1.0])], 0.0, 1, [boosting.Tree(np.array([0, -1, -1]), np.array([2, 0, 0]), np.ones(3, bool), np.zeros(3))]).nodes(spark).first().cut)


def test_a_batch_is_counted_in_one_go(spark, monkeypatch):
    """The cost of a batch does not grow with inputs x cells: one run along the cells for each sum, not one for each input."""
    names, calls = [f"x{i}" for i in range(12)], []
    rows = [(i % 2, *[float((i * (k + 3)) % 17) for k in range(12)]) for i in range(60)]
    df = spark.createDataFrame(rows, "label int, " + ", ".join(f"{n} double" for n in names)).coalesce(1)
    model = boosting.BoostedTrees(names, [np.arange(16.0)] * 12, 0.0, 2)
    binned = boosting._binned_rows(df, model, "label")
    taken = []
    monkeypatch.setattr(binned.__class__, "mapInArrow", lambda self, function, schema: taken.append(function) or self)
    monkeypatch.setattr(binned.__class__, "groupBy", lambda self, *keys: self)
    monkeypatch.setattr(binned.__class__, "agg", lambda self, *sums: self)
    boosting.histograms(binned, model, [], boosting.Tree.blank(2), 0)
    monkeypatch.undo()
    batch = binned.toArrow().to_batches()[0]
    plain = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or plain(*a, **k))
    cells = list(taken[0](iter([batch])))
    assert len(calls) == 3 and sum(cells[0]["n"].to_pylist()) == 60 * 12


def test_one_side_of_a_cut_is_counted_and_sums_take_either_way(spark, monkeypatch):
    """Every node of a level was counted, and a task sent a row for each (node, input, bin)."""
    names, cuts = ["a", "b", "c", "same"], [[-1.0, -0.5, 0.0, 0.5, 1.0], [0.5, 1.5, 2.5, 3.5], [-1.0, 0.0, 1.0], []]
    df, _ = table(spark, 400, 7)
    settings, counted, plain, trees = Settings(rounds=2, depth=3), [], boosting.level_sums, []
    monkeypatch.setattr(boosting, "level_sums", lambda *a: counted.append(a[-1]) or plain(*a))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    for most in (1 << 30, 0):
        monkeypatch.setattr(boosting, "TO_DRIVER", most)
        trees.append(boosting.fit(df, names, settings=settings, cuts=cuts).trees)
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive
    for one, other in zip(*trees):
        assert (one.feature == other.feature).all() and (one.cut == other.cut).all() and (one.value == other.value).all()
    below = [nodes for nodes in counted if nodes != [0]]
    assert below and all(len({(n - 1) // 2 for n in nodes}) == len(nodes) for nodes in below)
    assert any(len(nodes) > 1 for nodes in below)
    model = boosting.BoostedTrees(names, [np.array(c) for c in cuts], 0.0, 3)
    binned = boosting._binned_rows(df, model, "label")
    rows = boosting.histograms(binned, model, [], boosting.Tree.blank(3), 0).collect()
    assert len(rows) == 4 * binned.rdd.getNumPartitions() and sum(r.n for r in rows) == 400 * 4
