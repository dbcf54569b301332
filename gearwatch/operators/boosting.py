"""Second-order boosted trees for a 0/1 label, grown level by level from sums over quantile bins.

Every input is cut into bins once and the binned rows are written. A level of a tree is one pass: each
task adds up gradients and hessians per (node, input, bin) of its rows and sends one row of sums for an input;
these are added up, by input first where they are many, and reach the driver, where running sums along the bins give the gain of every cut,

    G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2) - G^2 / (H + l2),

with the rows that lack the value tried on both sides. What a task sends and what the driver gets is
bounded by nodes x inputs x bins (4 MB for the last level of depth 6 over 41 inputs), or by ``TO_DRIVER`` if that is
more, however many rows there are. Of the two sides of a cut only the one of fewer rows is counted; the other one's sums are what is
left of their parent's. Every ``KEEP_TREES`` trees the rows are written with their margin, so a pass adds
up few trees and a lost executor costs one pass.

Gradients are summed as whole numbers of 2^-24, so neither the order of rows nor retried tasks change a
tree. Of equal gains the cut with values missing on the left wins, then the lowest input, then the lowest bin.

Defined cases: null and NaN are missing values; where no row of a node lacks the value, missing values go left.
Without a cut of positive gain the node is a leaf, so a table without rows, or with one class, gives
trees of one leaf. Rows without a label are left out.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from gearwatch.session import scratch_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

#: A gradient or hessian of 1.
UNIT = 1 << 24
#: Trees after which rows are written with their margin: each takes every row down once more at every level until then.
KEEP_TREES = 4
#: Bytes of sums that the tasks of a pass send to the driver at most; more are added up by input in a second stage.
TO_DRIVER = 32 << 20
#: Most cuts that an input may have, so that a bin and the missing one fit two bytes.
MOST_CUTS = 60_000


@dataclass
class Settings:
    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    l2: float = 1.0
    least_gain: float = 0.0
    least_hessian: float = 1.0
    bins: int = 256
    base_score: float = 0.5


@dataclass
class Tree:
    """Nodes in heap order: node n has the children 2n + 1 and 2n + 2; ``feature`` is -1 at a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def blank(depth: int) -> "Tree":
        size = 2 ** (depth + 1) - 1
        return Tree(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.ones(size, bool), np.zeros(size))

    def places(self, bins: np.ndarray, steps: int) -> np.ndarray:
        """Node of every row after ``steps`` levels; rows stay at leaves. Bin 0 is a missing value."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(steps):
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                break
            node = at[inner]
            seen = bins[inner, feature[inner]]
            left = np.where(seen == 0, self.missing_left[node], seen <= self.cut[node])
            at[inner] = 2 * node + np.where(left, 1, 2)
        return at


@dataclass
class BoostedTrees:
    """A fitted model; ``predict_proba`` makes it usable wherever a foreign classifier is."""

    names: list[str]
    cuts: list[np.ndarray]
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)
    classes_ = (0, 1)

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bin of every value: 0 if missing, else 1 + the number of cuts below it."""
        found = np.zeros((len(columns[0]) if columns else 0, len(columns)), np.uint16)
        for i, (values, cuts) in enumerate(zip(columns, self.cuts)):
            found[:, i] = np.where(np.isnan(values), 0, 1 + np.searchsorted(cuts, values, side="left"))
        return found

    def margin(self, bins: np.ndarray, trees: list[Tree] | None = None) -> np.ndarray:
        total = np.zeros(len(bins))
        for tree in self.trees if trees is None else trees:
            total += tree.value[tree.places(bins, self.depth)]
        return total

    def predict_proba(self, frame) -> np.ndarray:
        bins = self.binned([frame[name].to_numpy(float, na_value=np.nan) for name in self.names])
        chance = 1 / (1 + np.exp(-(self.base + self.margin(bins))))
        return np.column_stack([1 - chance, chance])

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, cut, missing_left, value) of all nodes in use; ``cut`` is the largest value that goes left."""
        rows = []
        for number, tree in enumerate(self.trees):
            used = {0}
            for n in range(len(tree.feature)):
                if n in used:
                    f = int(tree.feature[n])
                    used |= {2 * n + 1, 2 * n + 2} if f >= 0 else set()
                    # The cut behind the last bin of present values parts them from the missing ones.
                    place = int(tree.cut[n]) - 1
                    bound = None if f < 0 else float(self.cuts[f][place]) if place < len(self.cuts[f]) else math.inf
                    rows.append((number, n, self.names[f] if f >= 0 else None, bound, bool(tree.missing_left[n]) if f >= 0 else None, float(tree.value[n]) if f < 0 else None))
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut double, missing_left boolean, value double")


def quantile_cuts(rows: DataFrame, names: list[str], bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 cuts per input, from mergeable quantile sketches; one row reaches the driver."""
    shares = [i / bins for i in range(1, bins)]
    present = [F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double")) for n in names]
    found = rows.agg(*[F.percentile_approx(p, shares, 10_000) for p in present]).first()
    return [np.unique(np.array(values or [], float)) for values in found]


def _binned_rows(rows: DataFrame, model: BoostedTrees, label: str) -> DataFrame:
    """(label, bins, margin) of the labelled rows, written; a row has two bytes per input."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.binned([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float) for i in range(len(model.names))])
            yield pa.record_batch([batch.column(0), pa.array([r.tobytes() for r in bins], pa.binary()), pa.array(np.full(len(bins), model.base))], ["label", "bins", "margin"])

    inputs = rows.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), *[F.col(n).cast("double").alias(f"f{i}") for i, n in enumerate(model.names)])
    return _kept(inputs.mapInArrow(pack, "label double, bins binary, margin double"))


def _kept(df: DataFrame) -> DataFrame:
    path = scratch_folder(df.sparkSession, "boosting")
    df.write.parquet(path)
    return df.sparkSession.read.schema("label double, bins binary, margin double").parquet(path)


def _unpacked(batch: pa.RecordBatch, width: int) -> np.ndarray:
    # Rows have one length, so their bytes lie side by side in the column's buffer.
    _, starts, content = batch["bins"].cast(pa.large_binary()).buffers()
    first = int(np.frombuffer(starts, np.int64, 1, 8 * batch["bins"].offset)[0]) if batch.num_rows else 0
    return np.frombuffer(content or b"", np.uint16, batch.num_rows * width, first).reshape(batch.num_rows, width)


def _with_margin(binned: DataFrame, model: BoostedTrees, trees: list[Tree]) -> DataFrame:
    """The rows with the margin that ``trees`` add, written."""
    width = len(model.names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = batch["margin"].to_numpy() + model.margin(_unpacked(batch, width), trees)
            yield pa.record_batch([batch["label"], batch["bins"], pa.array(margin)], ["label", "bins", "margin"])

    return _kept(binned.mapInArrow(add, "label double, bins binary, margin double"))


def histograms(binned: DataFrame, model: BoostedTrees, recent: list[Tree], tree: Tree, level: int, nodes: list[int] | None = None) -> DataFrame:
    """(feature, sums): g, h and n over a task's rows by (sum, node, bin) for ``nodes`` of a level, by default all, as bytes of longs."""
    width, size = len(model.names), max(len(c) for c in model.cuts) + 2
    first = 2 ** level - 1
    nodes = list(range(first, 2 * first + 1)) if nodes is None else nodes
    count, slot = len(nodes), np.full(2 * first + 1, -1)
    slot[nodes] = np.arange(count)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, count * width * size), np.int64)
        for batch in batches:
            bins = _unpacked(batch, width)
            own = slot[tree.places(bins, level)]
            mine = np.flatnonzero(own >= 0)
            if not len(mine):
                continue
            bins, y = bins[mine], batch["label"].to_numpy()[mine]
            chance = 1 / (1 + np.exp(-(batch["margin"].to_numpy()[mine] + model.margin(bins, recent))))
            parts = np.rint((chance - y) * UNIT), np.rint(chance * (1 - chance) * UNIT)
            # Weights are whole numbers and a batch has few rows, so its sums are exact. All inputs are
            # counted at once: the cost of a batch is its values and one run along the cells.
            cell = ((own[mine] * width)[:, None] + np.arange(width)) * size + bins
            cell = cell.ravel()
            for k in (0, 1):
                sums[k] += np.bincount(cell, weights=np.repeat(parts[k], width), minlength=sums.shape[1]).astype(np.int64)
            sums[2] += np.bincount(cell, minlength=sums.shape[1])
        if sums[2].any():
            by_input = sums.reshape(3, count, width, size)
            yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array([by_input[:, :, f].tobytes() for f in range(width)], pa.binary()),
                                   pa.array(by_input[2].sum(axis=(0, 2)))], ["feature", "sums", "n"])

    return binned.mapInArrow(add_up, "feature int, sums binary, n long")


def added_up(sums: DataFrame, parts: int) -> DataFrame:
    """(feature, sums) over all tasks: one row for an input."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for feature, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(content.as_buffer(), np.int64)
                total[feature] = own + total.get(feature, 0)
        for feature, own in total.items():
            yield pa.record_batch([pa.array([feature], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["feature", "sums"])

    return sums.select("feature", "sums").repartition(parts, "feature").mapInArrow(combine, "feature int, sums binary")


def level_sums(binned: DataFrame, tasks: int, model: BoostedTrees, recent: list[Tree], tree: Tree, level: int, nodes: list[int]) -> dict[int, np.ndarray]:
    """Sums [g, h, n] by input and bin of every one of ``nodes``, from rows in ``tasks`` partitions."""
    width, size = len(model.names), max(len(c) for c in model.cuts) + 2
    found = np.zeros((len(nodes), 3, width, size), np.int64)
    sums = histograms(binned, model, recent, tree, level, nodes)
    if tasks * found.nbytes > TO_DRIVER:
        sums = added_up(sums, min(width, binned.sparkSession.sparkContext.defaultParallelism))
    for feature, content in sums.select("feature", "sums").collect():
        found[:, :, feature] += np.frombuffer(content, np.int64).reshape(3, len(nodes), size).swapaxes(0, 1)
    return dict(zip(nodes, found))


@dataclass
class Cut:
    """A node's best cut, with the sums of its sides."""

    feature: int
    cut: int
    missing_left: bool
    left: tuple[int, int]
    right: tuple[int, int]
    fewer_left: bool


def best_cut(sums: np.ndarray, settings: Settings) -> Cut | None:
    """The best cut of a node from its sums [g, h, n] by input and bin, or None without one of positive gain."""
    total, lacking = sums[:, 0].sum(axis=1), sums[:, :, 0]
    present = np.cumsum(sums[:, :, 1:], axis=2)

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return (g / UNIT) ** 2 / np.maximum(h / UNIT + settings.l2, 1e-300)

    best, top = None, settings.least_gain
    for missing_left in (True, False):
        g, h, n = left = present + lacking[:, :, None] if missing_left else present
        fits = (n > 0) & (n < total[2]) & (h >= settings.least_hessian * UNIT) & (total[1] - h >= settings.least_hessian * UNIT) & (sums[2, :, 1:] > 0)
        if not missing_left:
            fits &= lacking[2][:, None] > 0
        gain = np.where(fits, score(g, h) + score(total[0] - g, total[1] - h) - score(total[0], total[1]), -np.inf)
        at = np.unravel_index(gain.argmax(), gain.shape) if gain.size else None
        if at is not None and gain[at] > top:
            top = gain[at]
            sides = [int(left[k][at]) for k in (0, 1)]
            best = Cut(int(at[0]), int(at[1]) + 1, missing_left, (sides[0], sides[1]), (int(total[0]) - sides[0], int(total[1]) - sides[1]), bool(2 * n[at] <= total[2]))
    return best


def grow(binned: DataFrame, model: BoostedTrees, recent: list[Tree], settings: Settings) -> Tree:
    """One more tree; a pass over the rows for each level. The sides of a cut give the sums of the leaves."""
    tree, counted, above = Tree.blank(settings.depth), [0], {}
    tasks = binned.rdd.getNumPartitions()

    def leaf(node: int, g: int, h: int) -> None:
        tree.value[node] = -settings.rate * (g / UNIT) / (h / UNIT + settings.l2) if h or settings.l2 else 0.0

    for level in range(settings.depth):
        sums = level_sums(binned, tasks, model, recent, tree, level, counted)
        # A cut leaves rows on both sides, whose sums make up their parent's.
        for node in counted[:] if level else []:
            sums[node + 1 if node % 2 else node - 1] = above[(node - 1) // 2] - sums[node]
        counted, above = [], sums
        for node in sorted(sums):
            if not sums[node][2].any():
                continue  # a table without rows
            best = best_cut(sums[node], settings)
            if best is None:
                leaf(node, int(sums[node][0, 0].sum()), int(sums[node][1, 0].sum()))
                continue
            tree.feature[node], tree.cut[node], tree.missing_left[node] = best.feature, best.cut, best.missing_left
            leaf(2 * node + 1, *best.left)
            leaf(2 * node + 2, *best.right)
            counted.append(2 * node + 1 if best.fewer_left else 2 * node + 2)
        if not counted:
            break
    return tree


@contextmanager
def _fixed_plans(spark: SparkSession) -> Iterator[None]:
    """Without adaptive execution, which plans every pass stage by stage though its sizes are known; the session's own setting comes back."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fit(rows: DataFrame, names: list[str], label: str = "label", settings: Settings = Settings(), cuts: list[list[float]] | None = None) -> BoostedTrees:
    """Trees over ``names`` of ``rows``; ``cuts`` are the ascending borders of the bins, by default quantiles."""
    if not names:
        raise ValueError("boosting needs at least one input")
    labelled = rows.filter(F.col(label).isNotNull())
    borders = [np.unique(np.array(c, float)) for c in cuts] if cuts is not None else quantile_cuts(labelled, names, settings.bins)
    if max(map(len, borders)) > MOST_CUTS:
        raise ValueError(f"an input has more than {MOST_CUTS} cuts")
    model = BoostedTrees(list(names), borders, math.log(settings.base_score / (1 - settings.base_score)), settings.depth)
    binned, recent = _binned_rows(labelled, model, label), []
    with _fixed_plans(rows.sparkSession):
        for _ in range(settings.rounds):
            tree = grow(binned, model, recent, settings)
            model.trees.append(tree)
            recent.append(tree)
            if len(recent) >= KEEP_TREES and len(model.trees) < settings.rounds:
                binned, recent = _with_margin(binned, model, recent), []
    return model
