"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gearwatch.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every end of a link (a, b); the label is the smallest node that links reach.

    Every round each node moves to its smallest neighbour, twice over, and links between moved nodes
    remain. The smallest node of a component never moves, so the rest ends up at it. Links and
    labels stay in tables; the driver only sees counts.
    """
    labels, rest = None, links.select("a", "b").filter("a <> b")
    while True:
        both = rest.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(rest.select(F.col("b").alias("node"), F.col("a").alias("other")))
        moves = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("goal")), "moves")
        onward = moves.select(F.col("node").alias("goal"), F.col("goal").alias("further"))
        jumps = written(moves.join(onward, "goal").select("node", F.col("further").alias("goal")), "jumps")
        if labels is None:
            labels = jumps.withColumnRenamed("goal", "label")
        else:
            step = jumps.select(F.col("node").alias("label"), "goal")
            labels = labels.join(step, "label", "left").select("node", F.coalesce("goal", "label").alias("label"))
        labels = written(labels, "labels")
        ends = [jumps.select(F.col("node").alias(end), F.col("goal").alias(f"{end}_goal")) for end in "ab"]
        moved = rest.join(ends[0], "a").join(ends[1], "b").filter("a_goal <> b_goal")
        rest = written(moved.select(F.least("a_goal", "b_goal").alias("a"), F.greatest("a_goal", "b_goal").alias("b")).distinct(), "links")
        if not rest.limit(1).count():
            return labels
