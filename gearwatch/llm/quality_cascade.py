"""Quality rules as a short-circuit cascade, ordered by what each rule rejects for its cost.

Counts that every caller wants (words, symbols, repeated lines, words in repeated windows) are
computed for each document. The remaining rules are only evaluated until one of them rejects. On a
sample each rule is timed and its verdicts are recorded; the rule with the most rejections per
second among the documents still in play comes next, and so on. The order changes the cost, never
the verdict.

Defined cases: a null or empty text has no words and fails the base rule. Ties between rules keep
the order they are listed in. An empty table, or a sample without rows, keeps the listed order.
Repeated rows are judged one by one. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, functions as F

from gearwatch.llm.common import SPACES, let, positions, split_words, written

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
#: Most documents, on average, that costs and selectivities are estimated on.
SAMPLE_ROWS = 2000

# Fixed value: characters counted as symbols.
SYMBOLS = "[#*$%&|<>]+"


def repeated_words(words: Column) -> Column:
    """Words in ``WINDOW``-word windows that the array holds twice or more, the first included.

    Windows are sorted by hash; where neighbours agree their words are compared as well.
    """

    def starts(ws: Column, keys: Column) -> Column:
        def same(p: Column, j: Column, x: Column) -> Column:
            other = F.get(p, j)
            return F.coalesce((other["k"] == x["k"]) & (F.slice(ws, other["i"] + 1, WINDOW) == F.slice(ws, x["i"] + 1, WINDOW)), F.lit(False))

        paired = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        return let(paired, lambda p: F.filter(
            F.transform(p, lambda x, j: F.when(same(p, j - 1, x) | same(p, j + 1, x), x["i"])), lambda v: v.isNotNull()))

    def covered(found: Column) -> Column:
        return let(F.array_sort(found), lambda s: F.aggregate(
            F.transform(s, lambda v, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - v, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda total, v: total + v))

    def windows(hashes: Column) -> Column:
        return F.transform(positions(F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    return let(words, lambda ws: let(F.transform(ws, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), lambda keys: F.when(
        F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(covered(starts(ws, keys))))))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts that every document gets."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (docs.select("doc_id", text.alias("text"), split_words(text).alias("words"), lines.alias("lines"))
            .select("doc_id", "text", "lines", "words",
                    F.size("words").cast("long").alias("n_words"),
                    F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                    (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                    repeated_words(F.col("words")).alias("n_repeat_words")))


def rules() -> dict[str, Column]:
    """The cascade's rules by name; true rejects. They may use the text, its words and lines, and the counts."""
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace("text", r"[^\p{Lu}]+", ""))
    frequent = F.size(F.array_distinct("words"))
    closers = F.length(F.regexp_replace("text", "[^!]+", ""))
    return {
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "repeated_lines": 2 * F.col("n_dup_lines") > F.size("lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
        "capitals": 2 * capitals > letters,
        "few_letters": 2 * letters < F.col("word_chars"),
        "exclamations": 3 * closers > F.col("n_words"),
        "few_distinct_words": (F.col("n_words") >= 50) & (20 * frequent < F.col("n_words")),
    }


def cascade_order(counted: DataFrame, known: dict[str, Column], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per second among what the rules before let through, from a sample."""
    rows = counted.count()
    if not rows:
        return list(known)
    sample = written(counted.sample(fraction=min(1.0, sample_rows / rows), seed=7), "quality-sample")
    cost = {}
    for name in [next(iter(known)), *known]:  # the first run only warms up
        begun = time.perf_counter()
        sample.agg(F.count_if(known[name])).collect()
        cost[name] = time.perf_counter() - begun
    # At most 2 ** rules patterns, whatever the sample.
    patterns = [(row["hits"], row["n"]) for row in sample.groupBy(
        F.array(*[F.coalesce(rule, F.lit(False)) for rule in known.values()]).alias("hits")).agg(F.count("*").alias("n")).collect()]
    order, left = [], list(known)
    place = {name: i for i, name in enumerate(known)}
    while left:
        best = max(left, key=lambda name: (sum(n for hits, n in patterns if hits[place[name]]) / cost[name], -place[name]))
        order.append(best)
        left.remove(best)
        patterns = [(hits, n) for hits, n in patterns if not hits[place[best]]]
    return order


def judge(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    known = rules()
    # The window count is the dear one and no rule of the cascade needs it: column pruning drops it from the sample.
    order = cascade_order(base_counts(docs).drop("n_repeat_words"), known, sample_rows)
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    # CASE stops at the first branch that holds, so later rules are not evaluated.
    rejected = F.when(base_failed, F.lit(True))
    for name in order:
        rejected = rejected.when(known[name], F.lit(True))
    return base_counts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~rejected.otherwise(F.lit(False))).alias("kept"))
