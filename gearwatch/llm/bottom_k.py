"""Document fingerprints: the k smallest hashes of a document's word shingles.

A sketch of a union is the k smallest of both sketches, so sketches of parts can be merged in any
order. From two sketches follow the resemblance and the containment of their documents, from one
the number of distinct shingles. A sketch of fewer than k hashes is the whole set and exact.

Defined cases: words are lower-cased and stand between blanks. With fewer words than a shingle the
whole sequence is the one shingle; a null text, or one without words, has the empty sketch and the
empty fingerprint. Two empty sketches resemble each other fully, an empty and another one not at
all. Hashes are distinct, so repeated shingles count once. Rows with equal ids are ordered by the
hash of their text; a null id comes after all others. One document is its own neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from gearwatch.llm.common import let, positions, ranked, split_words, written
from gearwatch.operators.skew import broadcast_if_small

SHINGLE = 5
SIZE = 64
#: Most documents of a range of ids, ordered together, unless ids repeat; and the bits that the smallest ranges leave out.
RANGE_ROWS, LEAST_SHIFT = 1024, 4


def sketch(text: Column, size: int = SIZE, shingle: int = SHINGLE) -> Column:
    """The ``size`` smallest shingle hashes, ascending."""

    def shingles(hashes: Column) -> Column:
        return F.when(F.size(hashes) >= shingle, F.transform(
            positions(F.size(hashes) - (shingle - 1)), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(shingle)])
        )).when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))

    words = F.transform(split_words(F.lower(text)), lambda w: F.xxhash64(w))
    return F.slice(F.array_sort(F.array_distinct(let(words, shingles))), 1, size)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of both sketches' documents together."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of common shingles among all shingles of both, 0 to 1."""
    return let(merged(a, b, size), lambda both: F.when(F.size(both) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(a, b), both)) / F.size(both)))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles: exact below ``size``, else from the largest kept hash."""
    share = (F.get(a, F.lit(size - 1)).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / share)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the first document's shingles that the second has, 0 to 1; 0 for an empty one."""
    common = resemblance(a, b, size) * distinct_shingles(merged(a, b, size), size)
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, size)))


def fingerprint(a: Column) -> Column:
    """A sketch as text: 16 hex digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def group_sketches(docs: DataFrame, key: str, size: int = SIZE) -> DataFrame:
    """One sketch per value of ``key``. Each value keeps ``size`` rows per map task at most before the shuffle."""
    hashes = docs.select(key, F.explode(sketch(F.col("text"), size)).alias("hash")).distinct()
    rank = F.row_number().over(W.partitionBy(key).orderBy("hash"))
    return hashes.withColumn("rank", rank).filter(F.col("rank") <= size).groupBy(key).agg(F.array_sort(F.collect_list("hash")).alias("sketch"))


def range_shift(docs: DataFrame) -> int:
    """The most low bits of the ids that can be left out so that no range of ids holds more than ``RANGE_ROWS`` rows.

    Found by halving over the counts of small ranges, so neither far ids nor gaps widen the ranges.
    """
    counts = written(docs.groupBy(F.shiftright("doc_id", LEAST_SHIFT).alias("cell")).agg(F.count("*").alias("rows")), "id-ranges")
    low, high = LEAST_SHIFT, 63
    while low < high:
        middle = (low + high + 1) // 2
        most = counts.groupBy(F.shiftright("cell", middle - LEAST_SHIFT)).agg(F.sum("rows").alias("rows")).agg(F.max("rows")).first()[0] or 0
        low, high = (middle, high) if most <= RANGE_ROWS else (low, middle - 1)
    return low


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Rows (doc_id, text, hash, carried) with the ``carried`` columns of the document with the next smaller id.

    The last one gets those of the first. Ids are cut into ranges; each range is ordered by itself
    and also gets the head of the next range, so texts go through one shuffle. The heads' ids are
    broadcast if a count shows that they are few; else finding the heads takes a second shuffle.
    """
    ranged = docs.withColumn("range", F.shiftright("doc_id", range_shift(docs)))
    heads = ranged.groupBy("range").agg(F.max("doc_id").alias("head"))
    ordered = written(ranked(heads, [F.desc_nulls_last("range")], "place", "range-heads"), "range-heads")
    count = ordered.count()
    before = ordered.select(F.expr(f"(place + 1) % {max(1, count)}L").alias("place"), F.col("range").alias("before"))
    few, _ = broadcast_if_small(ordered.join(before, "place").select("head", "before"))
    copies = ranged.join(few, F.col("doc_id").eqNullSafe(F.col("head"))).withColumn("range", F.col("before")).drop("head", "before")
    order = W.partitionBy("range").orderBy("copy", F.desc_nulls_last("doc_id"), "hash")
    both = ranged.withColumn("copy", F.lit(0)).unionByName(copies.withColumn("copy", F.lit(1)))
    return both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]).filter("copy = 0").drop("copy", "range")


def report(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Fingerprints of every document (doc_id, text) and of its text with the second half taken from the next one."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    paired = with_next(texts.withColumn("sketch", sketch(F.col("text"), size)), ["text", "sketch"])
    chars = F.length("text")
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substr("text", F.lit(1), (chars - half).cast("int")), F.substr("next_text", F.lit(1), half))
    rows = paired.select("doc_id", "sketch", "next_sketch", chars.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), size))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
                       resemblance(F.col("sketch"), F.col("edited_sketch"), size).alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("next_sketch"), size).alias("near_next"),
                       distinct_shingles(F.col("sketch"), size).alias("shingles"),
                       containment(F.col("edited_sketch"), F.col("sketch"), size).alias("edited_contained"))
