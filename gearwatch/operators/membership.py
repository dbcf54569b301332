"""Bloom filters of written keys, as tables.

A key belongs to one bucket and sets seven of that bucket's 32,768 bits. There is a bucket for about
2,700 keys, so twelve bits per key and about one wrong hit in 300 absent keys. The number of buckets is
a power of two, so one hash gives a key's bucket in filters of any size. Keys are shuffled by bucket
before their bits are set: what is moved is one row of three numbers per key, and never a bitmap.
A key with a null is in no filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS, SET_BITS, BITS_PER_KEY = 32_768, 7, 12


def buckets_for(rows: int) -> int:
    """The least power of two of buckets that leaves each key ``BITS_PER_KEY`` bits."""
    return 1 << max(0, -(-rows * BITS_PER_KEY // BITS) - 1).bit_length()


def _hashes(keys: list[str]) -> list[Column]:
    """A hash of the key's text, its first bit and the step to the next; whole numbers of different widths hash alike."""
    texts = [F.col(c).cast("string") for c in keys]
    at, start, step = (F.xxhash64(F.lit(salt), *texts) for salt in range(3))
    return [at.alias("_at"), F.pmod(start, F.lit(BITS)).alias("_start"), (F.pmod(step, F.lit(BITS // 2)) * 2 + 1).alias("_step")]


def _positions() -> Column:
    """The bits of a key. The step is odd, so they differ."""
    return F.array(*[(F.col("_start") + k * F.col("_step")) % BITS for k in range(SET_BITS)])


def build_filter(rows: DataFrame, keys: list[str], count: int) -> DataFrame:
    """(buckets, bucket, bits) of the keys of about ``count`` rows; more rows only give more wrong hits."""
    buckets = buckets_for(count)
    dealt = (rows.dropna(subset=keys).select(*_hashes(keys)).withColumn("bucket", F.col("_at").bitwiseAND(F.lit(buckets - 1)))
             .repartition("bucket").select("bucket", F.explode(_positions()).alias("_position")))
    return (dealt.groupBy("bucket").agg(F.bitmap_construct_agg("_position").alias("bits"))
            .select(F.lit(buckets).cast("long").alias("buckets"), "bucket", "bits"))


def possible(rows: DataFrame, keys: list[str], filters: DataFrame) -> DataFrame:
    """The rows of ``filters`` (buckets, bucket, bits, further columns) that may hold a key of ``rows``.

    Returned are the filters' further columns and the key's columns, a row for each pair. Filters
    come in few sizes, powers of two; a key is looked up once in each size.
    """
    further = [c for c in filters.columns if c not in ("buckets", "bucket", "bits")]
    sizes = sorted(r[0] for r in filters.select("buckets").distinct().collect())  # at most one per power of two
    asked = (rows.dropna(subset=keys).select(*keys, *_hashes(keys))
             .withColumn("buckets", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes]).cast("array<bigint>")))
             .withColumn("bucket", F.col("_at").bitwiseAND(F.col("buckets") - 1)))
    every = F.expr("forall(_positions, p -> getbit(cast(conv(hex(substring(bits, cast(p div 8 as int) + 1, 1)), 16, 10) as bigint), cast(p % 8 as int)) = 1)")
    # The bits are worked out behind the join, so a key is moved as three numbers.
    return asked.join(filters, ["buckets", "bucket"]).withColumn("_positions", _positions()).filter(every).select(*further, *keys)
