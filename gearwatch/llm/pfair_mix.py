"""Sources interleaved to target weights by Pfair scheduling.

A source's documents are cut into blocks. Time is counted in slots of one block. With weight c / P,
block j of a source is released at slot floor(j * P / c) and due before slot ceil((j + 1) * P / c).
At every slot the released block with the earliest deadline goes next (ties: the first source by
name). The weights sum to 1, so every block meets its deadline: at any slot each source has had its
share of the slots to within less than one block. The schedule repeats after P slots, so it is
worked out once for P slots, and a block's slot is a look-up. Its cost is P times the number of
sources, whatever the number of documents.

Every document is kept and placed once. From the slot on at which the first source has no block
left, targets cannot be met any more; ``in_mix`` is false there, and the other sources go on in
their own slots.

Defined cases: null is a source of its own, ordered first. Documents of a source are numbered by id
and then by the hash of their text; a null id comes last. A weight that names no source is left out;
a source without a weight gets one slot of the period. An empty table gives no rows. Columns other
than the id, source and text are carried along, or dropped by ``report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from gearwatch.llm.common import let, ranked, written

PERIOD = 1000
BLOCK_DOCS = 8
#: Under this name the metadata of the column ``source`` hold the slots that a mix was decided on.
NOTE = "mix"


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def shares(counts: DataFrame, weights: dict[str, float] | None, period: int = PERIOD, decided: dict[str, int] | None = None) -> DataFrame:
    """(key, rows, slots): whole slots per period from the given weights, or from the root of the counts.

    ``decided`` has the slots of sources for which that was done before; it comes first, and any other source gets one.
    """
    if decided is not None:
        spark = counts.sparkSession
        known = spark.createDataFrame(list(decided.items()), "key string, slots long")
        return counts.join(F.broadcast(known), "key", "left").select("key", "rows", F.coalesce("slots", F.lit(1).cast("long")).alias("slots"))
    if weights is None:
        size = F.floor(F.sqrt("rows") * 1000)
    else:
        size = F.lit(0)
        for name, weight in weights.items():
            size = F.when(F.col("key") == f"s{name}", F.lit(round(weight * 1_000_000))).otherwise(size)
    sized = counts.withColumn("size", size.cast("long"))
    return sized.select("key", "rows", F.greatest(F.lit(1), F.expr(f"(size * {period}L) div greatest(sum(size) OVER (), 1L)")).cast("long").alias("slots"))


def schedule(slots: Column, period: Column) -> Column:
    """The source index of each slot of a period, earliest deadline first among released blocks."""

    def step(state: Column, t: Column) -> Column:
        def due(c: Column, i: Column) -> Column:
            done = F.get(state["done"], i)
            return F.when(F.floor(done * period / c) <= t, F.struct(F.ceil((done + 1) * period / c).alias("deadline"), i.alias("source")))

        return let(F.array_min(F.transform(slots, due))["source"], lambda best: F.struct(
            F.transform(state["done"], lambda d, i: d + F.when(i == best, F.lit(1)).otherwise(F.lit(0))).alias("done"),
            F.concat(state["plan"], F.array(best)).alias("plan")))

    start = F.struct(F.transform(slots, lambda c: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("plan"))
    return F.aggregate(F.sequence(F.lit(0), (period - 1).cast("int")), start, step, lambda state: state["plan"])


def timetable(parts: DataFrame) -> DataFrame:
    """(key, slots, period, nth, slot): where the nth block of a source stands in the period."""
    one = parts.agg(F.array_sort(F.collect_list(F.struct("key", "slots"))).alias("parts"), F.sum("slots").alias("period"))
    plan = one.select("parts", "period", F.posexplode(let(F.transform("parts", lambda p: p["slots"]), lambda s: schedule(s, F.col("period")))).alias("slot", "source"))
    named = plan.select(F.get("parts", "source")["key"].alias("key"), F.get("parts", "source")["slots"].alias("slots"), "period", "slot")
    return named.withColumn("nth", F.row_number().over(W.partitionBy("key").orderBy("slot")) - 1)


def numbered(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """``docs`` with their number in their source, from 0: their place in the order of all rows behind the sources before."""
    before = W.orderBy("key").rowsBetween(W.unboundedPreceding, -1)  # one row per source
    starts = parts.select(F.col("key").alias("_key"), F.col("slots").alias("_slots"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    placed = ranked(docs, [F.col("_key"), F.asc_nulls_last("doc_id"), F.col("_hash")], "_place", "mix-order")
    return placed.join(F.broadcast(starts), "_key").withColumn("_number", F.col("_place") - F.col("_start")).drop("_place", "_start")


def placed(docs: DataFrame, weights: dict[str, float] | None = None, period: int = PERIOD, block_docs: int = BLOCK_DOCS, tie: Column | None = None,
           decided: dict[str, int] | None = None) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with _block, _release, _deadline, _slot, _position and _in_mix.

    Where ``docs`` has no text any more, ``tie`` is the hash of it, by which equal ids are ordered.
    """
    # The row travels as one column, so its own names cannot clash with those used here.
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", source_key(F.col("source")).alias("_key"), (F.xxhash64("text") if tie is None else tie).alias("_hash"))
    counts = docs.groupBy(source_key(F.col("source")).alias("key")).agg(F.count("*").alias("rows"))
    parts = written(shares(counts, weights, period, decided), "mix-shares")
    # One row per slot of a period: at most 1,000 and one for each source.
    table = written(timetable(parts), "mix-timetable")
    ends = parts.withColumn("missing", F.expr(f"(rows + {block_docs - 1}) div {block_docs}L")).join(F.broadcast(table), ["key", "slots"]).filter("missing % slots = nth")
    horizon = ends.agg(F.min(F.expr("(missing div slots) * period + slot"))).first()[0] or 0
    timed = (numbered(keyed, parts).withColumn("_block", F.expr(f"_number div {block_docs}L"))
             .withColumn("_nth", F.expr("_block % _slots")).withColumn("_cycle", F.expr("_block div _slots"))
             .join(F.broadcast(table.select(F.col("key").alias("_key"), F.col("nth").cast("long").alias("_nth"), F.col("slot").alias("_at"), F.col("period").alias("_period"))), ["_key", "_nth"]))
    start = F.col("_cycle") * F.col("_period")
    return timed.select(
        "row.*", "_block", (start + F.floor(F.col("_nth") * F.col("_period") / F.col("_slots"))).alias("_release"),
        (start + F.ceil((F.col("_nth") + 1) * F.col("_period") / F.col("_slots"))).alias("_deadline"), (start + F.col("_at")).alias("_slot"),
        ((start + F.col("_at")) * block_docs + F.col("_number") % block_docs).alias("_position"), (start + F.col("_at") < horizon).alias("_in_mix"))


def report(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """doc_id, source, block, release, deadline, slot, position and in_mix of every document."""
    names = ["block", "release", "deadline", "slot", "position", "in_mix"]
    slim = docs.select("doc_id", "source", F.xxhash64("text").alias("hash"))
    return placed(slim, weights, tie=F.col("hash")).select("doc_id", "source", *[F.col(f"_{n}").alias(n) for n in names])


def with_positions(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with their position and in_mix.

    Sorted by position, each beginning of the rows with in_mix has the sources' target weights, whatever
    order the rows are stored in. Positions are distinct; a source's last block may leave some out.
    Without ``weights`` the slots hold that ``in_schedule_order`` noted on the source, if it did.
    """
    noted = docs.schema["source"].metadata.get(NOTE) if weights is None else None
    decided = dict(zip(noted["keys"], noted["slots"])) if noted else None
    return placed(docs, weights, decided=decided).select(*docs.columns, F.col("_position").alias("position"), F.col("_in_mix").alias("in_mix"))


def in_schedule_order(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """All of ``docs``, in the order of the schedule: written files follow one another in it.

    The slots of each source are noted in the metadata of the column ``source``, which written files keep.
    There is one entry per source, as in the timetable.
    """
    # Slots are decided once: what is noted is what orders the rows.
    counts = docs.groupBy(source_key(F.col("source")).alias("key")).agg(F.count("*").alias("rows"))
    parts = shares(counts, weights).select("key", "slots").orderBy("key").collect()
    decided = {r.key: r.slots for r in parts}
    packed = docs.select(F.struct("*").alias("packed"), "doc_id", "source", "text")
    ordered = placed(packed, decided=decided).sort("_position").select("packed.*")
    note = {**docs.schema["source"].metadata, NOTE: {"keys": list(decided), "slots": list(decided.values())}}
    return ordered.withMetadata("source", note) if decided else ordered
