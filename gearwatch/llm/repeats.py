"""Finding every window of a fixed number of units (bytes or words) that also stands somewhere earlier.

Equal texts are brought together first; one of each, that of the smallest id, is searched. A window
is filed under the smallest hash among the grams inside it, so equal windows are filed together
wherever they stand, and neighbouring windows that share their smallest gram travel as one run.
Runs whose gram occurs once cannot hold a repeat and go no further. The others are cut out of their
texts and grouped by gram; ``within`` finds the repeated windows of the groups that fit in memory.
A gram with more than ``HOT_RUNS`` runs is not sent to one task: of equal runs the earliest stays, and the
windows of those are filed anew under grams twice as long, until every group fits and goes through
``within`` as well. A gram cannot be longer than the window; windows whose longest gram is still in
too many runs are compared by a 128-bit hash of their whole content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gearwatch.llm.common import LAST, by_value, written, written_by

by_value(__name__)

HOT_RUNS = 4000
#: Windows of one run at most; longer ones are cut, which leaves every window in one run.
RUN = 1024
#: Units of a text that are looked at together, bytes of runs that one task searches together, and texts cut together.
PIECE, TOGETHER, SLICE = 1 << 20, 1 << 19, 200
PLACES = np.uint64((1 << 21) - 1)

ODD = np.uint64(0x9E3779B97F4A7C15)
BYTE_VALUES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(40))
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def rolling(values: np.ndarray, size: int, base: int = int(ODD)) -> np.ndarray:
    """Hash of every ``size`` consecutive values, by doubling the length."""
    result, done, power, length, factor, factor_done = None, 0, values, 1, base, 1
    while True:
        if size & length:
            if result is None:
                result = power
            else:
                n = min(len(result), len(power) - done)
                result = result[:n] + np.uint64(factor_done) * power[done:done + n]
            done += length
            factor_done = factor_done * factor % 2**64
        length *= 2
        if length > size:
            return mixed(result[:max(0, len(values) - size + 1)])
        power = power[:-(length // 2)] + np.uint64(factor) * power[length // 2:] if len(power) > length // 2 else power[:0]
        factor = factor * factor % 2**64


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    length = 1
    n = len(values) - width + 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    return np.minimum(values[:n], values[width - length:width - length + n])


class Bytes:
    """A text as its UTF-8 bytes."""

    def __init__(self, body: bytes) -> None:
        self.body = body
        self.size = len(body)

    def values(self, low: int, high: int) -> np.ndarray:
        return BYTE_VALUES[np.frombuffer(self.body, np.uint8, high - low, low)]

    def cut(self, low: int, high: int) -> bytes:
        return self.body[low:high]

    def spans(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return low, high


class Words:
    """A text as its words between blanks; a word is known by a 64-bit hash."""

    def __init__(self, body: bytes) -> None:
        self.body = body
        blank = np.concatenate([[True], IS_SPACE[np.frombuffer(body, np.uint8)] if body else [], [True]]).astype(bool)
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        self.begins, self.ends = edges[::2], edges[1::2]
        self.size = len(self.begins)

    def values(self, low: int, high: int) -> np.ndarray:
        if low == high:
            return np.zeros(0, np.uint64)
        first, last = int(self.begins[low]), int(self.ends[high - 1])
        codes = BYTE_VALUES[np.frombuffer(self.body, np.uint8, last - first, first)]
        begins, lengths = self.begins[low:high] - first, (self.ends - self.begins)[low:high]
        # Each byte is weighted by its place in its word; blanks fall between the words' sums.
        place = np.arange(last - first) - np.repeat(begins, np.diff(np.append(begins, last - first)))
        sums = np.add.reduceat(np.where(IS_SPACE[np.frombuffer(self.body, np.uint8, last - first, first)], np.uint64(0), mixed(codes + place.astype(np.uint64) * ODD)), begins)
        return mixed(sums + lengths.astype(np.uint64))

    def cut(self, low: int, high: int) -> bytes:
        return self.body[int(self.begins[low]):int(self.ends[high - 1])]

    def spans(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.begins[low], self.ends[high - 1]


def runs(text, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and smallest gram of each run, and whether the run holds that gram twice."""
    firsts, grams, twice, total = [], [], [], text.size - window + 1
    for low in range(0, max(0, total), PIECE):
        high = min(total, low + PIECE)
        hashes = rolling(text.values(low, high + window - 1), gram)
        # The place of the smallest gram of each window, of equal ones the first, in the low bits.
        place = sliding_least((hashes & ~PLACES) | np.arange(len(hashes), dtype=np.uint64), window - gram + 1) & PLACES
        least = hashes[place]
        starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        lengths = np.diff(np.append(starts, len(least)))
        if (lengths > RUN).any():
            parts = -(-lengths // RUN)
            inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            starts = np.repeat(starts, parts) + inside * RUN
        firsts.append(starts + low)
        grams.append(least[starts])
        twice.append(place[starts] != place[np.append(starts[1:], len(least)) - 1])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    first = np.concatenate(firsts)
    return first, np.diff(np.append(first, total)), np.concatenate(grams), np.concatenate(twice)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(digest, first_doc, body) of each different text of ``docs`` (doc_id, text); null is an empty text.

    Copies are combined before the one shuffle of texts. The table is hashed by digest, so joins on
    it move no text again. A null id counts as the largest.
    """
    body = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), body.alias("body"), F.unhex(F.md5(body)).alias("digest"))
    found = rows.groupBy("digest").agg(F.min("id").alias("first_doc"), F.first("body").alias("body"))
    return written_by(found, "digest", "texts")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of few texts, so that what is made of a part stays small."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


def repeated_runs(texts: DataFrame, unit: type, window: int, gram: int) -> DataFrame:
    """(digest, nth, hot) of the runs whose gram occurs at least twice in all."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [runs(unit(body.as_py()), window, gram) for body in part.column(1)]
            sizes = [len(grams) for _, _, grams, _ in found]
            if sum(sizes):
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                nth = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
                grams, twice = (np.concatenate([f[k] for f in found]) for k in (2, 3))
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), part.column(0).take(owner), pa.array(nth), pa.array(1 + twice.astype(np.int8))], ["gram", "digest", "nth", "times"])

    filed = texts.select("digest", "body").mapInArrow(file, "gram long, digest binary, nth int, times byte")
    often = written(filed.groupBy("gram").agg(F.count("*").alias("runs"), F.sum("times").alias("times")).filter("times > 1").drop("times"), "grams")
    return filed.join(often, "gram").select("digest", "nth", (F.col("runs") > HOT_RUNS).alias("hot"))


def cut_runs(texts: DataFrame, unit: type, window: int, gram: int) -> DataFrame:
    """(gram, hot, first_doc, digest, first, units, body) of the repeated runs, written."""
    wanted = repeated_runs(texts, unit, window, gram).groupBy("digest").agg(F.collect_list(F.struct("nth", "hot")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns: dict[str, list] = {name: [] for name in ("gram", "hot", "first", "units", "body")}
            owner = []
            for at, (body, found) in enumerate(zip(batch.column(2), batch.column(3))):
                nth, hot = (found.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                text = unit(body.as_py())
                first, length, grams, _ = runs(text, window, gram)
                columns["gram"] += grams[nth].view(np.int64).tolist()
                columns["hot"] += hot.tolist()
                columns["first"] += first[nth].tolist()
                columns["units"] += (length[nth] + window - 1).tolist()
                columns["body"] += [text.cut(int(a), int(a + n) + window - 1) for a, n in zip(first[nth], length[nth])]
                owner += [at] * len(nth)
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns["gram"], pa.int64()), pa.array(columns["hot"], pa.bool_()), batch.column(1).take(take), batch.column(0).take(take),
                 *[pa.array(columns[name], kind) for name, kind in (("first", pa.int64()), ("units", pa.int64()), ("body", pa.binary()))]],
                ["gram", "hot", "first_doc", "digest", "first", "units", "body"])

    joined = texts.join(wanted, "digest").select("digest", "first_doc", "body", "wanted")
    return written(joined.mapInArrow(cut, "gram long, hot boolean, first_doc long, digest binary, first long, units long, body binary"), "runs")


def window_spans(row: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, stop) of the units under windows, given by row and place in order, joined where they touch."""
    if not len(row):
        return row, at, at
    fresh = np.append(True, (row[1:] != row[:-1]) | (at[1:] > at[:-1] + window))
    firsts = np.flatnonzero(fresh)
    lasts = np.append(firsts[1:], len(row)) - 1
    return row[firsts], at[firsts], at[lasts] + window


Within = Callable[[list, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def run_order(docs: np.ndarray, digests: pa.Array, firsts: np.ndarray) -> np.ndarray:
    """The place of each run among all: by document id, then by text, then by place."""
    halves = np.frombuffer(b"".join(digests.to_pylist()), ">u8").reshape(-1, 2)
    order = np.lexsort((firsts, halves[:, 1], halves[:, 0], docs))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def spans_in_groups(groups: DataFrame, unit: type, window: int, within: Within) -> DataFrame:
    """(digest, first, stop) of the repeated windows in the runs (gram, first_doc, digest, first, body).

    ``within`` gets texts, the order of each among documents (rank of its id) and the order of each
    among all runs, and returns row and place of the windows to remove, in order.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            docs, firsts = (table.column(k).to_numpy() for k in ("first_doc", "first"))
            digests = table.column("digest").combine_chunks()
            _, doc_rank = np.unique(docs, return_inverse=True)
            row, at = within([unit(body) for body in table.column("body").to_pylist()], doc_rank, run_order(docs, digests, firsts))
            row, first, stop = window_spans(row, at, window)
            return pa.RecordBatch.from_arrays([digests.take(pa.array(row)), pa.array(firsts[row] + first), pa.array(firsts[row] + stop)], ["digest", "first", "stop"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= TOGETHER:
                table = pa.Table.from_batches(held)
                grams = table.column("gram").to_numpy()
                end = int(np.searchsorted(grams, grams[-1]))  # the last gram may go on in the next batch
                if end:
                    yield found(table.slice(0, end))
                held = table.slice(end).to_batches()
                size = 0
        if held:
            table = pa.Table.from_batches(held)
            if len(table):
                yield found(table)

    dealt = groups.select("gram", "first_doc", "digest", "first", "body").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(search, "digest binary, first long, stop long")


def split_copies(hot: DataFrame, same_document: bool) -> tuple[DataFrame, DataFrame]:
    """Spans of the runs that equal an earlier run, and the other runs.

    The order is (id, digest, place) where repeats in one document count, else the id alone; then
    equal runs of the earliest document all stay.
    """
    order = F.struct("first_doc", "digest", "first") if same_document else F.struct("first_doc")
    hot = hot.withColumn("content", F.unhex(F.md5("body"))).withColumn("order", order)
    kinds = written(hot.groupBy("content").agg(F.min("order").alias("least")), "contents")
    compared = hot.join(kinds, "content")
    copied = compared.filter("least < order").select("digest", "first", (F.col("first") + F.col("units")).alias("stop"))
    return copied, compared.filter("least = order").select("first_doc", "digest", "first", "body")


def cut_finer(kept: DataFrame, unit: type, window: int, gram: int) -> DataFrame:
    """The runs of ``cut_runs`` for longer grams, made from runs instead of texts, written."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns: dict[str, list] = {name: [] for name in ("gram", "times", "first", "units", "body")}
            owner = []
            for at, (first, body) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
                text = unit(body.as_py())
                start, length, grams, twice = runs(text, window, gram)
                columns["gram"] += grams.view(np.int64).tolist()
                columns["times"] += (1 + twice).tolist()
                columns["first"] += (first + start).tolist()
                columns["units"] += (length + window - 1).tolist()
                columns["body"] += [text.cut(int(a), int(a + n) + window - 1) for a, n in zip(start, length)]
                owner += [at] * len(start)
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns["gram"], pa.int64()), pa.array(columns["times"], pa.int64()), batch.column(0).take(take), batch.column(1).take(take),
                 *[pa.array(columns[name], kind) for name, kind in (("first", pa.int64()), ("units", pa.int64()), ("body", pa.binary()))]],
                ["gram", "times", "first_doc", "digest", "first", "units", "body"])

    filed = written(kept.mapInArrow(cut, "gram long, times long, first_doc long, digest binary, first long, units long, body binary"), "finer")
    often = written(filed.groupBy("gram").agg(F.count("*").alias("runs"), F.sum("times").alias("total")).filter("total > 1").drop("total"), "finer-grams")
    joined = filed.join(often, "gram").select("gram", (F.col("runs") > HOT_RUNS).alias("hot"), "first_doc", "digest", "first", "units", "body")
    return written(joined, "finer-runs")


def spans_by_window(kept: DataFrame, unit: type, window: int, same_document: bool) -> DataFrame:
    """(digest, first, stop) of the windows of runs (first_doc, digest, first, body) that equal an earlier one."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b, owner, place = [], [], [], []
            for at, (body, first) in enumerate(zip(batch.column(3), batch.column(2))):
                text = unit(body.as_py())
                values = text.values(0, text.size)
                a.append(rolling(values, window))
                b.append(rolling(mixed(values), window, 0xC2B2AE3D27D4EB4F))
                owner.append(np.full(len(a[-1]), at))
                place.append(first.as_py() + np.arange(len(a[-1])))
            if owner:
                take = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64)), batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(place))],
                    ["a", "b", "first_doc", "digest", "first"])

    order = F.struct("first_doc", "digest", "first") if same_document else F.struct("first_doc")
    each = written(kept.mapInArrow(windows, "a long, b long, first_doc long, digest binary, first long").withColumn("order", order), "windows")
    least = written(each.groupBy("a", "b").agg(F.min("order").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n"), "least-windows")
    return each.join(least, ["a", "b"]).filter("least < order").select("digest", "first", (F.col("first") + window).alias("stop"))


def repeated_spans(texts: DataFrame, unit: type, window: int, gram: int, within: Within, same_document: bool) -> DataFrame:
    """(digest, spans) with the spans of units to remove; spans may overlap."""
    cut = cut_runs(texts, unit, window, gram)
    spans = spans_in_groups(cut.filter("NOT hot"), unit, window, within)
    while not (hot := cut.filter("hot")).isEmpty():
        copied, kept = split_copies(hot, same_document)
        spans = spans.unionByName(copied)
        gram *= 2
        if gram >= window:
            spans = spans.unionByName(spans_by_window(kept, unit, window, same_document))
            break
        cut = cut_finer(kept, unit, window, gram)
        spans = spans.unionByName(spans_in_groups(cut.filter("NOT hot"), unit, window, within))
    return spans.groupBy("digest").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))


def joined_spans(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order, overlapping and touching ones joined."""
    if not len(first):
        return first, stop
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(stop[order])
    fresh = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
    return first[fresh], reach[np.append(fresh[1:], len(first)) - 1]


def with_spans(texts: DataFrame, spans: DataFrame, make: Callable, schema: str) -> DataFrame:
    """(digest, first_doc, ...) of every text: ``make(body, first, stop)`` gives a row's further values."""
    names = [field.strip().split()[0] for field in schema.split(",")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[field.strip().split()[1]] for field in schema.split(",")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for body, found in zip(batch.column(2), batch.column(3)):
                first, stop = (found.values.field(k).to_numpy() for k in (0, 1)) if found.is_valid else (np.zeros(0, np.int64),) * 2
                rows.append(make(body.as_py(), *joined_spans(first, stop)))
            made = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["digest", "first_doc", *names])

    joined = texts.join(spans, "digest", "left").select("digest", "first_doc", "body", "spans")
    return joined.mapInArrow(build, f"digest binary, first_doc long, {schema}")


def by_document(docs: DataFrame, results: DataFrame) -> DataFrame:
    """Every row of ``docs`` without its text as ``row``, with its text's digest and results.

    ``is_null`` tells a missing text from an empty one, ``is_copy`` whether an equal text has a
    smaller id. The texts themselves are not moved.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), F.col("text").isNull().alias("is_null"), F.unhex(F.md5(text)).alias("digest"))
    joined = rows.join(results, "digest")
    return joined.withColumn("is_copy", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)) > F.col("first_doc")).drop("first_doc")
