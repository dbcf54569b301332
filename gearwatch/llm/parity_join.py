"""Near duplicates by word shingles: a parity-sketch join, verified exactly.

A token toggles one bit of a sketch, so the Hamming distance of two sketches is at most the size of
the sets' symmetric difference. Sets of similar size share a size level; there two sets that link
differ in at most D tokens. The sketch of a level is cut into more than D bands by token hash, so
by the pigeonhole principle linked sets agree in whole bands. A band is kept as the exclusive or of
its tokens' 64-bit hashes, as if it were 2 ** 64 bits wide: bands agree when their tokens do.
Bands without a token would agree everywhere. There are some bands more than D + 1, so a set may
leave as many empty bands out; one with more of them uses all, which finds others of that kind.

Sets that agree in a band are candidates. Equal bands are chained: each set is compared with the
next one only, within a task before the shuffle and between tasks behind it. What passes the shuffle is
packed, a row for all a task has for a partition, as rows of their own would take twice the space and more
of it with every partition. Keys have 48 bits there: what meets by chance is one more candidate. Candidates pass a
filter on sizes and on the Hamming distance of 2,048-bit sketches and are then verified on their
shingles, first the nearest of each set, then those that would join different components. Bands in
which a chain met two components are completed: all their pairs across components are compared, in
blocks of bounded size: first only the nearest pairs that would join components, then, when these
are verified, all that are left. So components are those of all links, while pairs inside a component are
not listed.

Defined cases: a null or blank text has no shingle and links with nothing; fewer words than a
shingle are one shingle. Texts are brought together by their MD5, so copies are one node; a null id
counts as the largest and forms a component by itself with equal or linked texts (component_id is
null when no member has an id). Shingles are compared by a 64-bit hash. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gearwatch.llm.common import LAST, by_value, shuffle_partitions, written, written_by
from gearwatch.llm.components import components
from gearwatch.llm.repeats import Words, by_document, distinct_texts, mixed, rolling

by_value(__name__)

# Words of a shingle and the least similarity in percent, unless others are given:
# links need percent * union <= 100 * intersection.
SHINGLE = 4
PERCENT = 85
GROWTH = 1.5
SKETCH_BITS = 2048
#: Band rows that are chained together in a task, and members of a block of a band.
CHAINED, BLOCK = 1_000_000, 256
#: Bits and bytes of a band's key, and most partitions of the shuffle of the bands.
KEY_BITS, KEY_BYTES, MOST_PARTS = 48, 6, 1 << 16


def shingles(body: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, A-Z lower-cased."""
    words = Words(body.lower())
    if not words.size:
        return np.zeros(0, np.uint64)
    return np.unique(rolling(words.values(0, words.size), min(shingle, words.size)))


def most_different(a, b, percent: int = PERCENT):
    """The largest symmetric difference of linked sets of these sizes."""
    return (100 - percent) * (a + b) // (100 + percent)


def levels_of(size: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(first size, last size) of the size's level, and of the next one if a larger partner may be there."""
    low, high = 1, 2
    while high <= size:
        low, high = high, max(high + 1, int(high * GROWTH))
    found = [(low, high - 1)]
    if 100 * size >= percent * high:
        found.append((high, max(high + 1, int(high * GROWTH)) - 1))
    return found


def band_keys(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the bands a set is filed under; sets that link have one in common."""
    keys = []
    scattered = mixed(tokens ^ np.uint64(0xA5A5A5A55A5A5A5A))
    for low, high in levels_of(len(tokens), percent):
        different = most_different(high, high, percent)
        spare = -(-different // 8) + 1 if different else 0
        bands = different + 1 + spare
        place = (scattered % np.uint64(bands)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        used, starts = np.unique(place[order], return_index=True)
        parity = np.bitwise_xor.reduceat(mixed(tokens[order]), starts)
        if bands - len(used) > spare:
            full = np.zeros(bands, np.uint64)
            full[used] = parity
            used, parity = np.arange(bands), full
        keys.append(mixed(parity ^ mixed(used.astype(np.uint64) + np.uint64(low) * np.uint64(1 << 32))))
    return np.concatenate(keys)


def sketch_of(tokens: np.ndarray) -> bytes:
    """The parity sketch as bytes: each token toggles one bit."""
    bits = np.bincount((mixed(tokens) >> np.uint64(53)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def node_of(digests: pa.Array) -> np.ndarray:
    """A text's number: the first eight bytes of its digest."""
    return np.array([int.from_bytes(d.as_py()[:8], "big", signed=True) for d in digests], np.int64)


def chained(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of equal key linked in a row: (key, a, b) with b valid where the flag is set; heads have no b.

    Rows come back in the order they came in. A text's rows stand side by side there, so the shuffle
    behind it compresses their node; ordered by key, no two neighbours have anything in common.
    """
    order = np.lexsort((nodes, keys))
    other, same = np.empty_like(nodes), np.empty(len(keys), bool)
    other[order] = np.append(nodes[order[:1]], nodes[order[:-1]])
    same[order] = np.append(False, keys[order[1:]] == keys[order[:-1]])
    return keys, nodes, other, same


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of whole numbers: all first bytes, all second bytes and so on, so that equal ones stand side by side."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(content: bytes, width: int) -> np.ndarray:
    found = np.zeros((len(content) // width, 8), np.uint8)
    found[:, :width] = np.frombuffer(content, np.uint8).reshape(width, -1).T
    return found.view("<u8").ravel()


def packed(keys: np.ndarray, nodes: np.ndarray, other: np.ndarray, same: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Rows of ``chained``: the keys of heads, the texts in a row that they belong to, how many each text has, and (key, a, b) of the links."""
    heads = nodes[~same]
    starts = np.flatnonzero(np.append(True, heads[1:] != heads[:-1])) if len(heads) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(heads)))
    links = np.stack([keys[same].astype(np.int64), nodes[same], other[same]])
    return planes(keys[~same], KEY_BYTES), heads[starts].tobytes(), planes(counts, 4), links.tobytes()


def band_edges(texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(key, a, b): texts that agree in a band, each with the next one."""
    parts = min(shuffle_partitions(texts.sparkSession), MOST_PARTS)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0

        def flush() -> pa.RecordBatch:
            columns = chained(np.concatenate(keys) >> np.uint64(64 - KEY_BITS), np.concatenate(nodes))
            part = (columns[0] * np.uint64(parts)) >> np.uint64(KEY_BITS)
            order = np.argsort(part, kind="stable")
            firsts = np.flatnonzero(np.append(True, part[order[1:]] != part[order[:-1]]))
            rows = [packed(*[c[here] for c in columns]) for here in np.split(order, firsts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(part[order[firsts]].astype(np.int32)), *[pa.array(column, pa.binary()) for column in zip(*rows)]], ["part", "keys", "texts", "counts", "links"])

        for batch in batches:
            for node, body in zip(node_of(batch.column(0)), batch.column(1)):
                tokens = shingles(body.as_py(), shingle)
                if len(tokens):
                    keys.append(band_keys(tokens, percent))
                    nodes.append(np.full(len(keys[-1]), node))
                    held += len(keys[-1])
                if held >= CHAINED:
                    yield flush()
                    keys, nodes, held = [], [], 0
        if held:
            yield flush()

    def edges(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(key), CHAINED // 10):
            yield pa.RecordBatch.from_arrays([pa.array(c[at:at + CHAINED // 10].astype(np.int64)) for c in (key, a, b)], ["key", "a", "b"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for own, texts, counts, links in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3, 4)]):
                keys.append(from_planes(own, KEY_BYTES))
                nodes.append(np.repeat(np.frombuffer(texts, np.int64), from_planes(counts, 4).astype(np.int64)))
                yield from edges(*np.frombuffer(links, np.int64).reshape(3, -1))
        key, node = np.concatenate(keys), np.concatenate(nodes)
        del keys, nodes
        turns = -(-len(key) // CHAINED)  # so many at a time are put in order
        for turn in range(turns):
            here = np.flatnonzero(key % np.uint64(turns) == turn)
            here = here[np.lexsort((node[here], key[here]))]
            same = np.flatnonzero(key[here[1:]] == key[here[:-1]])
            yield from edges(key[here[same]], node[here[same + 1]], node[here[same]])

    filed = texts.select("digest", "body").mapInArrow(file, "part int, keys binary, texts binary, counts binary, links binary")
    found = filed.repartitionById(parts, "part").mapInArrow(chain, "key long, a long, b long")
    return written(found.select("key", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b"), "band-edges")


def candidates_of(texts: DataFrame, pairs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, digest, size, sketch, body) of the texts in pairs, written in buckets of the digest as the texts are, so bodies are not moved."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    numbered = texts.select("digest", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long").alias("node"))
    wanted = numbered.join(ends, "node")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(body.as_py(), shingle) for body in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch_of(s) for s in sets], pa.binary()), batch.column(2)],
                ["node", "digest", "size", "sketch", "body"])

    found = texts.select("digest", "body").join(wanted, "digest").select("node", "digest", "body")
    return written_by(found.mapInArrow(build, "node long, digest binary, size long, sketch binary, body binary"), "digest", "candidates")


def beside(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs with columns of both their texts, as ``a_...`` and ``b_...``."""
    for end in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns]), end)
    return pairs


def close_pairs(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, distance) of the pairs that sizes and sketches allow to link."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(name).to_numpy() for name in ("a_size", "b_size")]
            left, right = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64) for name in ("a_sketch", "b_sketch"))
            distance = np.bitwise_count(left ^ right).sum(axis=1).astype(np.int64)
            near = np.maximum(distance, abs(sizes[0] - sizes[1])) <= most_different(*sizes, percent)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(k).to_numpy()[near]) for k in (0, 1)] + [pa.array(distance[near])], ["a", "b", "distance"])

    both = beside(pairs.select("a", "b"), nodes, ["size", "sketch"])
    return both.select("a", "b", "a_size", "b_size", "a_sketch", "b_sketch").mapInArrow(keep, "a long, b long, distance long")


def verified(pairs: DataFrame, nodes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(a, b) of the pairs whose shingles make a link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, known = [], {}
            for a, left, b, right in zip(*[batch.column(name) for name in ("a", "a_body", "b", "b_body")]):
                for node, body in ((a.as_py(), left), (b.as_py(), right)):
                    if node not in known:
                        known[node] = shingles(body.as_py(), shingle)
                one, other = known[a.as_py()], known[b.as_py()]
                common = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(100 * common >= percent * (len(one) + len(other) - common))
            linked = np.array(linked, bool)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(name).to_numpy()[linked]) for name in ("a", "b")], ["a", "b"])

    # Bodies lie in buckets of the digest, so pairs go to the bodies; only the body of an end goes to the other one.
    both = beside(pairs.select("a", "b"), nodes, ["digest"])
    for end in "ab":
        both = both.join(nodes.select(F.col("digest").alias(f"{end}_digest"), F.col("body").alias(f"{end}_body")), f"{end}_digest")
    return written(both.select("a", "b", "a_body", "b_body").mapInArrow(check, "a long, b long"), "links")


def labelled(frame: DataFrame, labels: DataFrame, ends: list[str]) -> DataFrame:
    """``frame`` with the component label of each end; a node without links is its own."""
    for end in ends:
        frame = frame.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end, "left").withColumn(f"{end}_label", F.coalesce(f"{end}_label", end))
    return frame


def open_pairs(edges: DataFrame, labels: DataFrame, nodes: DataFrame, forest: bool, percent: int = PERCENT) -> DataFrame:
    """(a, b) across components that agree in a band whose chain met two components, and may link.

    With ``forest`` a group gives only as many pairs as join its components, nearest first. A band's members are dealt into blocks; each pair of blocks is compared in one group of at most
    2 * BLOCK members on average, so no band is gathered in one task.
    """
    met = labelled(edges, labels, ["a", "b"]).filter("a_label <> b_label").select("key").distinct()
    members = edges.join(written(met, "open-bands"), "key").select("key", F.explode(F.array("a", "b")).alias("node")).distinct()
    members = written(labelled(members, labels, ["node"]).withColumnRenamed("node_label", "label"), "open-members")
    # Of a band of two its one pair has been compared.
    counts = written(members.groupBy("key").agg(F.count("*").alias("members")).filter("members > 2"), "open-counts")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = members.join(counts, "key").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "label")
    sized = dealt.join(nodes.select("node", "size", "sketch"), "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key, low, high, own, node, label, size = (table.column(name).to_numpy() for name in ("key", "low", "high", "own", "node", "label", "size"))
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)
            label = label.copy()
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
            found = []
            for first, last in zip(starts, np.append(starts[1:], len(key))):
                for at in range(first, last - 1):
                    rest = slice(at + 1, last)
                    near = label[rest] != label[at]
                    near &= abs(size[rest] - size[at]) <= most_different(size[rest], size[at], percent)
                    if low[first] != high[first]:
                        near &= own[rest] != own[at]
                    where = np.flatnonzero(near) + at + 1
                    distance = np.bitwise_count(sketch[where] ^ sketch[at]).sum(axis=1)
                    close = distance <= most_different(size[where], size[at], percent)
                    where = where[close]
                    if forest and len(where):
                        where = where[np.argsort(distance[close], kind="stable")]
                        _, nearest = np.unique(label[where], return_index=True)
                        where = where[nearest]  # one pair for each component that is joined here
                        label[first:last][np.isin(label[first:last], label[where])] = label[at]
                    found.append(np.stack([np.minimum(node[where], node[at]), np.maximum(node[where], node[at])], axis=1))
            if found:
                unique = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(unique[:, 0]), pa.array(unique[:, 1])], ["a", "b"])

        for batch in batches:
            held = pa.Table.from_batches([*(held.to_batches() if held is not None else []), batch])
            if len(held) >= 8 * BLOCK:
                key, low, high = (held.column(name).to_numpy() for name in ("key", "low", "high"))
                differs = np.flatnonzero((key != key[-1]) | (low != low[-1]) | (high != high[-1]))
                if len(differs):
                    yield from pairs(held.slice(0, int(differs[-1]) + 1))
                    held = held.slice(int(differs[-1]) + 1)
        if held is not None and len(held):
            yield from pairs(held)

    grouped = sized.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return grouped.select("key", "low", "high", "own", "node", "label", "size", "sketch").mapInArrow(compare, "a long, b long").distinct()


def linked_texts(texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(node, label) of all texts that link with another one."""
    edges = band_edges(texts, shingle, percent)
    pairs = written(edges.select("a", "b").distinct(), "pairs")
    nodes = candidates_of(texts, pairs, shingle)
    near = written(close_pairs(pairs, nodes, percent), "near")
    both = near.select(F.explode(F.array("a", "b")).alias("node"), F.struct("distance", "a", "b").alias("pair"))
    nearest = written(both.groupBy("node").agg(F.min("pair").alias("pair")).select("pair.a", "pair.b").distinct(), "nearest")
    links = verified(nearest, nodes, shingle, percent)
    labels = components(links)
    across = labelled(near, labels, ["a", "b"]).filter("a_label <> b_label").select("a", "b").join(nearest, ["a", "b"], "left_anti")
    links = links.unionByName(verified(across, nodes, shingle, percent))
    # First what would join the components of open bands, then whatever is still across components.
    for forest in (True, False):
        labels = components(links)
        missed = written(open_pairs(edges, labels, nodes, forest, percent).join(pairs, ["a", "b"], "left_anti"), "missed")
        links, pairs = links.unionByName(verified(missed, nodes, shingle, percent)), pairs.unionByName(missed)
    return components(links)


def per_text(texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(digest, first_doc, n_shingles, label, component) of every text; component is the smallest id of its component."""
    labels = linked_texts(texts, shingle, percent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([len(shingles(body.as_py(), shingle)) for body in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node_of(batch.column(0))), sizes], ["digest", "first_doc", "node", "n_shingles"])

    sized = written(texts.select("digest", "first_doc", "body").mapInArrow(count, "digest binary, first_doc long, node long, n_shingles long"), "sizes")
    known = sized.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = known.groupBy("label").agg(F.min("first_doc").alias("component"))
    return known.join(written(least, "components"), "label").select("digest", "first_doc", "n_shingles", "label", "component")


def report(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    found = by_document(docs, per_text(distinct_texts(docs), shingle, percent))
    own = F.col("row.doc_id").cast("long")
    return found.select("row.doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, own).otherwise(F.nullif(F.col("component"), F.lit(LAST))).alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``docs``: that of the smallest id; a text without words stays.

    Of repeated rows with one id and text one stays. Rows without an id stay only where no linked row has one.
    """
    texts = distinct_texts(docs.select("doc_id", "text"))
    found = by_document(docs, per_text(texts, shingle, percent))
    number = F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST))
    stays = found.filter((F.col("n_shingles") == 0) | (number == F.col("component")))
    # Several rows of a component are left only if rows repeat an id or have none.
    blank = F.when(F.col("n_shingles") == 0, F.monotonically_increasing_id())
    rows = stays.select("label", blank.alias("blank"), F.struct("row", "is_null", "digest").alias("kept"), F.xxhash64("digest", "row").alias("order"))
    one = rows.groupBy("label", "blank").agg(F.min_by("kept", "order").alias("kept")).select("kept.*")
    # The texts of the rows that stay come from the table of texts, which need not be moved.
    whole = texts.select("digest", "body").join(one, "digest")
    text = F.when(~F.col("is_null"), F.col("body").cast("string"))
    return whole.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
