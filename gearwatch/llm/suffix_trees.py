"""Passages of whole words that also stand in a document with a smaller id.

Suffixes are the windows of 50 words; a window is filed under the smallest gram of eight words in
it, which splits all suffixes into groups that fit in memory (see ``repeats``; groups that do not
are split by the whole window). In a group the suffixes are divided as a suffix tree divides them,
level by level: those with equal first words, first two, four, eight, ... words share a node, and
a node is numbered by the pair of nodes half as deep. Nodes of depth 50 with documents below them
are the repeats: a window goes when the smallest id below its node is smaller than its own.

Defined cases: a null or empty text, or one of fewer than 50 words, loses nothing. Of equal texts
with different ids all but the smallest lose every word; rows with equal id and text get equal
results; a null id counts as the largest. Words are compared as they are, by a 64-bit hash; blanks
between them do not count. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from gearwatch.llm.common import by_value
from gearwatch.llm.repeats import Words, by_document, distinct_texts, repeated_spans, with_spans

by_value(__name__)

WINDOW, GRAM = 50, 8
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def nodes(words: np.ndarray, depth: int) -> np.ndarray:
    """Number of the tree node of ``depth`` words that the suffix at each place passes through."""
    _, node = np.unique(words, return_inverse=True)
    reached = 1
    while reached < depth:
        step = min(reached, depth - reached)
        pair = node[:-step] * np.int64(node.max() + 1) + node[step:]
        _, node = np.unique(pair, return_inverse=True)
        reached += step
    return node


def within(texts: list[Words], doc_rank: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of the windows that also stand in a document of smaller rank."""
    sizes = np.array([t.size for t in texts])
    row = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    starts = np.flatnonzero(place + WINDOW <= sizes[row])
    node = nodes(np.concatenate([t.values(0, t.size) for t in texts]), WINDOW)[starts]
    doc = doc_rank[row[starts]]
    least = np.full(node.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, doc)
    gone = starts[doc > least[node]]
    return row[gone], place[gone]


def kept_bytes(body: bytes, first: np.ndarray, stop: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of a text and which of them stay."""
    words = Words(body)
    stays = np.ones(words.size, bool)
    for a, b in zip(first, stop):
        stays[a:b] = False
    return words, stays


def _counted(body: bytes, first: np.ndarray, stop: np.ndarray) -> tuple[int, int, str]:
    words, stays = kept_bytes(body, first, stop)
    kept = b" ".join([body[a:b] for a, b in zip(words.begins[stays].tolist(), words.ends[stays].tolist())])
    return words.size, int(words.size - stays.sum()), hashlib.sha256(kept).hexdigest()


def _cleaned(body: bytes, first: np.ndarray, stop: np.ndarray) -> tuple[int, str]:
    words, stays = kept_bytes(body, first, stop)
    if stays.all():
        return words.size, body.decode()
    # The blanks behind a word go and stay with it.
    begins = np.append(words.begins, len(body))
    lengths = np.diff(begins)
    lead = body[:int(begins[0])] if words.size else b""
    keep = np.repeat(stays, lengths)
    rest = np.frombuffer(body, np.uint8)[len(lead):][keep].tobytes()
    return words.size, (lead + rest).decode()


def search(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    texts = distinct_texts(docs)
    return texts, repeated_spans(texts, Words, WINDOW, GRAM, within, same_document=False)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    texts, spans = search(docs)
    found = by_document(docs, with_spans(texts, spans, _counted, "n_words long, n_removed long, kept_sha256 string"))
    emptied = F.col("is_copy") & (F.col("n_words") >= WINDOW)
    return found.select("row.doc_id", "n_words", F.when(emptied, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
                        F.when(emptied, F.lit(EMPTY_SHA256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages taken out of their texts; rows with no word left are dropped.

    A null text stays null, and a text without words stays as it is. n_chars, if present, follows the text.
    """
    texts, spans = search(docs)
    found = by_document(docs, with_spans(texts, spans, _cleaned, "n_words long, cleaned string"))
    emptied = F.col("is_copy") & (F.col("n_words") >= WINDOW)
    bare = F.trim(F.translate("cleaned", "\t\n\x0b\x0c\r", "     ")) == ""
    left = found.filter(~emptied & ~((F.col("n_words") > 0) & bare))
    text = F.when(~F.col("is_null"), F.col("cleaned"))
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return left.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])
