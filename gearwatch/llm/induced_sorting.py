"""Repeated byte strings, found by suffix arrays that are built by induced sorting.

Runs of windows that may repeat are grouped by their smallest gram of 24 bytes (see ``repeats``), and
each shard of groups gets a suffix array. Suffixes are classified as smaller (S) or larger (L) than
the one behind them. The substrings from one leftmost S to the next are sorted and named; when names
repeat, the string of names is sorted in the same way, a third as long. The order of the leftmost
S-suffixes then induces that of all others: a suffix is placed by its symbols up to the next leftmost
S and the place of the suffix there. Symbols are compared packed, several at a time, for all suffixes
at once. The common prefixes of neighbours in the array are compared up to the window; neighbours
that share a window form a class, and all but its earliest member are repeats.

Defined cases: a null or empty text, or one of fewer than 100 bytes, loses nothing. Of equal texts
with different ids all but the smallest lose every byte; rows with equal id and text get equal
results. Texts with the same id are ordered by their MD5; a null id counts as the largest. Matches
never cross documents. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from gearwatch.llm.common import by_value
from gearwatch.llm.repeats import Bytes, by_document, distinct_texts, repeated_spans, with_spans

by_value(__name__)

WINDOW, GRAM = 100, 24
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def group_starts(fresh: np.ndarray) -> np.ndarray:
    """For each place the start of its group, given where groups begin."""
    return np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))


def sequence_ranks(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, tail: np.ndarray | None) -> np.ndarray:
    """Ranks of the sequences ``symbols[start..end]``; equal ones are ranked by ``tail``, or share a rank.

    A sequence that is a prefix of another one does not occur: its last symbol marks its end.
    """
    bits = int(symbols.max()).bit_length()
    packed = max(1, 63 // bits)
    # At each place the next symbols in one number; a mask takes away those behind a sequence's end.
    padded = np.append(symbols, np.zeros(packed + 1, np.int64))
    numbers = np.zeros(len(symbols) + 1, np.int64)
    for k in range(packed):
        numbers = (numbers << bits) | padded[k:k + len(numbers)]
    masks = np.array([(1 << bits * packed) - (1 << bits * (packed - n)) for n in range(packed + 1)], np.int64)
    ranks, active, at = np.zeros(len(start), np.int64), np.arange(len(start)), start.copy()

    def divide(members: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank members of equal rank anew by key; returns them in order, and their group starts."""
        first = ranks[members]
        if not first.any():
            order = np.argsort(key)
        elif key.max() < 1 << 31:
            order = np.argsort(first << 32 | key)
        else:
            order = np.lexsort((key, first))
        members, key = members[order], key[order]
        old = ranks[members]
        other = np.append(True, old[1:] != old[:-1])
        groups = group_starts(other | np.append(True, key[1:] != key[:-1]))
        ranks[members] = old + groups - group_starts(other)
        return members, groups

    while len(active):
        places = at[active]
        key = numbers[places] & masks[np.minimum(end[active] - places + 1, packed)]
        members, groups = divide(active, key)
        several = np.bincount(groups, minlength=len(members))[groups] > 1
        members = members[several]
        ended = at[members] + packed > end[members]
        if tail is not None and ended.any():
            divide(members[ended], tail[members[ended]])
        active = members[~ended]
        at[active] += packed
    return ranks


def suffix_ranks(text: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """The place of each suffix of a string of non-negative numbers, or of each wanted one, in their sorted order."""
    size = len(text)
    wanted = np.arange(size) if wanted is None else wanted
    if size < 2:
        return np.zeros(len(wanted), np.int64)
    firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    grows = np.append(text[firsts[1:]] > text[firsts[:-1]], False)  # the end is smaller than any symbol
    smaller = np.repeat(grows, np.diff(np.append(firsts, size)))
    leftmost = np.flatnonzero(smaller & np.append(False, ~smaller[:-1]))
    symbols = text * 2 + smaller + 2  # 0 is left for the end
    if len(leftmost):
        names = sequence_ranks(symbols, leftmost, np.append(leftmost[1:], size), None)
        _, names = np.unique(names, return_inverse=True)
        placed = names if names.max() + 1 == len(names) else suffix_ranks(names)
    else:
        placed = np.zeros(0, np.int64)
    following = np.searchsorted(leftmost, wanted, side="right")
    end = np.append(leftmost, size)[following]
    return sequence_ranks(symbols, wanted, end, np.append(placed + 1, 0)[following])


def share_window(packed: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the common prefix of suffixes is a window long, compared by eight bytes at a time."""
    same = np.ones(len(left), bool)
    open_ = np.arange(len(left))
    for k in [*range(0, WINDOW - 7, 8), WINDOW - 8]:
        equal = packed[left[open_] + k] == packed[right[open_] + k]
        same[open_[~equal]] = False
        open_ = open_[equal]
    return same


def repeats_in(bodies: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of the windows that also start in a body of smaller rank, or before in the same one."""
    sizes = np.array([len(body) + 1 for body in bodies])
    joined = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    row = np.repeat(np.arange(len(bodies)), sizes)
    place = np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols = joined.astype(np.int64) + 1
    symbols[np.cumsum(sizes) - 1] = 0
    starts = np.flatnonzero(place + WINDOW < sizes[row])
    array = np.empty_like(starts)
    array[suffix_ranks(symbols, starts)] = starts  # only windows are placed; all leftmost S-suffixes were sorted
    padded = np.append(joined, np.zeros(8, np.uint8)).astype(np.uint64)
    packed = np.zeros(len(joined), np.uint64)
    for k in range(8):
        packed = (packed << np.uint64(8)) | padded[k:k + len(joined)]
    classes = np.flatnonzero(np.append(True, ~share_window(packed, array[:-1], array[1:])))
    order = rank[row[array]] * (len(joined) + 1) + place[array]
    earliest = np.minimum.reduceat(order, classes)
    gone = np.sort(array[order != np.repeat(earliest, np.diff(np.append(classes, len(array))))])
    return row[gone], place[gone]


def within(texts: list[Bytes], doc_rank: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of the windows that also start earlier: in a run of smaller rank, or before in the same run.

    Of equal runs only the earliest is sorted: all windows of the others also start in it.
    """
    earliest: dict[bytes, int] = {}
    copy = np.zeros(len(texts), bool)
    for i in np.argsort(rank).tolist():
        copy[i] = earliest.setdefault(texts[i].body, i) != i
    kept, copies = np.flatnonzero(~copy), np.flatnonzero(copy)
    row, place = repeats_in([texts[i].body for i in kept.tolist()], rank[kept])
    windows = np.array([texts[i].size - WINDOW + 1 for i in copies.tolist()], np.int64)
    row = np.concatenate([kept[row], np.repeat(copies, windows)])
    place = np.concatenate([place, np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)])
    order = np.lexsort((place, row))
    return row[order], place[order]


def _counted(body: bytes, first: np.ndarray, stop: np.ndarray) -> tuple[int, int, int, str]:
    edges = [0, *np.stack([first, stop], axis=1).ravel().tolist(), len(body)]
    kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return len(body), int((stop - first).sum()), len(first), hashlib.sha256(kept).hexdigest()


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    texts = distinct_texts(docs)
    spans = repeated_spans(texts, Bytes, WINDOW, GRAM, within, same_document=True)
    found = by_document(docs, with_spans(texts, spans, _counted, "n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    emptied = F.col("is_copy") & (F.col("n_bytes") >= WINDOW)
    return found.select("row.doc_id", "n_bytes", F.when(emptied, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
                        F.when(emptied, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
                        F.when(emptied, F.lit(EMPTY_SHA256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
