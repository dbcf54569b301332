"""License phrases, and license texts found by an exact set-similarity join with templates.

Every paragraph of a license notice is a template, so a notice is found without its first sentence.
A block is a run of as many consecutive words as the template has, and half as many again, or the
whole text where it is shorter. It matches when the share of the template's distinct words that it
holds reaches the threshold. Where a template of another label shares so many words that its text
would match too, a block must also hold all words that the other one lacks.

Instead of comparing every block with every template, the template's words are ordered by the number
of documents that hold them, rarest first. A matching block needs ``need = ceil(threshold * size)`` of
the template's words, so it must hold one of the ``size - need + 1`` rarest, and the rarest of the
words that it must hold, if there are any (prefix filter), the text needs ``need`` words (length
filter), and the rarest word found must leave ``need`` words at or behind it in the order (positional
filter). Only blocks around such words are counted, and all of those are.

Defined cases: A-Z are lower-cased and words are runs of ASCII letters and digits and of non-ASCII
characters; a null or empty text has none. Labels are distinct and sorted; none give an empty
string. The score is the largest share of a matching template, 0 without one. Matching blocks that
overlap or touch are one row of ``blocks``, with the largest share among them. Words of equal
frequency are ordered by themselves. Repeated rows are scanned one by one; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gearwatch.llm.common import by_value

by_value(__name__)

THRESHOLD = 0.8

# Phrases whose places are reported, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public license notices, paragraph by paragraph, as templates.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, without warranties or conditions of any kind, either express or implied",
        "See the License for the specific language governing permissions and limitations under the License"),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details",
        "You should have received a copy of the GNU General Public License along with this program"),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0",),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0",),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, you can obtain one at"),
}

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []  # bytes.lower touches A-Z only


def phrase_places(words: list[bytes], phrases: dict[tuple[bytes, ...], str], last_words: set[bytes]) -> list[tuple[int, str]]:
    """(start, label) of each place where a phrase's words stand one after another."""
    found = []
    for at, word in enumerate(words):
        if word in last_words:
            for phrase, label in phrases.items():
                start = at - len(phrase) + 1
                if start >= 0 and tuple(words[start:at + 1]) == phrase:
                    found.append((start, label))
    return found


class Template:
    """A template's words in global order, with what the filters need."""

    def __init__(self, label: str, text: str, frequency: dict[bytes, int], threshold: float = THRESHOLD, others: list[str] = ()) -> None:
        words = words_of(text)
        self.label, self.width = label, len(words) + len(words) // 2
        ordered = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
        self.rank = {word: i for i, word in enumerate(ordered)}
        self.size = len(ordered)
        self.need = min(n for n in range(1, self.size + 1) if n >= threshold * self.size - 1e-9)
        # Words that tell it apart from texts of other labels that hold enough of its words.
        near = [other for text in others if len((other := set(words_of(text))) & set(ordered)) >= self.need]
        self.must = {word for other in near for word in ordered if word not in other}
        self.prefix = {min(self.must, key=self.rank.__getitem__)} if self.must else set(ordered[:self.size - self.need + 1])

    def blocks(self, words: list[bytes], places: list[int]) -> list[tuple[int, int, float]]:
        """(start, end, share) of the matching blocks around ``places`` of prefix words; overlapping ones are joined."""
        if len(words) < self.need:
            return []
        width, found, done = min(self.width, len(words)), [], -1
        for place in places:
            first, last = max(0, place - width + 1, done + 1), min(place, len(words) - width)
            if first > last:
                continue
            done = last
            held = Counter(w for w in words[first:first + width] if w in self.rank)
            for start in range(first, last + 1):
                if start > first:
                    gone, new = words[start - 1], words[start + width - 1]
                    if gone in self.rank:
                        held[gone] -= 1
                        if not held[gone]:
                            del held[gone]
                    if new in self.rank:
                        held[new] += 1
                if len(held) >= self.need and self.size - min(map(self.rank.__getitem__, held)) >= self.need and self.must <= held.keys():
                    share = len(held) / self.size
                    if found and start <= found[-1][1]:
                        found[-1] = (found[-1][0], start + width, max(share, found[-1][2]))
                    else:
                        found.append((start, start + width, share))
        return found


def templates_of(notices: dict[str, tuple[str, ...]], frequency: dict[bytes, int], threshold: float) -> list[Template]:
    return [Template(label, text, frequency, threshold, [t for other, rest in notices.items() if other != label for t in rest])
            for label, texts in notices.items() for text in texts]


def template_words(notices: dict[str, tuple[str, ...]]) -> set[bytes]:
    return {word for texts in notices.values() for text in texts for word in words_of(text)}


def document_frequencies(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> dict[bytes, int]:
    """Number of documents that hold each template word, over all documents. One row per template word."""
    wanted = template_words(templates)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()
        for frame in frames:
            for text in frame["text"]:
                seen.update(wanted.intersection(words_of(text)))
        if seen:  # columns of no values have no type of their own
            yield pd.DataFrame({"word": [w.decode() for w in seen], "n": list(seen.values())})

    rows = docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {row["word"].encode(): row["n"] for row in rows}


def _finder(docs: DataFrame, templates: dict[str, tuple[str, ...]], threshold: float) -> tuple[list[Template], Callable]:
    """The templates, and a function that gives (label, start, end, share) of every block in a list of words."""
    known = templates_of(templates, document_frequencies(docs, templates), threshold)
    prefixes = set().union(*[t.prefix for t in known])

    def find(words: list[bytes]) -> list[tuple[str, int, int, float]]:
        places: dict[bytes, list[int]] = {}
        for at, word in enumerate(words):
            if word in prefixes:
                places.setdefault(word, []).append(at)
        return [(t.label, *block) for t in known if not t.prefix.isdisjoint(places)
                for block in t.blocks(words, sorted(at for word in t.prefix for at in places.get(word, ())))]

    return known, find


def blocks(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every block of every document (doc_id, text): doc_id, label, first word and word behind the last, share."""
    _, find = _finder(docs, templates, threshold)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(at, *block) for at, text in enumerate(batch["text"]) for block in find(words_of(text.as_py()))]
            if found:
                at, *columns = zip(*found)
                yield pa.record_batch([batch["doc_id"].take(pa.array(at)), *[pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.float64()))]],
                                      ["doc_id", "label", "first_word", "end_word", "share"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, label string, first_word long, end_word long, share double")


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Phrases, labels and score of every document (doc_id, text)."""
    known, find = _finder(docs, templates, threshold)
    phrases = {tuple(phrase.encode().split()): label for phrase, label in PHRASES.items()}
    last_words = {phrase[-1] for phrase in phrases}
    signals = last_words.union(*[t.prefix for t in known])

    def look(text: str | None) -> tuple:
        words = words_of(text)
        if signals.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        places = phrase_places(words, phrases, last_words)
        starts, base = [at for at, _ in places], {label for _, label in places}
        found = find(words)
        labels, score = base.union(label for label, *_ in found), max((share for *_, share in found), default=0.0)
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score)

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [look(text.as_py()) for text in batch["text"]]
            columns = list(zip(*found)) or [()] * len(names)
            yield pa.record_batch([batch["doc_id"], *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
