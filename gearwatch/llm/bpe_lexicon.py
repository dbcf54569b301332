"""Byte-pair encoding through a lexicon of frequent words, with exact merges for all other words.

The words of all documents are counted with a mergeable summary of bounded size. The most frequent
ones are encoded once and compiled into a minimal acyclic transducer: words with equal ends share
states, the words passed over on the way to a final state number the word, and the number leads to
its ids. The file goes to the shared scratch folder and from there to every executor, where it is
memory-mapped. A word that the transducer does not know is merged by rank, so results never depend
on what is in the lexicon.

Defined cases: a null or empty text has no ids and decodes to an empty text. The strings of special
tokens in a text become their ids. Words of equal count are ordered by themselves. Repeated rows
are encoded one by one; an empty table gives no rows. A vocabulary without a symbol for some byte
of a text raises a KeyError.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from gearwatch.llm.common import by_value
from gearwatch.session import scratch_folder

by_value(__name__)

LEXICON_WORDS = 50_000
#: Words that a task's summary keeps; a word is missed only below 1 / SUMMARY_WORDS of a task's words.
SUMMARY_WORDS = 100_000
#: Blank-separated pieces whose result a task keeps at hand, twice over, and length of a long word.
CACHE, LONG_WORD = 200_000, 48
#: Texts whose ids a task holds at a time when it makes records.
RECORD_TEXTS = 250
END = "</w>"

# Unicode white space, and the pattern that cuts normalised text into words.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
MARKS = frozenset(".,;:!?")
GAPS = regex.compile(f"[{WHITE}]+")
SEPARATORS = "\x1c\x1d\x1e\x1f"  # blanks for str.split, not for the tokenizer


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, free = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in symbols:
            symbols[b], free = chr(free), free + 1
    return [symbols[b] for b in range(256)]


class Merges:
    """Symbols, ranked merges and special tokens of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = {i: t for t, i in (vocabulary | self.special).items()}
        symbols = byte_symbols()
        self.inner = [vocabulary.get(s) for s in symbols]
        self.last = [vocabulary.get(s + END) for s in symbols]
        self.ranks, self.made = {}, []  # rank of a pair (first << 32 | second), id made at a rank
        for rank, (a, b) in enumerate(content["model"]["merges"]):
            self.ranks.setdefault(vocabulary[a] << 32 | vocabulary[b], rank)
            self.made.append(vocabulary[a + b])

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: always the pair of lowest rank next, the first one of equals."""
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        if None in ids:
            raise KeyError(f"no symbol for a byte of {word!r}")
        if len(ids) > LONG_WORD:
            return self.merge_long(ids)
        rank_of, made = self.ranks.get, self.made
        none = len(made)
        waiting = [rank_of(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while waiting and (rank := min(waiting)) < none:
            at = waiting.index(rank)
            new = ids[at] = made[rank]
            del ids[at + 1], waiting[at]
            if at < len(waiting):
                waiting[at] = rank_of(new << 32 | ids[at + 1], none)
            if at:
                waiting[at - 1] = rank_of(ids[at - 1] << 32 | new, none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for words where looking at every pair each time would be slow."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        ranks, waiting = self.ranks, []

        def push(at: int, then: int) -> None:
            if (rank := ranks.get(ids[at] << 32 | ids[then])) is not None:
                heapq.heappush(waiting, (rank, at, ids[at], ids[then]))

        for at in range(len(ids) - 1):
            push(at, at + 1)
        while waiting:
            rank, at, a, b = heapq.heappop(waiting)
            then = after[at]
            if ids[at] != a or then >= len(ids) or ids[then] != b:
                continue  # one of the two was merged meanwhile
            ids[at], ids[then] = self.made[rank], -1
            after[at] = after[then]
            if after[at] < len(ids):
                before[after[at]] = at
                push(at, after[at])
            if before[at] >= 0:
                push(before[at], at)
        return [i for i in ids if i >= 0]


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic transducer of distinct words, as one block of bytes.

    Words are added in order. When the next word leaves a path, the states behind the fork are
    final in shape: each is replaced by an equal known one or becomes known itself.
    """
    entries = sorted(entries)
    states: list[tuple[bool, tuple]] = []  # known states: final, arcs (byte, state)
    known: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # the newest word's states: final, arcs
    previous = b""

    def settle(depth: int) -> None:
        while len(path) > depth:
            final, arcs = path.pop()
            shape = (final, tuple(arcs))
            if shape not in known:
                known[shape] = len(states)
                states.append(shape)
            path[-1][1].append((previous[len(path) - 1], known[shape]))

    for word, _ in entries:
        shared = next((i for i, (a, b) in enumerate(zip(previous, word)) if a != b), min(len(previous), len(word)))
        settle(shared + 1)
        path.extend([False, []] for _ in word[shared:])
        path[-1][0] = True
        previous = word
    settle(1)
    states.append((path[0][0], tuple(path[0][1])))

    words_below: list[int] = []
    first, labels, targets, passed, final = [0], bytearray(), [], [], []
    for is_final, arcs in states:  # every arc leads to an earlier state
        total = int(is_final)
        for byte, target in arcs:
            labels.append(byte)
            targets.append(target)
            passed.append(total)
            total += words_below[target]
        words_below.append(total)
        first.append(len(labels))
        final.append(int(is_final))
    offsets = np.cumsum([0] + [len(ids) for _, ids in entries])
    tables = [first, targets, passed, final, offsets, [i for _, ids in entries for i in ids]]
    sizes = np.array([len(states), *map(len, tables), len(labels)], np.int32)
    return sizes.tobytes() + b"".join(np.array(t, np.int32).tobytes() for t in tables) + bytes(labels)


SINGLE = [bytes([b]) for b in range(256)]


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.bytes = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.bytes, np.int32, 8).tolist()
        view, at, tables = memoryview(self.bytes), 32, []
        for size in sizes[1:7]:
            tables.append(view[at:at + 4 * size].cast("i"))
            at += 4 * size
        self.root, self.labels = sizes[0] - 1, at
        self.first, self.targets, self.passed, self.final, self.offsets, self.ids = tables

    def ids_of(self, word: bytes) -> list[int] | None:
        state, number, labels, find = self.root, 0, self.labels, self.bytes.find
        first, passed, targets = self.first, self.passed, self.targets
        for byte in word:
            arc = find(SINGLE[byte], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            number += passed[arc]
            state = targets[arc]
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tolist() if self.final[state] else None


def pieces(text: str) -> list[str]:
    """The text between white space."""
    return [p for p in GAPS.split(text) if p] if any(c in text for c in SEPARATORS) else text.split()


def words_of(piece: str) -> list[bytes]:
    """Normalised words of a piece, in UTF-8. Letters are lower-cased one by one, whatever stands beside them."""
    plain = unicodedata.normalize("NFC", piece)
    lowered = "".join(map(str.lower, plain)) if "Σ" in plain else plain.lower()
    if lowered.isalpha():  # the common case needs no pattern
        return [lowered.encode()]
    if lowered[-1:] in MARKS and lowered[:-1].isalpha():
        return [lowered[:-1].encode(), lowered[-1:].encode()]
    return [word.encode() for word in WORD.findall(lowered)]


class Encoder:
    """Encodes whole texts; results of pieces are kept at hand. Without ``decodes`` it gives ids only."""

    def __init__(self, merges: Merges, lexicon: Lexicon | None = None, decodes: bool = True) -> None:
        self.merges, self.lexicon, self.decodes = merges, lexicon, decodes
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}  # the cache before it was last full
        self.words: dict[bytes, tuple[int, str, str]] = {}
        self.older_words: dict[bytes, tuple[int, str, str]] = {}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True))) + ")") if merges.special else None

    def word(self, word: bytes) -> tuple[int, str, str]:
        """Number of ids, ids and tokens of a word, joined by blanks."""
        if (known := self.words.get(word)) is None:
            if (known := self.older_words.get(word)) is None:
                ids = self.lexicon.ids_of(word) if self.lexicon else None
                if ids is None:
                    ids = self.merges.merge(word)
                known = len(ids), " ".join(map(str, ids)), self.decode(ids) if self.decodes else ""
            if len(self.words) >= CACHE:
                self.older_words, self.words = self.words, {}
            self.words[word] = known
        return known

    def piece(self, text: str) -> tuple[int, str, str]:
        """The same of a piece of several words."""
        words = [self.word(word) for word in words_of(text)]
        if len(words) == 1:
            return words[0]
        if len(words) == 2:  # a word and the mark behind it
            (n, ids, tokens), (m, more, others) = words
            return n + m, f"{ids} {more}", f"{tokens} {others}" if self.decodes else ""
        return sum([n for n, _, _ in words]), " ".join([ids for _, ids, _ in words]), " ".join([tokens for _, _, tokens in words]) if self.decodes else ""

    def at_hand(self, text: str) -> tuple[int, str, str]:
        """The same of a piece that is kept from now on."""
        if (known := self.cache.get(text)) is None:
            if len(self.cache) >= CACHE:
                self.older, self.cache = self.cache, {}
            known = self.cache[text] = self.older.get(text) or self.piece(text)
        return known

    def parts(self, text: str | None) -> list[tuple[int, str, str]]:
        if not text:
            return []
        found = []
        for part in self.special.split(text) if any(token in text for token in self.merges.special) else (text,):
            if part in self.merges.special:
                found.append((1, str(self.merges.special[part]), part))
                continue
            every = pieces(part)
            known = list(map(self.cache.get, every))
            if None in known:
                known = [self.at_hand(piece) if k is None else k for piece, k in zip(every, known)]
            found += [k for k in known if k[0]]
        return found

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) for i in ids.split()]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens, joined by blanks: the vocabulary has no decoder that would do more."""
        return " ".join(map(self.merges.tokens.__getitem__, ids))


def frequent_words(docs: DataFrame, limit: int = LEXICON_WORDS, kept: int = SUMMARY_WORDS) -> list[bytes]:
    """The most frequent words of all documents, at most ``limit``.

    A task that has seen more than twice ``kept`` different words lowers all counts by that of the
    word at place ``kept`` and drops what reaches 0; what it sends is bounded.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()

        def shrink() -> None:
            nonlocal found
            if len(found) > kept:
                level = sorted(found.values(), reverse=True)[kept]
                found = Counter({word: n - level for word, n in found.items() if n > level})

        for frame in frames:
            for text in frame["text"]:
                if text:
                    found.update(pieces(text))
                if len(found) > 2 * kept:
                    shrink()
        shrink()
        words: Counter = Counter()
        for piece, n in found.items():
            for word in words_of(piece):
                words[word] += n
        yield pd.DataFrame({"word": list(words), "n": list(words.values())})

    counts = docs.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(row["word"]) for row in counts.orderBy(F.desc("n"), "word").limit(limit).collect()]


def shipped(spark: SparkSession, content: bytes) -> str:
    """Put a file into the shared scratch folder and announce it to all executors; returns its name there."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_folder(spark, 'lexicon')}/{name}")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(content))
    out.close()
    spark.sparkContext.addFile(place.toString())
    return name


def encoded(docs: DataFrame, path: str, result: dict, schema: str, limit: int = LEXICON_WORDS, decodes: bool = True, step: int | None = None) -> DataFrame:
    """All columns of ``docs`` (text, ...) as ``row``, and columns of ``schema`` made by the functions of ``result``.

    Each function gets an encoder's parts of a text and returns one value. Results leave a task for
    every ``step`` texts, or for every batch.
    """
    spark, merges = docs.sparkSession, Merges(path)
    lexicon = shipped(spark, compile_lexicon((word, merges.merge(word)) for word in frequent_words(docs, limit)))
    shared = spark.sparkContext.broadcast(vars(merges))  # of the vocabulary's size

    @F.pandas_udf(schema)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        symbols = Merges.__new__(Merges)
        vars(symbols).update(shared.value)
        encoder = Encoder(symbols, Lexicon(SparkFiles.get(lexicon)), decodes)
        for batch in batches:
            size = step or max(1, len(batch))
            for texts in (batch[at:at + size] for at in range(0, max(1, len(batch)), size)):
                rows = [[make(parts) for make in result.values()] for parts in map(encoder.parts, texts)]
                yield pd.DataFrame(rows, columns=list(result))

    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text")).withColumn("made", encode("text"))
    return packed.select("row", "made.*")


def token_count(parts: list) -> int:
    return sum([n for n, _, _ in parts])


def digest(place: int):
    """SHA-256 of the ids (place 1) or of the decoded text (place 2)."""
    return lambda parts: hashlib.sha256(" ".join([p[place] for p in parts]).encode()).hexdigest()


def token_ids(parts: list) -> np.ndarray:
    return np.array(" ".join([ids for _, ids, _ in parts]).split(), np.int32)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document (doc_id, text)."""
    result = {"n_tokens": token_count, "ids_sha256": digest(1), "decoded_sha256": digest(2)}
    made = encoded(docs.select("doc_id", "text"), path, result, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return made.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def records(docs: DataFrame, path: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, the ``carried`` columns, n_tokens and the ids of every document (doc_id, source, text)."""
    made = encoded(docs.select("doc_id", "source", "text", *carried), path, {"n_tokens": token_count, "ids": token_ids}, "n_tokens long, ids array<int>", decodes=False, step=RECORD_TEXTS)
    return made.select("row.doc_id", "row.source", *[f"row.{c}" for c in carried], "n_tokens", "ids")
