"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed runs of one to three characters of the lower-cased text, with a blank before
and after it. Document frequencies are counted over all documents that may be learned from. The
weights are fitted on a documented, bounded sample of them: about ``SAMPLE_ROWS`` rows in the languages'
own shares, and of each language at least about ``LEAST_ROWS``, or all its rows if it has fewer. The
draw is the same rule at every size of the input. Every round each shard of the sample is passed once by the follow-the-regularised-leader update with elastic-net penalties, and the shards'
states are averaged. A temperature is then fitted to held-back rows of the sample, so scores are
calibrated chances, of a mix like the sample's, where rare languages count for more. State and weights have ``FEATURES`` times the number of languages cells.

Defined cases: a null text and a text without a letter are ``und`` with score 0; so is every text
when nothing can be learned. Of equally likely languages the first by name wins. Rows with a null
language teach nothing; a null id counts as the empty text in the fold. Repeated rows are predicted
one by one; an empty table gives no rows. Language, source and id are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gearwatch.llm.common import LAST, by_value, written

by_value(__name__)

FEATURES = 1 << 15
LONGEST = 3
FOLDS = 5
#: Rows that the weights are fitted on, on average, and those of a language at least; a tenth of them is held back for the temperature.
SAMPLE_ROWS, LEAST_ROWS = 6000, 500
SHARDS, ROUNDS = 6, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.05
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the n-grams of the whole text, and how often each occurs."""
    letters = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    cells, rolled = [], np.zeros(len(letters), np.uint64)
    for n in range(1, LONGEST + 1):
        if len(letters) < n:
            break
        rolled = rolled[:len(letters) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + letters[n - 1:] + np.uint64(n)
        mixed = rolled ^ (rolled >> np.uint64(29))
        cells.append(((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 15)).astype(np.int64))
    counts = np.bincount(np.concatenate(cells), minlength=FEATURES)
    present = np.flatnonzero(counts)
    return present.astype(np.int32), counts[present]


def weighed(present: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[present]
    return values / (np.sqrt(values @ values) or 1.0)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def lists(values) -> pd.Series:
    """A column of arrays, also of none."""
    return pd.Series(list(values), dtype=object)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per feature cell over all of ``docs``, and their number. A task sends one row per cell at most."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, rows = np.zeros(FEATURES, np.int64), 0
        for frame in frames:
            for text in frame["text"]:
                if text:
                    totals[features(text)[0]] += 1
                rows += 1
        cells = np.flatnonzero(totals)
        yield pd.DataFrame({"cell": np.append(cells, FEATURES), "n": np.append(totals[cells], rows)})

    result = np.zeros(FEATURES + 1, np.int64)
    for cell, n in docs.select("text").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        result[cell] = n
    return result[:-1], int(result[-1])


def leader_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed-form weights of follow-the-regularised-leader: small sums are exactly 0."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def chances(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def fit(sample: DataFrame, classes: int, idf: np.ndarray) -> np.ndarray:
    """Weights (cell, class) from the rows (shard, class, cells, counts) of the sample."""
    z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))
    spark = sample.sparkSession
    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((z, n, idf))

        def one_pass(rows: pd.DataFrame) -> pd.DataFrame:
            z, n, idf = (part.copy() for part in state.value)
            for label, cells, counts in zip(rows["class"], rows["cells"], rows["counts"]):
                values = weighed(cells, counts, idf)[:, None]
                weights = leader_weights(z[cells], n[cells])
                error = chances((weights * values).sum(axis=0))
                error[label] -= 1
                slope = values * error
                step = (np.sqrt(n[cells] + slope ** 2) - np.sqrt(n[cells])) / ALPHA
                z[cells] += slope - step * weights
                n[cells] += slope ** 2
            used = np.flatnonzero(n.any(axis=1))
            return pd.DataFrame({"cell": used, "z": lists(z[used]), "n": lists(n[used])})

        passed = sample.groupBy("shard").applyInPandas(one_pass, "cell int, z array<double>, n array<double>")
        shards = sample.select("shard").distinct().count()
        means = passed.groupBy("cell").agg(F.array(*[F.sum(F.col("z")[k]) for k in range(classes)]), F.array(*[F.sum(F.col("n")[k]) for k in range(classes)])).collect()
        z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))
        for cell, sum_z, sum_n in means:
            z[cell], n[cell] = np.array(sum_z) / shards, np.array(sum_n) / shards
    return leader_weights(z, n)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores, from a fixed grid, with the least log loss on held-back rows."""
    def loss(t: float) -> float:
        return -np.log(np.maximum(chances(scores / t)[np.arange(len(labels)), labels], 1e-12)).mean()
    return float(min(np.geomspace(0.05, 5.0, 93), key=loss)) if len(labels) else 1.0


def draw_limits(rows: dict[str, int], lowest: dict[str, int], sample_rows: int, least_rows: int) -> dict[str, int]:
    """Up to which draw of 63 bits a row of a language is picked, from its rows and lowest draw: at least one row is."""
    share = sample_rows / max(1, sum(rows.values()))
    return {name: max(lowest[name], min(LAST, int(max(share, least_rows / n) * 2.0 ** 63))) for name, n in rows.items()}


def drawn(usable: DataFrame, sample_rows: int = SAMPLE_ROWS, least_rows: int = LEAST_ROWS) -> tuple[list[str], DataFrame]:
    """The languages by name, and the rows (doc_id, text, lang) that the weights are fitted on."""
    usable = usable.withColumn("draw", F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id", "text"), 1))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("lowest")).collect()  # one row per language
    limits = draw_limits({r["lang"]: r["n"] for r in counts}, {r["lang"]: r["lowest"] for r in counts}, sample_rows, least_rows)
    limit = F.create_map(*[F.lit(part) for item in limits.items() for part in item])
    return sorted(limits), usable.filter(F.col("draw") <= limit[F.col("lang")]).drop("draw")


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """The model from rows (doc_id, text, lang) outside the held-out fold, or None when there are none."""
    usable = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    frequencies, rows = document_frequencies(usable)
    if not rows:
        return None
    names, picked = drawn(usable, sample_rows)
    idf = np.log((1 + rows) / (1 + frequencies)) + 1

    def prepare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [features(text) for text in frame["text"]]
            yield pd.DataFrame({"shard": frame["shard"], "class": frame["lang"].map(names.index), "cells": lists(m[0] for m in made), "counts": lists(m[1] for m in made)})

    shard = F.pmod(F.xxhash64(F.lit(6), "doc_id", "text"), F.lit(SHARDS * 10)).cast("int")
    sample = written(picked.select("text", "lang", shard.alias("shard")).mapInPandas(prepare, "shard int, class int, cells array<int>, counts array<long>"), "language-sample")
    if sample.isEmpty():
        raise ValueError(f"the sample of {rows} labelled rows is empty")
    held_back = sample.filter(f"shard >= {SHARDS * 9}")
    weights = fit(sample.filter(f"shard < {SHARDS * 9}").withColumn("shard", F.col("shard") % SHARDS), len(names), idf)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"class": frame["class"], "scores": lists(weighed(c, k, idf) @ weights[c] for c, k in zip(frame["cells"], frame["counts"]))})

    held = held_back.mapInPandas(score, "class int, scores array<double>").toPandas()  # a tenth of the sample, a few numbers each
    scores = np.array(held["scores"].tolist()).reshape(-1, len(names))
    return {"names": names, "idf": idf, "weights": weights / temperature(scores, held["class"].to_numpy())}


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """All columns of ``docs`` (text, ...) packed as ``row``, with lang_pred and score."""
    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    if model is None:
        return packed.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES cells per language

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        names, idf, weights = (shared.value[k] for k in ("names", "idf", "weights"))
        found = []
        for text in texts:
            if not has_letter(text):
                found.append((UNKNOWN, 0.0))
                continue
            cells, counts = features(text)
            chance = chances(weighed(cells, counts, idf) @ weights[cells])
            best = int(chance.argmax())
            found.append((names[best], float(chance[best])))
        return pd.DataFrame(found, columns=["lang", "score"])

    guessed = packed.withColumn("guess", guess("text"))
    return guessed.select("row", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document (doc_id, text, lang)."""
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with at least ``least_score``."""
    found = predict(docs, train(docs)).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return found.select("row.*")
