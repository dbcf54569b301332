from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from gearwatch.llm import language_ftrl as L
from tests.llm.helpers import SCHEMA, table


def test_held_out_accuracy_and_odd_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = [(None, "sin id pero con texto", None), (-1, None, "en"), (-2, "", "en"), (-3, "123 !? ²", "fr"), (-4, "a", None), (-5, "x" * 50_000, None), (-5, "x" * 50_000, None)]
    rows = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string")).selectExpr("*", "0.5 AS score", "'zz' AS row")
    found = L.identify(rows).collect()
    assert len(found) == docs.count() + len(odd)
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in lang]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"} for r in found)
    for r in found:
        if r.doc_id in (-1, -2, -3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id in (-4, -5):
            assert r.lang_pred != "und"


def test_prediction_uses_the_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = L.train(docs)
    one = {r.row.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    other = docs.select("doc_id", "text", F.lit("es").alias("lang"))
    assert {r.row.doc_id: (r.lang_pred, r.score) for r in L.predict(other, model).collect()} == one


def test_nothing_to_learn(spark):
    docs = table(spark, ["some text", None, "more"])
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in L.identify(unlabelled).collect()} == {("und", 0.0)}
    assert L.known_language(unlabelled).count() == L.identify(docs.limit(0)).count() == 0


def test_one_language_and_kept_columns(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", "en", None, 3) for i in range(30)] + [(40, "...", "en", "s", 1)], SCHEMA)
    kept = L.known_language(docs)
    assert kept.columns == docs.columns and kept.count() == 30


def test_frequencies_and_calibration(spark):
    texts = ["abc abc", "abd", None, ""]
    frequency, rows = L.document_frequencies(table(spark, texts))
    wanted = np.zeros(L.FEATURES, int)
    for text in texts[:2]:
        wanted[L.features(text)[0]] += 1
    assert rows == 4 and (frequency == wanted).all()
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in L.chances(scores)])
    assert 0.85 < L.temperature(scores, labels) < 1.2 and 2.5 < L.temperature(3 * scores, labels) < 3.6
    assert L.leader_weights(np.array([0.01, -5.0, 5.0]), np.ones(3)).tolist()[0] == 0.0
