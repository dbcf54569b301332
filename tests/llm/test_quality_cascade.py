import re

from pyspark.sql import functions as F

from gearwatch.llm import quality_cascade
from tests.llm.helpers import corpus, odd_rows, table, words


def plain(text):
    text = text or ""
    ws = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = {}
    for i in range(len(ws) - 7):
        windows.setdefault(tuple(ws[i:i + 8]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    n = len(ws)
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_counts_equal_plain_counts(spark):
    rows = odd_rows(corpus(2) + ["a b c " * 40, "one two three four five six seven eight nine " * 2, "same\nsame \nsame\n\n \nsame", "# * $ %" * 9, "🙂 é\n" * 25])
    found = quality_cascade.judge(table(spark, rows).selectExpr("*", "1 AS n_words", "2 AS words"))
    assert sorted([tuple(r)[:7] for r in found.collect()], key=repr) == sorted([(i, *plain(t)) for i, t in rows], key=repr)
    assert found.filter("base_failed AND kept").count() == 0


def test_verdict_does_not_depend_on_the_order(spark, monkeypatch):
    docs = table(spark, corpus(3) + ["w### " * 5 + "word " * 30, "LOUD WORDS!! " * 3 + " ".join(f"UP{i}!!" for i in range(40)), " ".join(f"1{i}23" for i in range(50))])
    one = sorted(map(tuple, quality_cascade.judge(docs).collect()), key=repr)
    monkeypatch.setattr(quality_cascade, "cascade_order", lambda counted, known, rows: list(known)[::-1])
    assert sorted(map(tuple, quality_cascade.judge(docs).collect()), key=repr) == one
    assert sum(not row[7] and not row[6] for row in one) >= 3


def test_order_is_by_rejections_per_cost(spark):
    counted = quality_cascade.base_counts(table(spark, ["a b"] * 40))
    order = quality_cascade.cascade_order(counted, {"never": F.lit(False), "always": F.col("n_words") > 0}, 100)
    assert order == ["always", "never"]


def test_empty_table(spark):
    assert quality_cascade.judge(table(spark, ["x"]).limit(0)).count() == 0


def test_clean_labelled_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality_cascade.judge(spark.read.parquet(f"{folder}/documents.parquet")).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    share = {(r.quality, r.base_failed): r.kept for r in judged.groupBy("quality", "base_failed").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1, False] > 0.995 and share[0, False] < 0.1
