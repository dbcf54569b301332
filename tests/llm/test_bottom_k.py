import random

import xxhash
from pyspark.sql import functions as F

from gearwatch.llm import bottom_k as B
from tests.llm.helpers import corpus, odd_rows, prose, sha, table, words


def chain(hashes, seed=42):
    for h in hashes:
        seed = xxhash.xxh64_intdigest((h & 2**64 - 1).to_bytes(8, "little"), seed=seed)
    return seed - 2**64 if seed >= 2**63 else seed


def plain(text, size=B.SIZE):
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words((text or "").lower())]
    grams = {chain(hashes[i:i + 5]) for i in range(len(hashes) - 4)} or ({chain(hashes)} if hashes else set())
    return sorted(grams)[:size], grams


def shown(hashes):
    return "".join(f"{h & 2**64 - 1:016X}" for h in hashes)


def like(a, b, size=B.SIZE):
    both = sorted(set(a) | set(b))[:size]
    return sum(h in a and h in b for h in both) / len(both) if both else 1.0


def test_report_equals_plain_fingerprints(spark):
    rows = list(enumerate(corpus(5)))
    random.Random(1).shuffle(rows)
    rows.append((400, " ".join(prose(900, 8))))
    found = {r.doc_id: r for r in B.report(table(spark, rows).selectExpr("*", "1 AS sketch", "2 AS hash", "3 AS range")).collect()}
    ordered = sorted(rows, reverse=True)
    for at, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, changed, other = (plain(t)[0] for t in (text, edited, after))
        r = found[doc]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), sha(edited), shown(own), shown(changed))
        assert abs(r.near_edited - like(own, changed)) < 1e-12 and abs(r.near_next - like(own, other)) < 1e-12
    assert len(found) == len(rows)


def test_ranges_follow_one_another(spark, monkeypatch):
    """The same neighbours with many ranges of ids, gaps, repeated and missing ids."""
    rows = odd_rows(corpus(6)) + [(10**12, "far away"), (10**12 + 5, "x y z"), (9 * 10**18, "the highest"), (-9 * 10**18, "the lowest"), (2**62, "between")]
    one = sorted(map(tuple, B.report(table(spark, rows)).collect()), key=repr)
    monkeypatch.setattr(B, "RANGE_ROWS", 3)
    monkeypatch.setattr(B, "LEAST_SHIFT", 1)
    assert B.range_shift(table(spark, rows)) == 1
    assert sorted(map(tuple, B.report(table(spark, rows)).collect()), key=repr) == one
    assert len(one) == len(rows)


def test_estimates(spark):
    a, b = prose(600, 1), prose(600, 2)
    texts = [" ".join(a), " ".join(a[:450] + b[:150]), " ".join(a + b), " ".join(a[:30])]
    frame = table(spark, texts).select("doc_id", B.sketch(F.col("text"), 256).alias("s"))
    s = {r.doc_id: plain(texts[r.doc_id], 256) for r in frame.collect()}
    assert all(r.s == s[r.doc_id][0] for r in frame.collect())
    pairs = frame.alias("x").join(frame.alias("y"), F.col("x.doc_id") < F.col("y.doc_id")).select(
        F.col("x.doc_id").alias("i"), F.col("y.doc_id").alias("j"), B.resemblance(F.col("x.s"), F.col("y.s"), 256).alias("r"),
        B.containment(F.col("x.s"), F.col("y.s"), 256).alias("c"), B.distinct_shingles(F.col("x.s"), 256).alias("n"), B.merged(F.col("x.s"), F.col("y.s"), 256).alias("m"))
    for r in pairs.collect():
        x, y = s[r.i][1], s[r.j][1]
        assert abs(r.r - len(x & y) / len(x | y)) < 0.12 and abs(r.c - len(x & y) / len(x)) < 0.2 and abs(r.n / len(x) - 1) < 0.25
        assert r.m == sorted(x | y)[:256]


def test_group_sketches_and_empty_table(spark):
    docs = table(spark, corpus(7))
    rows = {r.source: r.sketch for r in B.group_sketches(docs, "source").collect()}
    for source in ("s0", "s1", "s2"):
        grams = set()
        for r in docs.filter(F.col("source") == source).collect():
            grams |= plain(r.text)[1]
        assert rows[source] == sorted(grams)[:B.SIZE]
    assert B.report(docs.limit(0)).count() == 0
    only = B.report(table(spark, ["a b c d"])).first()
    assert only.near_next == 1.0 and only.edited_sha256 == sha("a b " + "a b")


def test_far_ids_do_not_widen_the_ranges(spark):
    ids = [*range(5000), 2**62, -9 * 10**18]
    docs = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string").withColumn("hash", F.lit(1))
    shift = B.range_shift(docs)
    assert max(r["count"] for r in docs.groupBy(F.shiftright("doc_id", shift)).count().collect()) <= B.RANGE_ROWS and shift == 10
    found = {r.doc_id: r.next_doc_id for r in B.with_next(docs, ["doc_id"]).collect()}
    assert found == {2**62: 4999, **{i: i - 1 for i in range(1, 5000)}, 0: -9 * 10**18, -9 * 10**18: 2**62}
