import numpy as np
import pytest

from gearwatch.llm import induced_sorting, repeats, suffix_trees
from tests.llm.helpers import corpus, odd_rows, prose, sha, table, words

FAR = 2**63 - 1


def plain_bytes(rows, window=100):
    """Kept bytes by comparing every window with all earlier ones."""
    order = sorted({(FAR if i is None else i, __import__("hashlib").md5((t or "").encode()).digest(), (t or "").encode()) for i, t in rows})
    seen, result = set(), {}
    for doc, digest, body in order:
        gone = bytearray(len(body))
        for at in range(len(body) - window + 1):
            piece = body[at:at + window]
            if piece in seen:
                gone[at:at + window] = b"\1" * window
            seen.add(piece)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        result[doc, body] = (len(body), sum(gone), spans, sha(bytes(b for b, g in zip(body, gone) if not g)))
    return result


def plain_words(rows, window=50):
    least, result = {}, {}
    for i, t in rows:
        ws = words(t)
        for at in range(len(ws) - window + 1):
            key = tuple(ws[at:at + window])
            least[key] = min(least.get(key, FAR), FAR if i is None else i)
    for i, t in rows:
        ws, doc = words(t), FAR if i is None else i
        gone = [False] * len(ws)
        for at in range(len(ws) - window + 1):
            if least[tuple(ws[at:at + window])] < doc:
                gone[at:at + window] = [True] * window
        result[doc, t or ""] = (len(ws), sum(gone), sha(" ".join(w for w, g in zip(ws, gone) if not g)))
    return result


@pytest.mark.parametrize("hot", [500, 3])
def test_bytes_equal_plain_search(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    rows = odd_rows(corpus())
    wanted = plain_bytes(rows)
    found = induced_sorting.report(table(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(i, *wanted[FAR if i is None else i, (t or "").encode()]) for i, t in rows], key=repr)


@pytest.mark.parametrize("hot", [500, 3])
def test_words_equal_plain_search(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    rows = odd_rows(corpus(4))
    wanted = plain_words(rows)
    found = suffix_trees.report(table(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(i, *wanted[FAR if i is None else i, t or ""]) for i, t in rows], key=repr)


def test_whole_small_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wanted = plain_words(rows)
    assert {r[0]: tuple(r)[1:] for r in suffix_trees.report(docs).collect()} == {i: wanted[i, t or ""] for i, t in rows}
    wanted = plain_bytes(rows)
    assert {r[0]: tuple(r)[1:] for r in induced_sorting.report(docs).collect()} == {i: wanted[i, (t or "").encode()] for i, t in rows}


def test_pieces_of_long_texts(spark, monkeypatch):
    """Texts longer than a piece and runs longer than RUN give the same results."""
    monkeypatch.setattr(repeats, "PIECE", 130)
    monkeypatch.setattr(repeats, "RUN", 7)
    monkeypatch.setattr(repeats, "TOGETHER", 3000)
    rows = list(enumerate(corpus(7)))
    wanted = plain_words(rows)
    assert {r[0]: tuple(r)[1:] for r in suffix_trees.report(table(spark, rows)).collect()} == {i: wanted[i, t or ""] for i, t in rows}
    wanted = plain_bytes(rows)
    assert {r[0]: tuple(r)[1:] for r in induced_sorting.report(table(spark, rows)).collect()} == {i: wanted[i, (t or "").encode()] for i, t in rows}


def test_cleaned_texts(spark):
    shared = " ".join(prose(60, 3))
    rows = [(1, shared + " one"), (2, "two\n" + shared + "\nlast line"), (3, shared), (4, None), (5, "  "), (6, shared + " one")]
    docs = table(spark, rows).selectExpr("*", "'x' AS digest", "'y' AS body", "1 AS spans")
    found = suffix_trees.without_repeats(docs)
    assert found.columns == docs.columns
    assert {(r.doc_id, r.text) for r in found.collect()} == {(1, shared + " one"), (2, "two\nlast line"), (4, None), (5, "  ")}


def test_empty_table(spark):
    docs = table(spark, ["x"]).limit(0)
    assert suffix_trees.report(docs).count() == induced_sorting.report(docs).count() == suffix_trees.without_repeats(docs).count() == 0


@pytest.mark.parametrize("symbols, size", [(2, 60), (3, 400), (30, 500)])
def test_suffix_order(symbols, size):
    rng = np.random.default_rng(symbols)
    for k in range(10):
        text = rng.integers(1, symbols + 1, size)
        text = np.concatenate([text, text[:size // 2], [0], text]) if k % 2 else text
        ranks = induced_sorting.suffix_ranks(text)
        assert sorted(range(len(text)), key=lambda i: text[i:].tolist()) == np.argsort(ranks).tolist()
