"""Spelling variants against comparing every word with every other one."""

import random
import re
import zlib
from collections import Counter

from gearwatch.llm import permuterm
from tests.llm.helpers import SCHEMA, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(permuterm.UPPER, permuterm.LOWER)


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts):
    forms, rows = {}, {}
    for word, n in counts.items():
        others = [(-m, o) for o, m in counts.items() if o != word and near(word, o)]
        best = min(others, default=None)
        forms[word] = best[1] if best and -best[0] >= 2 * n else None
        rows[word] = n, len(others)
    found = []
    for word, (n, count) in rows.items():
        root = word
        while forms[root]:
            root = forms[root]
        found.append((word, forms[word], root, n, count, counts[forms[word]] if forms[word] else None))
    return sorted(found)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def spellings(seed):
    rng = random.Random(seed)
    base = ["aaaaaa", "aaaaa", "banana", "bananna", "éclairs", "Éclairs", "naïveté", "schule", "schulen", "mississippi", "x" * 200, "x" * 199 + "y", "x" * 199]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(1, 60)):
            word = rng.choice(base)
            if rng.random() < 0.4:
                at = rng.randrange(len(word))
                word = rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice("abné") + word[at:], word[:at] + rng.choice("abné") + word[at + 1:]])
            words.append(word.capitalize() if rng.random() < 0.2 else word)
        texts.append(rng.choice([" ", "\n", ", ", "7"]).join(words))
    return texts


def test_equals_all_pairs(spark):
    for seed in (1, 2):
        texts = spellings(seed) + [None, "", " \n", "123 #", "日本語 слово"]
        rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4])]
        wanted = plain(plain_counts(rows))
        assert got(permuterm.report(table(spark, rows))) == wanted
        assert any(form for _, form, *_ in wanted)


def test_each_pair_meets_once(spark):
    counts = {"aaaaaaa": 40, "aaaaaa": 20, "aaaaa": 10, "aaaaab": 5, "baaaaa": 5, "abaaaa": 3}
    assert got(permuterm.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)


def test_ties_go_to_the_first_in_code_point_order(spark):
    counts = {"tanne": 3, "kanne": 9, "wanne": 9, "pänne": 9, "panne": 9, "ébène": 4, "ébéne": 9, "ebène": 9}
    assert got(permuterm.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)


def test_a_long_chain_of_forms(spark):
    counts = {"abcdefghijklmnop"[:k]: 3 * 2**k for k in range(5, 17)}
    rows = got(permuterm.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert rows == plain(counts) and {root for _, _, root, *_ in rows} == {"abcdefghijklmnop"}


def test_empty_tables(spark):
    empty = permuterm.report(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert permuterm.report(table(spark, [None, ""])).collect() == []


def test_more_parts_than_rows_and_clashing_names(spark):
    texts = spellings(3)[:6]
    df = table(spark, texts).selectExpr("*", "1 AS word", "2 AS n", "3 AS id", "4 AS run").repartition(50)
    assert got(permuterm.report(df)) == plain(plain_counts(list(enumerate(texts))))
