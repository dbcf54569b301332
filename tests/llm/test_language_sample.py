"""The sample that language weights are fitted on: never empty, and with rows of every language."""

import random
from collections import Counter

import pytest

from gearwatch.llm import language_ftrl as L
from tests.llm.helpers import SCHEMA


def speech(spark, sizes):
    """Random words of letters that each language has for itself."""
    rng, letters = random.Random(2), {"aa": "abcdef", "bb": "ghijkl", "zz": "mnopqr"}
    rows = [(i, " ".join("".join(rng.choices(letters[s], k=5)) for _ in range(12)), s, None, 60) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("share", [1.0, 0.02, 1e-7])
def test_rare_language_is_learned_whatever_the_share(spark, share):
    sizes = {"aa": 1500, "bb": 1500, "zz": 40}
    docs = speech(spark, sizes)
    model = L.train(docs, share * sum(sizes.values()))
    found = L.predict(docs, model).select("row.lang", "lang_pred", "score").collect()
    for name, n in sizes.items():
        assert sum(r.lang == r.lang_pred == name and r.score >= 0.5 for r in found) > 0.95 * n


def test_draw_is_bounded_below_and_above(spark):
    docs = speech(spark, {"aa": 4000, "bb": 900, "zz": 30})
    names, picked = L.drawn(docs.select("doc_id", "text", "lang"), 1000, 100)
    count = Counter(r.lang for r in picked.collect())
    assert names == ["aa", "bb", "zz"] and count["zz"] == 30
    assert 700 < count["aa"] < 930 and 130 < count["bb"] < 240
    names, picked = L.drawn(docs.select("doc_id", "text", "lang"), 1e-9, 1e-9)
    assert Counter(r.lang for r in picked.collect()) == {"aa": 1, "bb": 1, "zz": 1}


def test_limits_of_very_large_tables():
    rows = {"aa": 10**13, "bb": 10**12, "zz": 10**6, "few": 3}
    limits = L.draw_limits(rows, dict.fromkeys(rows, 0), L.SAMPLE_ROWS, L.LEAST_ROWS)
    expected = {name: n * limits[name] / 2**63 for name, n in rows.items()}
    assert 5000 < expected["aa"] < 6000 and expected["bb"] > 499 and expected["zz"] > 499 and expected["few"] == 3
