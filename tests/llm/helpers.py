"""Small tables and plain versions that the operators are compared with."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def table(spark, texts, **extra):
    """Documents 0, 1, ... of the given texts; a pair (id, text) sets the id."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)], SCHEMA).repartition(4)


def prose(count, seed, vocabulary=4000):
    """Random words."""
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" if rng.random() < 0.7 else rng.choice(("the", "of", "ñu", "a")) for _ in range(count)]


def corpus(seed=1):
    """Texts with copies, near copies, shared passages, repeats inside a text, and odd cases."""
    rng = random.Random(seed)
    passage, base = prose(70, seed + 100), prose(150, seed + 200)
    texts = []
    for k in range(30):
        body = prose(rng.randrange(1, 200), seed * 1000 + k)
        if k % 3 == 0:
            at = rng.randrange(len(body))
            body[at:at] = passage[:rng.randrange(40, 71)]
        if k % 5 == 0:
            body += body[:60]
        texts.append(" ".join(body) if k % 2 else "\n".join(body))
    for k in range(25):
        body = list(base)
        for _ in range(k % 5):
            body[rng.randrange(len(body))] = f"edit{rng.randrange(1000)}"
        texts.append(" ".join(body))
    texts += [texts[3]] * 4 + [None, "", " \n\t ", "x", "=" * 700, "=" * 350 + "é" * 200, "na " * 300, "tab\tand\x0bthe rest"]
    rng.shuffle(texts)
    return texts


def odd_rows(texts):
    """The texts with repeated rows, a repeated id with another text, and ids that are null."""
    rows = list(enumerate(texts))
    return rows + [rows[2], rows[2], (5, "another text under a known id " * 12), (None, texts[0]), (None, " ".join(prose(80, 9)))]
