import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gearwatch.llm import bpe_lexicon as E
from tests.llm.helpers import corpus, odd_rows, sha, table

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aAbBtTsS'lLvVeE 012½²Ⅷ \t\n\x0b\x1c\x1d\x85\xa0 　Σσİßẞ́ñ你한가हि\U0001f642‍!?#-_"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def strange(count):
    rng = random.Random(3)
    for i in range(count):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30)))
        yield text[:5] + "<|startoftext|>" + text[5:] + "<|endoftext|>" if i % 7 == 0 else text


def test_ids_equal_the_library(library):
    merges = E.Merges(PATH)
    words = sorted({w for text in corpus() for piece in E.pieces(text or "") for w in E.words_of(piece)})
    with_lexicon = E.Encoder(merges, None)
    for text in [*strange(3000), *(t or "" for t in corpus()), "ab" * 5000 + "é" * 3000]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert with_lexicon.encode(text) == ids
        assert with_lexicon.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert words


def test_lexicon_is_exact_and_minimal(tmp_path):
    merges, rng = E.Merges(PATH), random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))).encode() for _ in range(500)} | {"ñandú".encode(), b"the", b"then", b"x" * 300})
    place = tmp_path / "lexicon"
    place.write_bytes(E.compile_lexicon((w, merges.merge(w)) for w in words))
    lexicon = E.Lexicon(str(place))
    for word in words:
        assert lexicon.ids_of(word) == merges.merge(word)
        for other in (word[:-1], word + b"a"):
            assert (lexicon.ids_of(other) is None) == (other not in words)
    endings = {b""}  # states of a minimal automaton: different sets of endings
    rights = {}
    for word in words:
        for i in range(len(word) + 1):
            rights.setdefault(word[:i], set()).add(word[i:])
    assert lexicon.root + 1 == len({frozenset(r) for r in rights.values()}) and endings
    place.write_bytes(E.compile_lexicon([]))
    assert E.Lexicon(str(place)).ids_of(b"a") is None


def test_documents_equal_the_library(spark, library):
    rows = odd_rows(corpus(12) + list(strange(200)))
    found = E.digests(table(spark, rows).selectExpr("*", "1 AS made", "2 AS n_tokens"), PATH).collect()
    wanted = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_records_and_lexicon_size(spark, library, monkeypatch):
    """Ids do not depend on the lexicon or on what the summary drops."""
    docs = table(spark, corpus(13))
    monkeypatch.setattr(E, "CACHE", 50)
    for limit, kept in ((0, 10), (20, 30), (50_000, 100_000)):
        words = E.frequent_words(docs, limit, kept)
        assert len(words) <= limit
        monkeypatch.setattr(E, "frequent_words", lambda d, n=0, w=words: w)
        for r in E.records(docs, PATH).collect():
            text = next(t for i, t in enumerate(corpus(13)) if i == r.doc_id)
            assert r.ids == library.encode(text or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        monkeypatch.undo()
    assert E.frequent_words(docs, 3) and E.digests(docs.limit(0), PATH).count() == 0


def test_most_frequent_words(spark):
    docs = table(spark, ["the cat the dog the", "cat The", None, "dog, cat."])
    assert E.frequent_words(docs, 3) == [b"the", b"cat", b"dog"]


def test_a_full_cache_keeps_the_words_before(monkeypatch):
    """Words met shortly before the cache was full are not merged again."""
    monkeypatch.setattr(E, "CACHE", 4)
    encoder, asked = E.Encoder(E.Merges(PATH)), []
    merge = encoder.merges.merge
    monkeypatch.setattr(encoder.merges, "merge", lambda word: asked.append(word) or merge(word))
    words = [b"qwone", b"qwtwo", b"qwthree", b"qwfour", b"qwfive", b"qwfour", b"qwfive"]
    found = [encoder.word(word) for word in words]
    assert asked == words[:5] and found[3] == found[5] and found[4] == found[6]
