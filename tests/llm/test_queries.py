"""Registered text queries against their SQL, and the pipeline against plain versions of its stages."""

import glob
import os
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gearwatch.llm import common, queries
from tests.llm import test_parity_join, test_repeats
from tests.llm.helpers import words


@pytest.fixture(scope="module")
def tables(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)} and len(queries.QUERIES) == 13


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, folder, tables, name):
    df = queries.QUERIES[name](spark, folder)
    cursor = tables.execute(queries.SQL[name])
    assert normal(df.columns, df.collect()) == normal([c[0] for c in cursor.description], cursor.fetchall())


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Rows that went into each stage and came out of it, and the columns."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, docs, folder), name)
        found[name] = docs.collect(), out.collect(), (docs.columns, out.columns)
        docs = out
    return found


def test_all_stages_but_the_last_return_documents(stages):
    assert list(stages) == ["language_id", "near_duplicates", "repeated_passages", "mixing", "bpe_tokens"]
    assert all(before == after for name, (_, _, (before, after)) in stages.items() if name != "bpe_tokens")


def test_language_stage_keeps_what_it_recognises(stages):
    before, after, _ = stages["language_id"]
    assert set(after) <= set(before) and len(after) > 0.97 * len(before)


def test_near_duplicate_stage(stages):
    before, after, _ = stages["near_duplicates"]
    components = {doc: component for doc, _, component in test_parity_join.plain([(r.doc_id, r.text) for r in before])}
    assert sorted(after) == sorted(r for r in before if components[r.doc_id] == r.doc_id) and len(after) < len(before)


def test_passage_stage(stages):
    before, after, _ = stages["repeated_passages"]
    wanted = test_repeats.plain_words([(r.doc_id, r.text) for r in before])
    text = {r.doc_id: r.text for r in after}
    for r in before:
        n_words, removed, kept = wanted[r.doc_id, r.text]
        if removed == n_words:
            assert r.doc_id not in text
        else:
            assert test_repeats.sha(" ".join(words(text[r.doc_id]))) == kept
    assert all(r.n_chars == len(r.text) for r in after) and any(r.text != b.text for r in after for b in before if b.doc_id == r.doc_id)


def test_mixing_and_token_stages(stages):
    before, after, _ = stages["mixing"]
    assert sorted(before) == sorted(after)
    before, after, _ = stages["bpe_tokens"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ids = {r.doc_id: r.ids for r in after}
    assert len(after) == len(before) and all(ids[r.doc_id] == tokenizer.encode(r.text, add_special_tokens=False).ids for r in before)


def test_run_applies_all_stages(spark, folder, stages):
    assert sorted(corpus_pipeline.run(spark, folder).collect()) == sorted(stages["bpe_tokens"][1])


def test_entry_works_without_the_text_operators(tmp_path):
    """The contract file imports, and has all other queries, where the package and the pipeline are missing."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in os.listdir(root):
        if name.endswith(".py") and name != "corpus_pipeline.py" or name == "registry":
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "gearwatch")
    for name in os.listdir(f"{root}/gearwatch"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{root}/gearwatch/{name}", tmp_path / "gearwatch" / name)
    os.remove(tmp_path / "__spark_entry__.py")
    with open(f"{root}/__spark_entry__.py") as source, open(tmp_path / "__spark_entry__.py", "w") as copy:
        copy.write(source.read())
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1_') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}, timeout=120)
    assert done.returncode == 0, done.stderr
    count, has_text, has_sql = done.stdout.split()
    assert int(count) > 70 and has_text == "False" and has_sql == "True"
