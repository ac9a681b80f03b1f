"""Registered queries against their SQL, the pipeline against brute force, and the guard."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from test_bpe import expected, library  # noqa: F401
from test_pairs import brute_components, brute_leaks, brute_lines, words

import corpus_pipeline
from arrivals_engine.llm import bpe, langid, quality, queries, shingles
from arrivals_engine.llm.common import table

DATA = "/root/testdata"
ROOT = Path(__file__).resolve().parents[2]


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.01/{t}.parquet'")
    want = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = queries.queries()[name](spark, f"{DATA}/sf0.01")
    assert in_order(map(tuple, got.select(*names).collect())) == in_order(want.fetchall())


def documents(sf):
    rows = pq.read_table(f"{DATA}/{sf}/documents.parquet").to_pylist()
    return [(r["doc_id"], r["text"]) for r in rows]


def test_near_duplicates_of_the_documents(spark):
    rows = documents("sf0.001")
    got = shingles.components(table(spark, f"{DATA}/sf0.001", "documents")).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_pipeline_equals_brute_force(spark, library):  # noqa: F811
    sf_dir = f"{DATA}/sf0.001"
    tables = [table(spark, sf_dir, name) for name in ("documents", "labels")]
    verdicts = {r["doc_id"]: r["kept"] for r in quality.verdicts(*tables).collect()}
    rows = [r for r in documents("sf0.001") if verdicts[r[0]]]
    rows = [(i, text) for i, _, _, text in brute_lines(rows, 10)]
    component = {i: c for i, _, c in brute_components(rows)}
    rows = [r for r in rows if component[r[0]] == r[0]]
    items = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    grams = lambda w: {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    bad = set()
    for i, text in rows:
        # 80 % of ten or more words in places that agree hold three in a row
        near = [x for x in items if grams(words(text)) & grams(words(x[1]))]
        bad |= {doc for doc, _ in brute_leaks([(i, text)], near)}
    want = [(i, *expected(library, t)) for i, t in rows if i not in bad]
    assert 0 < len(want) < len(rows) < len(verdicts)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_stages_keep_the_columns_and_stand_empty_input(spark):
    docs = table(spark, f"{DATA}/sf0.001", "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, f"{DATA}/sf0.001")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.collect() == []


def test_language_of_held_out_documents(spark):
    docs = table(spark, f"{DATA}/sf0.01", "documents")
    found = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    hits = found.where("lang_pred = lang").count()
    assert hits > 0.97 * found.count() > 0


def test_the_rest_stands_without_this_package(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "spark-warehouse", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; n = set(e.queries()); assert n == set(e.oracle_sql()) and 'visits' in n"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True)


def test_every_query_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 11))
    assert bpe.PATTERN == __import__("public_tokenizers").PATTERN
