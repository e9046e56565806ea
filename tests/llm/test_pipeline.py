"""The pipeline and the registered queries."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import samples  # noqa: E402
from test_near import plain_classes  # noqa: E402
from compare import _rows, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import language, sanitise  # noqa: E402
from tidemark.llm.queries import ORACLES, QUERIES  # noqa: E402


def test_every_operator_has_its_query():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = connect(sf_dir).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op11_variants"}))
def test_query_returns_every_document(spark, sf_dir, name):
    ids = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
                 .select("doc_id").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, sf_dir).collect()) == ids


def test_stages_on_awkward_rows(spark):
    docs = samples.table(spark, clashes=True)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "").cache()
        if name != "encode":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = out
        docs = out
    model = language.train(samples.table(spark))
    known = {r.doc_id for r in language.identify(samples.table(spark), model).collect() if r.known}
    assert {r.doc_id for r in seen["language"].collect()} == known
    rows = sorted(map(tuple, seen["language"].select("doc_id", "text").collect()))
    assert {r.doc_id for r in seen["near_duplicates"].collect()} == plain_classes(rows)
    before = seen["near_duplicates"].count()
    assert seen["personal_data"].count() == before
    assert not any(sanitise.base_spans(r.text) for r in seen["personal_data"].collect())
    assert seen["encode"].count() == seen["mix"].count()


def test_stages_on_an_empty_table(spark):
    docs = samples.table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run_repeats(spark, sf_dir):
    one, two = (sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
                for _ in range(2))
    assert one == two and one
