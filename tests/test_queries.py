"""Every registered query against its SQL, and the shape of the plans."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from termloom.operators import term_vectors as terms
from termloom.plans.oracle import ORACLE
from termloom.plans.queries import QUERIES, corpus


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


WITHOUT_SQL = {"term_kmeans"}  # rounds until nothing changes; tested in test_term_documents.py


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLE)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    found = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLE[name])
    expected = table([d[0] for d in cursor.description], cursor.fetchall())
    assert found[0] == expected[0]
    assert found[1] == expected[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "rank", "term", "tf", "df", "idf", "tfxidf"]
    assert df.count() > 0


@pytest.mark.parametrize("absent", ["termloom.llm", "termloom.llm.queries", "corpus_pipeline", "tokenizers", "public_tokenizers"])
def test_entry_without_the_optional_package(absent):
    """The other queries are there without the training-data package, or without what it needs."""
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    told = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert told.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))], told.stderr


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_term_vectors_need_no_shuffle(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text AS contents")
    assert "Exchange" not in plan_of(terms.term_vectors(terms.with_vectors(rows), positions=True))


def test_best_terms_limit_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["best_terms_all_docs"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") >= 2
    assert "Partial" in plan


def test_one_document_is_pushed_to_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["doc_terms"](spark, sf_dir))
    assert "EqualTo(doc_id," in plan


def test_token_counts_agree(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    tokens = terms.tokenize(docs).count()
    vectors = terms.term_vectors(terms.with_vectors(docs))
    assert vectors.groupBy().sum("freq").first()[0] == tokens
