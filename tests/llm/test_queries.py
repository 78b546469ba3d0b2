"""Registered queries: each covers its whole table; SQL where there is some."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as E  # noqa: E402
import oracle_check  # noqa: E402
from wayfarer.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    r = oracle_check.check(spark, oracle_check.duck(SF), SF, name)
    assert r["ok"], r["problems"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] in ("op1", "op2", "op4", "op8", "op9", "op11", "op13")])
def test_one_row_per_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()]
    want = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(want)
