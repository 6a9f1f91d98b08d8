"""The queries are registered, and each dealt operator has one."""

import re

import pytest

import __spark_entry__ as entry
from tickloom.llm.queries import QUERIES


def test_every_operator_has_a_query():
    names = entry.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows(spark, name):
    text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
