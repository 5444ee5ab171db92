"""Every registered query against its SQL answer on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries(), oracle_sql()


def test_every_answer_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, SF), SF, ORACLE[name]) == []
