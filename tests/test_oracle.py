"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry
from oracle import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    corpora = {*entry.corpora.queries(), "pipeline"} if entry.corpora else set()
    assert set(entry.queries()) - corpora == set(entry.oracle_sql()) - corpora
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, name):
    same, got, want, _ = compare(spark, SF, name)
    assert same, (got, want)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
