"""Every catalogue query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_compare import compare, connect
from parcelflow.catalogue.queries import CATALOGUE

pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_twin(spark, con, sf_dir, name):
    faults = compare(spark, con, name, queries()[name], oracle_sql()[name], sf_dir)
    assert faults == []


def test_every_query_of_the_catalogue_has_a_twin():
    assert [name for name, item in CATALOGUE.items() if not item.sql] == []


def test_entry(spark):
    assert entry(spark).count() > 0
