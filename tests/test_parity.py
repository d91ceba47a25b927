"""Every registered query beside its SQL check, on whole results."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from parity import compare, reference

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return reference(sf_dir)


def test_every_check_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_only_models_lack_a_check():
    plain = {q for q in QUERIES if not q.startswith(("op", "pipeline"))}
    assert {q for q in plain if q not in SQL} == {"ml_train", "ml_tune", "ml_score"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], SQL[name], sf_dir) is None


def test_flagship(spark):
    assert entry.entry(spark).columns == ["date", "machine_type", "machine_id", "risk_level", "risk_count"]
