"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import oracle
from check import connect, difference
from conftest import SMALL
from salesmart.plans import catalog


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.QUERIES)
    assert set(catalog.QUERIES) <= set(entry_points.queries())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, db, name):
    assert difference(entry_points.queries()[name](spark, SMALL), db, entry_points.oracle_sql()[name]) is None


def test_fixture_totals(spark):
    """The totals FIXTURES.md lists for this scale."""
    from pyspark.sql import functions as F

    from salesmart import fixtures as fx
    from salesmart.functions.measures import with_measures

    checked = fx.validated(spark, SMALL)
    by_code = {r[0]: r[1] for r in checked.groupBy(F.split("rejection_reason", ":")[0]).count().collect()}
    assert by_code == {
        None: 5565, "DUPLICATE": 99, "V01": 56, "V02": 55, "V03": 53, "V04": 47, "V05": 93, "V06": 45, "V07": 43,
    }
    fact = with_measures(fx.fact(spark, SMALL))
    totals = fact.agg(
        F.count("*"), F.sum("quantity"), F.sum("gross_revenue"), F.sum("discount_amount"), F.sum("net_revenue")
    ).first()
    assert [str(value) for value in totals] == ["5484", "126921", "115477699.00", "5882300.1430", "109595398.8570"]
