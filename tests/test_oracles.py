"""Every query of the matching engine against its SQL, at the smallest scale."""

import pytest
from conftest import SMALL, same_rows

from pairwright.plans import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    assert same_rows(queries.QUERIES[name](spark, SMALL).toPandas(), duck.sql(queries.ORACLES[name]).df())


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"score_pairs", "feature_matrix", "sample_exact"} <= set(entry.queries())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
