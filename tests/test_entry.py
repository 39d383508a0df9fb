"""Driver contract: entry smoke run and every registered query vs its oracle."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["cycle", "schema", "table"]


def test_every_query_has_an_oracle():
    import __spark_entry__ as e

    from masklens.plans import catalog

    # the corpus operators, where present, have brute-force tests of their own instead of some oracles
    assert set(catalog.QUERIES) <= set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_queries_match_oracles(spark, sf):
    import compare

    assert compare.check_all(spark, sf)
