"""Queries of spoiled lines make each line once."""

import pytest

from barlake.plans.catalog import all_queries


@pytest.mark.parametrize("name", ["require_fields", "quarantine_trades", "row_mode_trades"])
def test_lines_are_made_once(spark, name):
    plan = all_queries()[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan
