"""Every query against its SQL on whole (small) tables."""

from __future__ import annotations

import pytest

from checks.compare import difference, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    result = QUERIES[name](spark, SF)
    assert difference(result, connection, ORACLES[name]) is None
    # No pair of tables is joined row by row.
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
