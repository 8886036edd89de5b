"""Every registered query against its SQL."""

import oracle
import pytest

from __spark_entry__ import entry
from registry.oracles import ORACLES
from registry.queries import QUERIES

ROWS_ONLY = {"reward_fit", "reward_scores", "value_fit", "value_scores"}

# The user's reward function; lines read by byte range; sketches of a task's rows.
PYTHON = {"reward_callback", "read_keyless", "export_ordered"}


@pytest.fixture(scope="module")
def database(sf_dir):
    return oracle.connect(sf_dir)


def test_only_model_fits_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ("Python" in plan) == (name in PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert oracle.difference(df, database, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_queries_give_finite_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    assert all(value is not None and value == value for row in rows for value in row)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["conv_id", "turn", "prompt", "chosen", "rejected"] and df.count() == 34
