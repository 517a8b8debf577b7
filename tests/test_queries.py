import pytest

import __spark_entry__ as entry_points
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"
# The text operators have tests of their own.
from pacegrid.plans.registry import ORACLES, QUERIES  # noqa: E402



@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) == ""


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:2] == ["index", "time"] and frame.count() > 0


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("latlng_split", 0),
        ("channel_explode", 0),
        ("props_parse", 0),
        ("conform_columns", 0),
        ("high_water_mark", 1),
        ("processed_ids", 1),
        ("sample_repeats", 1),
    ],
)
def test_shuffles(spark, name, exchanges):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == exchanges
    assert "Python" not in plan and "CartesianProduct" not in plan
