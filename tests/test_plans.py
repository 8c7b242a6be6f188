"""Plan properties the scale design relies on, checked on the physical plans
(no execution needed beyond what building a query does)."""

from __future__ import annotations

import os
import re

import pytest

from obsengine.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def queries():
    registry.load_all()
    return registry.QUERIES


def test_dedup_limits_before_the_shuffle(spark, queries):
    plan = plan_of(queries["clean_weather"](spark, SF))
    partial = [m.start() for m in re.finditer(r"WindowGroupLimit .*Partial", plan)]
    assert partial
    # A child is printed after its parent: the partial limit feeds the exchange.
    assert plan.rfind("Exchange hashpartitioning") < partial[-1]


def test_aggregates_are_partial(spark, queries):
    plan = plan_of(queries["daily_weather"](spark, SF))
    assert len(re.findall(r"HashAggregate", plan)) >= 2  # partial + final around one exchange


def test_scans_read_only_used_columns(spark, queries):
    plan = plan_of(queries["price_anomaly"](spark, SF))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert schemas == {"struct<ts:timestamp_ntz,user_id:bigint,value:double>"}


def test_filters_reach_the_scan(spark, queries):
    plan = plan_of(queries["upsert_fact"](spark, SF))
    assert "LessThan(l_shipdate," in plan and "GreaterThanOrEqual(l_shipdate," in plan
    assert "LessThanOrEqual(p_size,30)" in plan


@pytest.mark.parametrize("name", ["daily_weather", "weather_anomaly", "price_anomaly", "daily_price",
                                  "latest_price", "upsert_fact", "html_card_extract", "url_resolve",
                                  "json_hourly_explode", "constraint_report"])
def test_no_python_in_the_data_path(spark, queries, name):
    plan = plan_of(queries[name](spark, SF))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|PythonUDF", plan)
