"""Every registered query against its SQL, and the shape of every plan."""

from __future__ import annotations

import pytest
from conftest import MEDIUM, SMALL

from __spark_entry__ import entry
from compare import compare, database

from tariffmart.oracles import ORACLES
from tariffmart.registry import QUERIES

@pytest.fixture(scope="module")
def duck():
    return database(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan
    assert (problem := compare(name, result, duck, ORACLES[name])) is None, problem


def test_an_emptied_query_fails(spark, duck):
    """No rows agree with the SQL only where the SQL has none either."""
    name = "active_products"
    assert compare(name, QUERIES[name](spark, SMALL).limit(0), duck, ORACLES[name]) is not None


def test_entry(spark):
    result = entry(spark)
    assert result.count() == 28440
    assert len(result.columns) == 16


@pytest.mark.parametrize("name", ["price_as_of_daily", "discount_as_of_daily", "current_price_all", "top_price_per_sku"])
def test_best_row_is_limited_before_the_shuffle(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        plan = QUERIES["current_price"](spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "IsNull(effective_end)" in plan and "EqualTo(sku,SKU-10007)" in plan
