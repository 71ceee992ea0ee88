import re

import pytest

import __spark_entry__ as E
from conftest import SMALL

PURE = ["appraisal_report", "label_keywords", "split_fraction", "eval_metrics", "uri_parts",
        "uri_prefix", "capitalize", "day_token", "json_field", "latest_by_key",
        "latest_with_fallback", "attach_latest", "latest_model", "best_params", "route_paths",
        "target_first", "paths_joined", "links_joined", "page_links", "page_url",
        "jsonld_misses", "jsonld_prices", "jsonld_found", "hook_price_join", "notify_messages"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_python_in_plan(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_flagship_scan_is_pruned(spark):
    plan = _plan(E.queries()["appraisal_report"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem == ["struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,"
                        "l_extendedprice:double>"]


def test_routes_join_is_broadcast_nested_loop(spark):
    plan = _plan(E.queries()["route_paths"](spark, SMALL))
    assert "BroadcastNestedLoopJoin" in plan


def test_fraction_split_has_no_exchange(spark):
    assert "Exchange" not in _plan(E.queries()["split_fraction"](spark, SMALL))


@pytest.mark.parametrize("name", ["jsonld_prices", "jsonld_misses", "page_lookup"])
def test_page_parse_runs_once(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    # the only regex use is the one CASE in the parse projection (shared subexpression)
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("ld+json" in f for f in filters)
