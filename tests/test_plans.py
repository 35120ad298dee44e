"""Plan shapes that would not survive a large input."""

import re

import pytest

import __spark_entry__ as entry
from rulemill.operators import payloads as pl
from rulemill.operators import profile as pf
from rulemill.sources.tables import load


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that only list what a stream or a sink wrote run their work first.
@pytest.mark.parametrize("name", [n for n in entry.queries() if not n.startswith(("stream_", "append_", "split_written"))])
def test_no_pair_products_or_global_windows(spark, sf, name):
    text = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # A window with no partition keys would pull its input into one task.
    for spec in re.findall(r"Window \[.*?windowspecdefinition\((.*?)specifiedwindowframe", text):
        assert not re.match(r"\s*\S+ (ASC|DESC)", spec), spec


def test_row_number_limits_are_cut_before_the_shuffle(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    assert plan_of(pl.eval_set(docs, ["lang"], "doc_id", 5)).count("WindowGroupLimit") == 2
    assert plan_of(pf.top_values(load(spark, sf, "orders"), ["o_orderstatus"], 3)).count("WindowGroupLimit") == 2


def test_top_n_is_distributed(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["latest_payloads"](spark, sf))
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["search_runs"](spark, sf))


def test_filters_and_columns_reach_the_scan(spark, sf):
    orders = load(spark, sf, "orders")
    text = plan_of(orders.where("o_totalprice > 1000").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in text
    text = plan_of(entry.queries()["violations_sales"](spark, sf))
    assert "l_tax" not in text and "o_totalprice" not in text and "l_linenumber" not in text
