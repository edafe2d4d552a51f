"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import pytest

from paths import SF_SMALL
from ledgerspark.plans.registry import QUERIES, READ_ONLY

TOP_K = [
    "volume_daily", "pattern_branch_top15", "risk_high_value_cash", "risk_structuring",
    "risk_high_velocity", "txn_branch_type_top15", "risk_high_value_cash_channel",
    "risk_open_aml_alerts", "risk_low_cibil",
]


def plan(spark, name, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF_SMALL).explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(spark, n) for n in READ_ONLY}


def test_no_cartesian_or_nested_loop_joins(plans):
    for n, p in plans.items():
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, n


def test_top_k_without_full_sort(plans):
    for n in TOP_K:
        assert "TakeOrderedAndProject" in plans[n], n


def test_hash_aggregation_everywhere_but_the_bounded_text_span(plans):
    for n, p in plans.items():
        if n != "risk_high_velocity":
            assert "SortAggregate" not in p, n
    p = plans["risk_high_velocity"]
    # plan text is top-down: what stands below the ranking's top-k neither
    # sorts for an aggregate nor expands rows
    below = p[p.index("TakeOrderedAndProject") :]
    assert "SortAggregate" not in below and "Expand" not in below
    # the distinct counts expand groups (an aggregate stands below), not rows
    expand = p[p.index("Expand") :]
    assert "SortAggregate" in expand[: expand.index("Join")]


def test_only_joins_are_of_aggregates(plans):
    for n, p in plans.items():
        if n != "risk_high_velocity":
            assert "Join" not in p, n


def test_share_of_total_reuses_the_aggregate(plans, spark):
    p = plans["pattern_channel"]
    assert "Window" not in p
    df = QUERIES["pattern_channel"](spark, SF_SMALL)
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString()
    final = ran[: ran.index("Initial Plan")] if "Initial Plan" in ran else ran
    assert "ReusedExchange" in final or "Reuse" in final


def test_scans_read_only_used_columns(plans):
    for n, p in plans.items():
        assert "props:" not in p, n  # events.props is never needed
    # amount, date and customer derive from exactly these five columns
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" \
        in plans["txn_data_quality"]
    # the NPA summary needs three of the six orders columns
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plans["risk_npa_summary"]
