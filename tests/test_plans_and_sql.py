"""Plans stay free of nested loops, and a cross-section of queries equals its SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
SQL = ["agg_region_kpi", "agg_customer_360", "dq_metrics", "win_dedup", "fn_signin_features", "agg_user_profile", "agg_heatmap",
       "agg_crosstab", "rule_email_score", "rule_signin_score", "set_alerts_union", "mon_reasons", "win_latest_per_key", "od_copod",
       "od_lof", "ev_threshold_sweep", "ev_feedback_join", "ts_max_z", "join_event_in_bucket", "tx_tfidf", "rs_email_composite",
       "st_bucket_metrics", "sink_append"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SQL)
def test_equals_sql(spark, con, name):
    verdict = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", ["agg_customer_360", "fn_signin_features", "set_alerts_union", "join_event_in_bucket", "ts_alert_union",
                                  "od_label_threshold", "srt_context_slice"])
def test_no_nested_loop(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pushdown_and_pruning(spark):
    plan = entry.queries()["agg_by_hour"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_every_sql_has_a_query_and_no_session_is_needed():
    assert set(entry.oracle_sql()) <= set(entry.queries())
