"""Registered queries against their check SQL, and the shape of their plans."""

import os

import pytest

import __spark_entry__ as entry
from adtrail.operators import touch
from adtrail.plans.registry import QUERIES
from adtrail.sources import testbed
from oracle.queries import ORACLE
from tests.compare import difference, duck

CHECKED = [
    "ads_daily_rollup", "channel_settled", "attribution_cascade", "attribution_export", "campaign_performance",
    "granular_hourly", "ad_level_summary", "daily_platform_comparison", "range_join_kpis", "sku_performance",
    "order_ad_mapping", "daily_ad_performance", "utm_hourly_metrics", "utm_ads_full_outer", "coverage_comparison",
    "hierarchy_rollup", "product_match_by_substring", "touch_linear", "touch_decay", "meta_ad_performance",
    "quality_score", "run_alerts", "latest_upsert", "audit_sample", "event_sessions", "live_orders", "sql_channel_rules",
    "utm_period_by_model", "constraint_report", "incremental_last_events",
]
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"]


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, small, con, name):
    df = entry.queries()[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    cur = con.execute(entry.oracle_sql()[name])
    rows = [tuple(r) for r in df.collect()]
    assert difference(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_filters_and_columns_reach_the_scan(spark, small):
    # What the touch models write as cut rows, and the same orders where nothing is written.
    orders = touch._conversion_rows(testbed.conversions(spark, small), touch.CONVERSION)
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in plan
    plan = entry.queries()["live_orders"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in plan
    plan = entry.queries()["channel_breakdown"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "events" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_other_queries_stay_without_an_optional_library():
    """A library that only the llm operators need may be missing."""
    import subprocess
    import sys

    hide = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) >= 147 and not any(k.startswith('op') and k[2].isdigit() for k in q), len(q); assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", hide], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_an_unknown_model_is_refused(spark, small):
    from adtrail.plans import registry, sql_functions

    inputs = registry.Inputs(spark, small)
    sql_functions.register_period_function(inputs.hourly(), *inputs.touches())
    with pytest.raises(Exception, match="unknown attribution model"):
        spark.sql("SELECT * FROM calculate_utm_attribution(DATE '2024-01-01', DATE '2024-02-01', 'guess')").collect()
