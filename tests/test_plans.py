"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from quotewright.plans import bridge, market as mk

QUERIES = entry.queries()
# these return what they wrote, so their plans are plain scans
WRITES = re.compile(r"export_|market_run|ordered_write|full_refresh|audit_append|audit_record|pinned_|control_partition")
LAZY = [name for name in QUERIES if not WRITES.match(name)]


def _plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = _plan(QUERIES[name](spark, sf))
    found = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|ArrowEval\w*|BatchEval\w*|\w*InPandas", plan)
    assert found == []


def test_scans_read_only_what_is_used(spark, sf):
    plan = _plan(QUERIES["recon_pairs"](spark, sf))
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>\n", plan))
    assert schemas == {
        "event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double",
        "c_custkey:bigint,c_mktsegment:string",
    }
    assert "EqualTo(event_type,click)" in plan and "EqualTo(event_type,view)" in plan
    plan = _plan(QUERIES["nan_census"](spark, sf))
    assert re.findall(r"ReadSchema: struct<(.*?)>\n", plan) == [
        "l_extendedprice:double,l_discount:double,l_tax:double"
    ]


def test_row_rules_of_a_table_take_one_scan(spark, sf):
    plan = _plan(QUERIES["dq_row_rules"](spark, sf), "simple")
    assert plan.count("FileScan") == 1


def test_consensus_meets_both_sources_in_one_shuffle(spark, raw_prices):
    plan = _plan(bridge.consensus(raw_prices), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_names_do_not_travel_through_the_windows(spark, sf):
    tables = bridge.MarketTables(spark, sf)
    plan = _plan(mk.price_returns(tables, bridge.MARKET), "simple")
    window = plan[plan.index("Window"):]
    spans = [line for line in window.splitlines() if "Exchange hashpartitioning" in line and "_part" in line]
    assert spans and "ticker" not in window.split("Union")[0]


@pytest.fixture(scope="module")
def raw_prices(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("prices") / "p")
    bridge.MarketTables(spark, sf)["fact_price_daily"].write.parquet(path)
    return spark.read.parquet(path)
