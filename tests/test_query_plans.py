"""Plans hold up when no side of a join fits a broadcast."""

import pytest

import __spark_entry__ as entry
from lakeops.workload import QUERIES as NAMES

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in entry.queries().items() if name in NAMES}
# Broadcast by hint: bucket starts, hot groups, parts that differ (at most 4096 rows each).
BOUNDED = {
    "assign_surrogate_keys", "code_text_dimensions", "complaint_tracker", "count_over_partition", "equal_split", "junk_dimension", "ledger_account_dimension",
    "lookup_surrogate_keys", "rates_spread_over_geography", "service_dimension", "sheets_with_keys", "text_dimension",
    "missing_keys", "production_confirmations", "proportional_allocation", "repeated_groups", "stock_valuation", "table_differences", "unmapped_quarantine",
    "upsert_by_key", "upsert_nullable_key",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_shuffles_only_by_key(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text, word
    if name not in BOUNDED:
        assert "BroadcastHashJoin" not in text


@pytest.mark.parametrize("name", ["dedupe_by_key", "latest_row_per_key", "ranked_dedupe", "scd1_dimension"])
def test_one_row_per_key_is_limited_before_the_shuffle(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, FOLDER))
    assert "SortAggregate" not in text and text.count("WindowGroupLimit") == 2
    partial, exchange = text.rindex("WindowGroupLimit"), text.rindex("Exchange hashpartitioning")
    assert exchange < partial  # the tree reads from the result down to the scan


def test_transfers_read_excise_once(no_broadcast):
    assert plan(QUERIES["stock_transfers"](no_broadcast, FOLDER)).count("FileScan parquet") <= 5


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["between_dates"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    text = plan(QUERIES["in_value_list"](spark, FOLDER))
    assert "EqualTo(p_type,ECONOMY)" in text and "l_extendedprice" not in text


@pytest.mark.parametrize("name", ["first_and_last_value", "first_event_flag", "import_tracker"])
def test_first_values_by_several_columns_are_aggregated_by_hash(no_broadcast, name):
    lines = plan(QUERIES[name](no_broadcast, FOLDER)).splitlines()
    assert not [line for line in lines if "SortAggregate" in line and ("min_by" in line or "max_by" in line or "min(struct" in line or "__place" in line)]
    if name != "import_tracker":  # the test's item lines take the maximum of a text
        assert not [line for line in lines if "SortAggregate" in line]
