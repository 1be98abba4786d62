"""Physical-plan properties the design relies on (column pruning, partial
aggregation before the shuffle, bounded broadcasts)."""

from clickspark.plans.queries import QUERIES
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_scan_is_pruned_and_aggregate_is_partial(spark):
    plan = _plan(QUERIES["ctr_by_category"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1
    assert "[ts#" in scans[0] and "user_id#" in scans[0] and "event_type#" in scans[0]
    assert "props#" not in scans[0] and "value#" not in scans[0] and "event_id#" not in scans[0]
    assert "partial_count" in plan and "partial_sum" in plan


def test_single_column_scan_reads_one_column(spark):
    plan = _plan(QUERIES["single_column_scan"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and "FileScan parquet [l_quantity#" in scans[0] and "l_orderkey" not in scans[0]


def test_profile_is_one_scan_per_table(spark):
    plan = _plan(QUERIES["null_profile"](spark, SF_SMALL))
    # the lineitem click table joins 5 tables; a one-pass profile scans each once
    assert plan.count("FileScan parquet") == 5


def test_nation_is_broadcast_and_fact_tables_are_not_forced(spark):
    plan = _plan(QUERIES["row_count"](spark, SF_SMALL))
    assert "BroadcastExchange" in plan
    assert "n_nationkey" in plan


def test_label_filter_reaches_the_scan(spark):
    plan = _plan(QUERIES["filter_clicked_numeric"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
