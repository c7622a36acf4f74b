"""Plan shape: no Python UDFs, partitioned windows, shuffle count, pushdown."""

import pytest

from tickerlake.operators import marts
from tickerlake.plans import daily_run
from tickerlake.plans.catalog import QUERIES, event_batches
from tickerlake.plans.catalog import event_bars, raw_bars, raw_bars_order, staged_bars
from tickerlake.sources import tables
from tickerlake.streaming import refresh

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# These write tables while they are built; the frames that they hand to the
# writers are planned in the tests below.
WRITERS = {"read_csv_roundtrip", "read_csv_multiline", "quarantine_malformed", "quarantine_good", "csv_export_roundtrip", "bronze_append", "bronze_replace",
           "publish_mart", "stream_ingest", "stream_quarantine", "bronze_mixed", "layer_tables", "table_profile", "daily_refresh",
           "daily_refresh_layers", "daily_refresh_incremental", "daily_refresh_staging", "daily_refresh_recovered", "refresh_late_bar",
           "dq_suite_incremental", "layer_summary_incremental", "retention_stored"}
# JSON text of any shape is scanned in Arrow batches.
ARROW = {"redact_map", "redact_nested"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS - ARROW))
def test_no_python_udf_and_no_unpartitioned_window(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert "SinglePartition" not in p or name in {"dq_required_columns", "dq_null_counts", "dq_ohlc",
                                                  "dq_batch_gate", "dq_not_null", "dq_expression",
                                                  "dq_suite", "table_profile", "profile_sketched", "layer_summary",
                                                  "business_days", "top_gainers", "sample_rows"}


def test_mart_uses_two_shuffles_and_partial_dedup(spark):
    df = QUERIES["moving_averages"](spark, SF_SMALL)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert p.count("WindowGroupLimit") == 2          # partial before, final after the shuffle
    phys = df._jdf.queryExecution().executedPlan().toString()
    assert phys.count("Exchange hashpartitioning") == 2


def test_scan_reads_only_needed_columns(spark):
    df = QUERIES["ret_pct"](spark, SF_SMALL)
    p = plan(df)
    assert "l_returnflag" not in p and "l_linestatus" not in p


def test_date_filter_reaches_scan(spark):
    from tickerlake.operators.ingest import date_range
    df = date_range(spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumnRenamed("ts", "date"),
                    "2024-01-02", "2024-01-03")
    assert "PushedFilters: [IsNotNull(ts)" in plan(df)


def _formatted(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_missing_bars_is_one_window_pass(spark):
    p = _formatted(spark, QUERIES["missing_bars"](spark, SF_SMALL))
    assert "Join" not in p
    assert p.count("row_number(), 1, Partial") == 1          # staging computed once


@pytest.mark.parametrize("name", ["dq_suite", "layer_summary"])
def test_multi_layer_queries_stage_once(spark, name):
    p = _formatted(spark, QUERIES[name](spark, SF_SMALL))
    assert p.count("row_number(), 1, Partial") == 1


def native(df) -> str:
    p = plan(df)
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "SinglePartition" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    return p


def test_full_build_stages_once_in_two_shuffles(spark):
    df = daily_run.full_features(raw_bars(spark, SF_SMALL), raw_bars_order(), ())
    p = native(df)
    assert p.count("Exchange hashpartitioning") == 2 and p.count("WindowGroupLimit") == 2


def test_stored_tables_are_laid_out_by_date(spark):
    df = tables.storage_order(marts.daily_returns(staged_bars(spark, SF_SMALL)), ["date", "symbol"])
    assert native(df).count("Exchange rangepartitioning(date") == 1


def test_incremental_reads_only_touched_dates(spark, tmp_dir):
    out = daily_run.run_daily(spark, event_bars(spark, SF_SMALL), tmp_dir)
    batch = event_batches(spark, SF_SMALL)[2]
    staged = out.tables["stg_stock_prices"]
    p = native(refresh.merged_dates(spark, staged, batch))
    assert "dynamicpruning" in p.lower() or "LeftSemi" in p
    assert p.count("Window ") <= 2
    changes = refresh.first_changes(batch)
    p = native(refresh.changed_features(tables.read_table(spark, staged), changes))
    assert "PartitionFilters: [isnotnull(date" in p.replace("IsNotNull", "isnotnull")


def test_grids_join_nothing_across(spark):
    for name in ("expected_grid", "expected_grid_bounds", "expected_grid_per_symbol", "missing_bars", "missing_bars_bounds",
                 "missing_bars_per_symbol"):
        assert "Join" not in native(QUERIES[name](spark, SF_SMALL))
