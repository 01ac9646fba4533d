"""Plan assertions: built-in expressions only, pruned scans, partial top-k."""

import pytest

import __spark_entry__ as E
from shoplens.plans.queries import QUERIES
from tests.conftest import SF_SMALL

BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_python_in_plan(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["category_session_top10", "ads_daily_top3", "ad_click_trend"])
def test_top_k_is_partial_before_the_shuffle(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["category_top10"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string,props:string>" in plan


def test_flagship_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(E.queries()["category_top10"](spark, SF_SMALL))


def test_top_category_list_is_broadcast(spark):
    plan = _plan(E.queries()["category_session_top10"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_predicates_reach_the_scan_of_a_native_log(spark, tmp_path):
    from shoplens.operators import pageflow
    from shoplens.operators.filters import in_action_time_range
    from shoplens.sources import testviews
    from shoplens.sources.actions import read_actions
    path = str(tmp_path / "log")
    testviews.actions(spark, SF_SMALL).write.parquet(path)
    log = read_actions(spark, path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")     # untruncated scan details
    visits = _plan(pageflow.page_visits(log, (1, 2, 3)))
    assert "PushedFilters: [In(page_id, [1,2,3])" in visits and "ReadSchema: struct<page_id:bigint>" in visits
    ranged = _plan(in_action_time_range(log, "2024-01-08 00:00:00", "2024-01-21", date_col="date").select("session_id"))
    assert "GreaterThanOrEqual(action_time,2024-01-08 00:00:00)" in ranged
    assert "LessThanOrEqual(action_time,2024-01-21)" in ranged
    assert "GreaterThanOrEqual(date,2024-01-08)" in ranged        # the implied partition bound
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_jump_rate_scans_the_log_once(spark):
    for name in ("page_jump_rate", "page_jump_rate_all"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        # two branches of the successor share one shuffle; nothing else reads the log
        assert plan.count("FileScan") <= 2 and "BroadcastExchange HashedRelationBroadcastMode(List(cast(input[0, bigint" not in plan


def test_time_range_reaches_the_scan(spark):
    plan = _plan(E.queries()["actions_date_range"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00" in plan and "LessThan(ts,2024-01-21T00:00" in plan


def test_newest_trend_is_found_before_any_document_is_made(spark):
    plan = _plan(E.queries()["ad_click_trend_latest"](spark, SF_SMALL))
    # documents (collect_list) are made above the join with each ad's one window; the
    # window is found from the ad's newest bucket, a partial maximum
    assert plan.index("collect_list") < plan.index("Join") < plan.index("partial_max(bucket_ms")
    assert "collect_list" not in plan[plan.index("Join"):]


def test_jobs_prune_a_log_by_day(spark, tmp_path):
    from shoplens.params import JobParams
    from shoplens.plans import jobs
    from shoplens.sources import testviews
    from shoplens.sources.actions import partition_columns, read_actions
    by_day, flat = str(tmp_path / "by_day"), str(tmp_path / "flat")
    acts = testviews.actions(spark, SF_SMALL)
    acts.repartition("date").write.partitionBy("date").parquet(by_day)
    acts.write.parquet(flat)
    assert partition_columns(read_actions(spark, by_day)) == {"date"}
    assert partition_columns(read_actions(spark, flat)) == partition_columns(spark.range(3)) == set()
    params = JobParams.from_json('{"startDate": "2024-01-08 00:00:00", "endDate": "2024-01-21", "targetPageFlow": "1,2,3"}')
    for job in (jobs.category_top10_job, jobs.category_session_top10_job, jobs.page_jump_rate_job):
        pruned, whole = (job(read_actions(spark, p), params, "t") for p in (by_day, flat))
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        plan = _plan(pruned)
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        filters = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
        assert "2024-01-08" in filters and "2024-01-21" in filters
        assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, whole.collect()))


def test_observed_counts_take_no_second_pass(spark):
    from pyspark.sql import Observation
    from shoplens.plans.queries import spoilt_lines
    from shoplens.sources.clicks import parse_counted
    plan = _plan(parse_counted(spoilt_lines(spark, SF_SMALL), Observation("x")))
    assert plan.count("FileScan parquet") == 4             # events and the three dimensions, once each
    assert "CollectMetrics" in plan and "Aggregate" not in plan
