"""End-to-end batch jobs (J1-J4): read the action log, apply the parameter
document, compute, stamp the run's task id on every row, write.

One task id per run (``uuid4``), not per row; pass ``task_id`` to fix it in tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.operators import category, pageflow
from shoplens.operators.filters import in_action_time_range
from shoplens.params import JobParams
from shoplens.sinks.tables import append_jdbc, replace_table
from shoplens.sources.actions import partition_columns, read_actions


def new_task_id() -> str:
    return str(uuid.uuid4())


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    return df.select(F.lit(task_id).alias("taskid"), *df.columns)


def _filtered(actions: DataFrame, params: JobParams) -> DataFrame:
    """The actions of the time range. A log partitioned by its day is pruned by it: the
    partition column ``date`` of such a log is the day of ``action_time``."""
    date_col = "date" if "date" in partition_columns(actions) else None
    return in_action_time_range(actions, params.start_date, params.end_date, date_col=date_col)


def category_top10_job(actions: DataFrame, params: JobParams, task_id: str, n: int = 10) -> DataFrame:
    """(taskid, category_id, click_count, order_count, pay_count)."""
    return with_task_id(category.top_categories(_filtered(actions, params), n), task_id)


def category_session_top10_job(actions: DataFrame, params: JobParams, task_id: str,
                               n_categories: int = 10, n_sessions: int = 10,
                               categories: DataFrame | None = None) -> DataFrame:
    """(taskid, category_id, session_id, click_count)."""
    a = _filtered(actions, params)
    return with_task_id(category.top_sessions(a, n_categories, n_sessions, categories), task_id)


def page_jump_rate_job(actions: DataFrame, params: JobParams, task_id: str, dedupe: str = "last",
                       whole_percent: bool = False, tie: str | None = None,
                       chunk: str | None = "minute") -> DataFrame:
    """(taskid, flow, rate). Actions in the same second are ordered by ``tie``, then by page."""
    if not params.target_page_flow:
        raise ValueError("targetPageFlow is required")
    rate = pageflow.jump_rate(_filtered(actions, params), params.target_page_flow, dedupe,
                              whole_percent, tie, chunk)
    return with_task_id(rate, task_id)


def write_result(df: DataFrame, sink: str, target: str, **options) -> None:
    """``sink='table'`` replaces a catalog table; ``sink='jdbc'`` appends to a
    database table (``options``: url, user, password, driver, ...)."""
    if sink == "table":
        replace_table(df, target)
    elif sink == "jdbc":
        append_jdbc(df, table=target, **options)
    else:
        raise ValueError(f"unknown sink {sink!r}")


def run_category_reports(spark: SparkSession, source: str, params_json: str,
                         sink: str = "table", targets=("category_top10", "category_top10_session_count"),
                         task_id: str | None = None, **sink_options) -> str:
    """J1 and J2 in one run sharing one task id. The top-category list (at most
    ``n`` rows) is computed once and cached, so J2 does not recompute it."""
    task_id = task_id or new_task_id()
    params = JobParams.from_json(params_json)
    actions = read_actions(spark, source)
    top = category.top_categories(_filtered(actions, params)).cache()
    try:
        write_result(with_task_id(top, task_id), sink, targets[0], **sink_options)
        write_result(category_session_top10_job(actions, params, task_id, categories=top),
                     sink, targets[1], **sink_options)
    finally:
        top.unpersist()
    return task_id


def run_page_jump_rate(spark: SparkSession, source: str, params_json: str, sink: str = "table",
                       target: str = "page_jump_rate", task_id: str | None = None,
                       dedupe: str = "last", whole_percent: bool = False,
                       tie: str | None = None, chunk: str | None = "minute", **sink_options) -> str:
    task_id = task_id or new_task_id()
    df = page_jump_rate_job(read_actions(spark, source), JobParams.from_json(params_json), task_id,
                            dedupe, whole_percent, tie, chunk)
    write_result(df, sink, target, **sink_options)
    return task_id
