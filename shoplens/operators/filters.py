"""Predicates on the action log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplens.defaults import NOT_A_CLICK
from shoplens.params import is_not_blank


def in_action_time_range(df: DataFrame, start: str | None = None, end: str | None = None,
                         col: str = "action_time", date_col: str | None = None) -> DataFrame:
    """Inclusive ``start <= action_time <= end``; a blank bound is skipped.

    The comparison is on the string, as the original jobs do: an ``end`` of
    ``2018-11-26`` excludes every row of that day (``'2018-11-26 10:00:00' >
    '2018-11-26'``). ``date_col`` names a column that is known to equal the first ten
    characters of ``action_time`` (a partition column, typically): the implied bounds
    on it are added so partition pruning can skip whole days. Without it only
    ``action_time`` decides.
    """
    has_date = date_col is not None
    if is_not_blank(start):
        df = df.where(F.col(col) >= F.lit(start))
        if has_date:
            df = df.where(F.col(date_col) >= F.lit(start[:10]))
    if is_not_blank(end):
        df = df.where(F.col(col) <= F.lit(end))
        if has_date:
            df = df.where(F.col(date_col) <= F.lit(end[:10]))
    return df


def is_click(click_category_col: str = "click_category_id"):
    """A click has a category other than -1 (null is not a click either)."""
    c = F.col(click_category_col)
    return c.isNotNull() & (c != NOT_A_CLICK)
