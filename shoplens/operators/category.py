"""Top categories by clicks, orders and payments, and their most active sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shoplens.defaults import TOP_CATEGORIES, TOP_SESSIONS
from shoplens.functions.ids import id_list
from shoplens.operators.filters import is_click


def category_actions(actions: DataFrame) -> DataFrame:
    """One row per (action kind, category) an action contributes to.

    Exclusive precedence click > order > pay: an action that is a click counts
    only as a click even if order or payment ids are also set; a search
    contributes nothing. Ids in a list are counted once per occurrence.
    """
    click = is_click()
    order = F.col("order_category_ids").isNotNull()
    pay = F.col("pay_category_ids").isNotNull()
    kind = F.when(click, "click").when(order, "order").when(pay, "pay")
    ids = (F.when(click, F.array(F.col("click_category_id").cast("string")))
           .when(order, id_list("order_category_ids"))
           .when(pay, id_list("pay_category_ids")))
    # explode skips the null array of actions that are none of the three.
    return actions.select(kind.alias("action"), F.explode(ids).alias("category_id"))


def category_counts(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count), one pass over the log;
    missing kinds count 0. Partial aggregation runs before the shuffle, so only
    (map task x category) rows cross the network, however skewed the categories."""
    a = F.col("action")
    return (category_actions(actions).groupBy("category_id")
            .agg(F.count_if(a == "click").alias("click_count"),
                 F.count_if(a == "order").alias("order_count"),
                 F.count_if(a == "pay").alias("pay_count")))


def top_categories(actions: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """Order by clicks, then orders, then payments (all descending); ties are
    broken by ``category_id`` so the result is deterministic."""
    return (category_counts(actions)
            .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                     F.asc("category_id"))
            .limit(n))


def top_sessions(actions: DataFrame, n_categories: int = TOP_CATEGORIES, n_sessions: int = TOP_SESSIONS,
                 categories: DataFrame | None = None) -> DataFrame:
    """(category_id, session_id, click_count): in each top category, the
    ``n_sessions`` sessions with most clicks (ties by ``session_id``).

    The category list computed here has at most ``n_categories`` rows (it is a limit),
    so it is broadcast for a semi join; a list given by the caller is joined as its
    size demands. Counting per (category, session) is a partial
    + final hash aggregate; the per-category top-k runs as a WindowGroupLimit
    before and after the shuffle, so a category with a huge number of sessions
    sends only ``n_sessions`` rows per map task.
    """
    if categories is None:
        top = F.broadcast(top_categories(actions, n_categories).select("category_id"))
    else:
        top = categories.select("category_id")
    clicks = (actions.where(is_click())
              .select(F.col("click_category_id").cast("string").alias("category_id"), "session_id"))
    counts = (clicks.join(top, "category_id", "left_semi")
              .groupBy("category_id", "session_id").agg(F.count("*").alias("click_count")))
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return (counts.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n_sessions).drop("_rn"))
