"""Page single-jump conversion rate along a target page flow.

rate(x-y) = sessions' jumps x->y / visits of x * 100, where jumps are adjacent
actions of a session in time order taken over *all* pages (then restricted to
the target jumps), and visits count every action on page x.

Actions of one second are ordered by the ``tie`` column if there is one, then by
page, so the result never depends on how the log is partitioned.

``dedupe='last'`` keeps, per (session, from-page), only the jump out of the last
visit of that page that has a successor, so a session counts at most once per
from-page; ``dedupe='none'`` counts every adjacent jump.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.defaults import FLOW_SEPARATOR
from shoplens.operators.successor import with_successor, with_successor_ranged
from shoplens.params import parse_flow

# Chunk widths for splitting long sessions. Each is a leading slice of the
# fixed-width "yyyy-MM-dd HH:mm:ss" string, so it never decreases along the
# string order the sessions are sorted by (the property with_successor needs).
# ``RANGES`` instead splits sessions by ranges of the sort order, however dense they are.
CHUNKS = {"day": 10, "hour": 13, "minute": 16}
RANGES = "ranges"


def target_jumps(flow) -> list[tuple[int, int]]:
    pages = parse_flow(flow)
    return list(zip(pages, pages[1:]))


def _order(tie: str | None) -> list[str]:
    # rows that agree on all of these are the same step of the page sequence
    return ["action_time"] + ([tie] if tie else []) + ["page_id"]


def _chunk(chunk: str | None) -> Column | None:
    return None if chunk is None else F.substring("action_time", 1, CHUNKS[chunk])


def page_successors(actions: DataFrame, tie: str | None = None,
                    chunk: str | None = "minute") -> DataFrame:
    """(session_id, page_id, action_time[, tie], position, next_page) for every action;
    ``position`` orders the actions that agree on everything before it."""
    cols = dict.fromkeys(["session_id", *_order(tie)])
    if chunk == RANGES:
        return with_successor_ranged(actions.select(*cols), ["session_id"], _order(tie), "page_id", "next_page", "position")
    return with_successor(actions.select(*cols), ["session_id"], _order(tie), "page_id", "next_page",
                          _chunk(chunk), position="position")


def jumps(actions: DataFrame, dedupe: str = "last", tie: str | None = None,
          chunk: str | None = "minute", from_pages: Sequence[int] | None = None) -> DataFrame:
    """(session_id, from_page, to_page), one row per counted jump.

    ``from_pages`` restricts the from-page after adjacency is known (adjacency
    itself always spans all pages), which shrinks the de-duplication shuffle.
    """
    return jumps_of_successors(page_successors(actions, tie, chunk), dedupe, tie, from_pages)


def jumps_of_successors(succ: DataFrame, dedupe: str = "last", tie: str | None = None,
                        from_pages: Sequence[int] | None = None) -> DataFrame:
    if dedupe not in ("last", "none"):
        raise ValueError("dedupe must be 'last' or 'none'")
    s = succ.where(F.col("next_page").isNotNull())
    if from_pages is not None:
        s = s.where(F.col("page_id").isin(list(from_pages)))
    if dedupe == "last":
        s = s.groupBy("session_id", "page_id").agg(_last_next(tie).alias("next_page"))
    return s.select("session_id", F.col("page_id").alias("from_page"),
                    F.col("next_page").alias("to_page"))


def _last_next(tie: str | None) -> Column:
    """The next page of the last action that has one."""
    order = F.struct("action_time", *([tie] if tie else []), "position")
    return F.max_by("next_page", F.when(F.col("next_page").isNotNull(), order))


def _flow_label(a, b) -> Column:
    return F.concat_ws(FLOW_SEPARATOR, a.cast("string"), b.cast("string"))


def jump_counts(actions: DataFrame, flow, dedupe: str = "last", tie: str | None = None,
                chunk: str | None = "minute") -> DataFrame:
    """(flow 'x-y', from_page, to_page, jumps) for target jumps seen at least once."""
    return _jump_counts(page_successors(actions, tie, chunk), flow, dedupe, tie)


def _is_target(pairs, page: str, following: str) -> Column:
    return reduce(lambda x, y: x | y, [(F.col(page) == a) & (F.col(following) == b) for a, b in pairs], F.lit(False))


def _jump_counts(succ: DataFrame, flow, dedupe: str, tie: str | None) -> DataFrame:
    pairs = target_jumps(flow)
    j = jumps_of_successors(succ, dedupe, tie, from_pages=sorted({a for a, _ in pairs}))
    # compare the page ids (no per-row string); the label is built once per jump
    return (j.where(_is_target(pairs, "from_page", "to_page"))
             .groupBy("from_page", "to_page").agg(F.count("*").alias("jumps"))
             .select(_flow_label(F.col("from_page"), F.col("to_page")).alias("flow"),
                     "from_page", "to_page", "jumps"))


def page_visits(actions: DataFrame, flow) -> DataFrame:
    """(page_id, visits): actions on each page of the flow (the rate denominator)."""
    pages = sorted(set(parse_flow(flow)))
    return (actions.where(F.col("page_id").isin(pages))
            .groupBy("page_id").agg(F.count("*").alias("visits")))


def jump_rate(actions: DataFrame, flow, dedupe: str = "last", whole_percent: bool = False,
              tie: str | None = None, chunk: str | None = "minute") -> DataFrame:
    """(flow, rate). Jumps never seen give no row. ``whole_percent`` truncates the
    percentage toward zero to a bigint.

    One pass over the log: actions on pages of the flow are counted by (page, next
    page if that is a target jump, else null), at most two rows per page and jump; a
    page's visits are the sum over its rows.
    """
    if dedupe not in ("last", "none"):
        raise ValueError("dedupe must be 'last' or 'none'")
    pairs = target_jumps(flow)
    succ = page_successors(actions, tie, chunk).where(F.col("page_id").isin(sorted(set(parse_flow(flow)))))
    if dedupe == "last":
        steps = succ.groupBy("session_id", "page_id").agg(F.count("*").alias("actions"), _last_next(tie).alias("next_page"))
    else:
        steps = succ.select("page_id", "next_page", F.lit(1).alias("actions"))
    following = F.when(F.coalesce(_is_target(pairs, "page_id", "next_page"), F.lit(False)), F.col("next_page"))
    counts = (steps.groupBy("page_id", following.alias("to_page"))
              .agg(F.count("*").alias("jumps"), F.sum("actions").alias("actions"))
              .withColumn("visits", F.sum("actions").over(Window.partitionBy("page_id"))))
    rate = F.col("jumps").cast("double") / F.col("visits") * 100
    if whole_percent:
        rate = rate.cast("bigint")
    return (counts.where(F.col("to_page").isNotNull())
            .select(_flow_label(F.col("page_id"), F.col("to_page")).alias("flow"), rate.alias("rate")))
