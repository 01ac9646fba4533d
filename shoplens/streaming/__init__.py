"""Structured Streaming versions of the ad-click jobs (running counts in the state
store, read from there; rankings and the blacklist loop in folders of micro-batches)."""

from shoplens.streaming.jobs import (  # noqa: F401
    DEFAULT_TRIGGER,
    console_preview,
    read_accepted_clicks,
    read_blacklist,
    read_block_batches,
    read_click_buckets,
    read_click_trend,
    read_daily_top_ads,
    read_daily_top_json,
    read_daily_totals,
    read_final_daily_totals,
    read_last_snapshot,
    read_latest_click_trend,
    read_open_windows,
    read_snapshots,
    read_top_ads,
    read_top_ads_json,
    read_user_ad_counts,
    read_window_trend,
    run_blacklist,
    run_click_trend,
    run_daily_snapshots,
    run_daily_top_ads,
    run_daily_totals,
    run_window_trend,
)
