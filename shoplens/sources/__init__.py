"""Readers: the action log, ad-click lines (batch and stream), and adapters
from the driver's test tables to those shapes."""

from shoplens.sources.actions import conform_actions, read_actions  # noqa: F401
from shoplens.sources.clicks import (  # noqa: F401
    click_lines, parse_ad_clicks, read_click_lines, read_click_lines_stream, reject_counts, write_click_lines,
    write_rejects_stream,
)
