"""Command-line entry points, one per job (what ``spark-submit`` runs):

    python -m shoplens category-reports --source user_visit_action --params '{"endDate": "2018-11-26"}'
    python -m shoplens page-jump-rate   --source /data/actions --params '{"targetPageFlow": "1,2,3,4,5,6,7"}'
    python -m shoplens ads-daily   --format kafka --option kafka.bootstrap.servers=broker:9092 --option subscribe=ads_log --out /shop/ads/daily
    python -m shoplens ads-top     --format text --path /shop/ads/lines --out /shop/ads/top
    python -m shoplens ads-trend   --format text --path /shop/ads/lines --out /shop/ads/trend
    python -m shoplens blacklist   --format text --path /shop/ads/lines --out /shop/ads/blacklist --threshold 100

Batch jobs write to a catalog table (default) or over JDBC (``--sink jdbc --option url=...``);
streaming jobs run until stopped (or ``--available-now``), keep their results under ``--out`` and
keep rejected lines under ``--rejects``.
"""

from __future__ import annotations

import argparse
import sys

from shoplens import streaming
from shoplens.defaults import BLACKLIST_THRESHOLD, TREND_BUCKET_MS
from shoplens.plans import jobs
from shoplens.session import build_session
from shoplens.sinks.batches import FULL_EVERY
from shoplens.sources.clicks import parse_ad_clicks, read_click_lines_stream, write_rejects_stream


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shoplens")
    ap.add_argument("job", choices=["category-reports", "page-jump-rate", "ads-daily", "ads-top", "ads-trend", "blacklist"])
    ap.add_argument("--master", default=None, help="default: the submitted master")
    ap.add_argument("--source", help="action log: table name or path")
    ap.add_argument("--params", default="{}", help="JSON with startDate, endDate, targetPageFlow")
    ap.add_argument("--sink", default="table", choices=["table", "jdbc"])
    ap.add_argument("--target", action="append", help="output table name(s)")
    ap.add_argument("--dedupe", default="last", choices=["last", "none"])
    ap.add_argument("--whole-percent", action="store_true")
    ap.add_argument("--format", default="text", help="click stream source: text or kafka")
    ap.add_argument("--path", help="folder of click-line files (text source)")
    ap.add_argument("--option", action="append", help="key=value; source options or JDBC options")
    ap.add_argument("--out", help="folder of a streaming job's results")
    ap.add_argument("--checkpoint", help="default: <out>/_checkpoint")
    ap.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD)
    ap.add_argument("--tie", help="column that orders the actions of one second")
    ap.add_argument("--chunk", default="minute", choices=["day", "hour", "minute", "ranges", "none"],
                    help="what long sessions are split into: time slices, or ranges of rows")
    ap.add_argument("--tz", default=None, help="time zone of the days (ads-daily)")
    ap.add_argument("--rejects", help="folder of rejected lines; default: <out>/rejects")
    ap.add_argument("--state-store", default=None, choices=["rocksdb"], help="default: in memory")
    ap.add_argument("--watermark", default=None)
    ap.add_argument("--bucket-ms", type=int, default=TREND_BUCKET_MS)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--state-partitions", type=int, default=None, help="fixed at the first start")
    ap.add_argument("--full-every", type=int, default=FULL_EVERY, help="batches between two that write all current rows")
    a = ap.parse_args(argv)

    spark = build_session(a.master, app=f"shoplens-{a.job}", state_store=a.state_store)
    opts = _options(a.option)
    if a.job == "category-reports":
        targets = tuple(a.target or ("category_top10", "category_top10_session_count"))
        print(jobs.run_category_reports(spark, a.source, a.params, a.sink, targets, **opts))
        return 0
    if a.job == "page-jump-rate":
        target = (a.target or ["page_jump_rate"])[0]
        print(jobs.run_page_jump_rate(spark, a.source, a.params, a.sink, target, dedupe=a.dedupe,
                                      whole_percent=a.whole_percent, tie=a.tie,
                                      chunk=None if a.chunk == "none" else a.chunk, **opts))
        return 0

    clicks, rejects = parse_ad_clicks(read_click_lines_stream(spark, a.format, a.path, **opts))
    trigger = {"availableNow": True} if a.available_now else streaming.DEFAULT_TRIGGER
    common = {"trigger": trigger, "state_partitions": a.state_partitions}
    kept = write_rejects_stream(rejects, a.rejects or f"{a.out}/rejects", trigger=trigger)
    if a.job == "ads-daily":
        q = streaming.run_daily_totals(clicks, a.out, a.checkpoint, tz=a.tz, watermark=a.watermark,
                                       **common)
    elif a.job == "ads-top":
        q = streaming.run_daily_top_ads(clicks, a.out, a.checkpoint, tz=a.tz, full_every=a.full_every, **common)
    elif a.job == "ads-trend":
        q = streaming.run_click_trend(clicks, a.out, a.checkpoint, bucket_ms=a.bucket_ms,
                                      watermark=a.watermark, **common)
    else:
        q = streaming.run_blacklist(clicks, a.out, a.checkpoint, threshold=a.threshold, full_every=a.full_every, **common)
    q.awaitTermination()
    if a.available_now:
        kept.awaitTermination()
    return 0 if q.exception() is None and kept.exception() is None else 1


if __name__ == "__main__":
    sys.exit(main())
