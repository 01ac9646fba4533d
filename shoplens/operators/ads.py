"""Ad-click analyses over typed clicks ``(ts_ms, area, city, userid, adid)``.

* daily totals per (day, area, city, ad)
* top-n ads per (day, area) and its JSON document ``{"<adid>": clicks, ...}``
* clicks per (ad, time bucket), sliding-window trends of those buckets and the
  JSON document ``[{"<label>": clicks}, ...]`` per (window, ad)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shoplens.defaults import (
    DAY_FORMAT, TOP_ADS, TREND_BUCKET_MS, TREND_KEEP, TREND_LABEL, TREND_SLIDE, TREND_WINDOW,
)
from shoplens.functions.time import bucket_start, instant_of, local_date_of, time_label


def daily_area_city(clicks: DataFrame, tz: str | None = None) -> DataFrame:
    """(day, area, city, adid, clicks); day of the click's epoch ms in ``tz``
    (default: the session time zone). Grouping is on a 4-byte date; the day
    string is formatted once per group, after the aggregation."""
    return (clicks.groupBy(local_date_of("ts_ms", tz).alias("_d"), "area", "city", "adid")
            .agg(F.count("*").alias("clicks"))
            .select(F.date_format("_d", DAY_FORMAT).alias("day"), "area", "city", "adid", "clicks"))


def daily_area(counts: DataFrame) -> DataFrame:
    """Roll (day, area, city, adid) totals up to (day, area, adid)."""
    return counts.groupBy("day", "area", "adid").agg(F.sum("clicks").alias("clicks"))


def daily_top_ads(counts: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """(day, area, rank, adid, clicks) for the ``n`` ads with most clicks per
    (day, area) (ties by adid). Runs as a WindowGroupLimit, so each map task
    ships at most ``n`` rows per group."""
    w = Window.partitionBy("day", "area").orderBy(F.desc("clicks"), F.asc("adid"))
    return (daily_area(counts).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n)
            .select("day", "area", "rank", "adid", "clicks"))


def top_ads_json(top: DataFrame) -> DataFrame:
    """(day, area, top_json) with ``top_json`` = ``{"<adid>":clicks,...}`` in rank
    order. Each group holds at most n rows (the top-n above)."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "adid", "clicks")))
    return (top.groupBy("day", "area").agg(ranked.alias("_r"))
            .select("day", "area",
                    F.to_json(F.map_from_entries(
                        F.transform("_r", lambda x: F.struct(x["adid"], x["clicks"])))).alias("top_json")))


def click_buckets(clicks: DataFrame, bucket_ms: int = TREND_BUCKET_MS) -> DataFrame:
    """(adid, bucket_ms, clicks): clicks per ad in epoch-aligned buckets."""
    return (clicks.groupBy("adid", bucket_start("ts_ms", bucket_ms).alias("bucket_ms"))
            .agg(F.count("*").alias("clicks")))


def click_trend(buckets: DataFrame, window: str = TREND_WINDOW, slide: str = TREND_SLIDE,
                keep: int = TREND_KEEP) -> DataFrame:
    """(window_start_ms, window_end_ms, adid, bucket_ms, clicks): for every
    sliding window (``window`` long, every ``slide``) and ad, the first ``keep``
    buckets starting inside the window, in time order.

    Buckets are aggregated first, so the window fan-out (window / slide copies)
    applies to one row per (ad, bucket), not to clicks.
    """
    order = Window.partitionBy("window_end_ms", "adid").orderBy("bucket_ms")
    return (windows_of(buckets, window, slide).withColumn("_rn", F.row_number().over(order))
            .where(F.col("_rn") <= keep).drop("_rn"))


def windows_of(buckets: DataFrame, window: str, slide: str) -> DataFrame:
    """(window_start_ms, window_end_ms, adid, bucket_ms, clicks): each bucket
    row once per sliding window that contains the bucket's start."""
    w = F.window(instant_of("bucket_ms"), window, slide)
    return buckets.select("adid", "bucket_ms", "clicks", w.alias("_w")).select(
        F.unix_millis("_w.start").alias("window_start_ms"),
        F.unix_millis("_w.end").alias("window_end_ms"),
        "adid", "bucket_ms", "clicks")


def trend_json(trend: DataFrame, label_fmt: str = TREND_LABEL, tz: str | None = None) -> DataFrame:
    """(window_end_ms, adid, trend_json) with ``[{"<label>":clicks},...]`` in time
    order; labels format the bucket start with ``label_fmt`` in ``tz``."""
    items = F.array_sort(F.collect_list(F.struct("bucket_ms", "clicks")))
    return (trend.groupBy("window_end_ms", "adid").agg(items.alias("_b"))
            .select("window_end_ms", "adid",
                    F.to_json(F.transform("_b", lambda x: F.create_map(
                        time_label(x["bucket_ms"], label_fmt, tz), x["clicks"]))).alias("trend_json")))


def latest_trend(buckets: DataFrame, window: str = TREND_WINDOW, slide: str = TREND_SLIDE,
                 keep: int = TREND_KEEP) -> DataFrame:
    """The rows of ``click_trend`` of each ad's newest window. Every window an ad is in
    holds one of its buckets, so its newest window is the newest one of its newest
    bucket: that bucket alone (a partial maximum) is fanned out, and the ad's buckets
    are joined to the one window found."""
    newest = buckets.groupBy("adid").agg(F.max("bucket_ms").alias("bucket_ms")).withColumn("clicks", F.lit(0))
    last = (windows_of(newest, window, slide).groupBy("adid")
            .agg(F.max(F.struct("window_end_ms", "window_start_ms")).alias("_w"))
            .select(F.col("adid").alias("_ad"), "_w.window_start_ms", "_w.window_end_ms"))
    inside = buckets.join(last, F.col("adid").eqNullSafe(F.col("_ad")) & (F.col("bucket_ms") >= F.col("window_start_ms"))
                          & (F.col("bucket_ms") < F.col("window_end_ms")))
    order = Window.partitionBy("adid").orderBy("bucket_ms")
    return (inside.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= keep)
            .select("window_start_ms", "window_end_ms", "adid", "bucket_ms", "clicks"))


def latest_trend_json(buckets: DataFrame, window: str = TREND_WINDOW, slide: str = TREND_SLIDE,
                      keep: int = TREND_KEEP, label_fmt: str = TREND_LABEL, tz: str | None = None) -> DataFrame:
    """(adid, window_end_ms, trend_json): per ad only its newest window, the one
    document per ad that the original job keeps (overwritten every batch)."""
    docs = trend_json(latest_trend(buckets, window, slide, keep), label_fmt, tz)
    return docs.select("adid", "window_end_ms", "trend_json")
