"""Streaming ad-click jobs.

Each job reads a streaming DataFrame of typed clicks (see ``shoplens.sources.clicks``).

* Running counts (daily totals, trend buckets, window trends) live in Spark's state
  store and nowhere else: the current values are read with Spark's state data source
  from the checkpoint (``read_*``). With a watermark, days and windows that are over
  leave the state and go, once, to a file sink; the readers take both.
* The top ads per (day, area) are kept up to date batch by batch: only the groups that
  a batch touched are ranked again.
* The blacklist loop filters each micro-batch by the blacklist as it stands before it,
  and keeps the accepted clicks, the counts and the newly blocked users of each batch.

What ``foreachBatch`` writes goes to a folder named by the batch id in overwrite mode
(``shoplens.sinks.batches``), and a batch reads folders of earlier batches only, so a
replayed batch gives the same rows again.

Progress and state live in the checkpoint folder; restarting with the same
checkpoint resumes where the query stopped. Default trigger: a micro-batch
every 5 seconds; tests and the registered queries use ``{"availableNow": True}``.
"""

from __future__ import annotations

import re
import threading

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens.defaults import (
    BLACKLIST_THRESHOLD, DAY_FORMAT, MICRO_BATCH, TOP_ADS, TREND_BUCKET_MS, TREND_KEEP, TREND_LABEL, TREND_SLIDE,
    TREND_WINDOW,
)
from shoplens.functions.time import bucket_start, day_of, epoch_ms_of_ntz, instant_of, local_date_of, local_time_of
from shoplens.operators import ads, blacklist
from shoplens.schemas import AD_BUCKETS, AD_CLICK, AREA_TOTALS, BLOCKED_USERS, DAILY_TOP, DAILY_TOTALS, USER_AD_COUNTS
from shoplens.session import path_exists
from shoplens.sinks.batches import FULL_EVERY, read_batches, since_full, write_batch

DEFAULT_TRIGGER = {"processingTime": MICRO_BATCH}

_UNITS_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
             "day": 86_400_000, "week": 604_800_000}


def interval_ms(text: str) -> int:
    """``"60 seconds"`` -> 60000 (the interval forms ``F.window`` accepts)."""
    total = 0
    for n, unit in re.findall(r"(\d+)\s*([a-z]+?)s?\b", text.lower()):
        total += int(n) * _UNITS_MS[unit]
    if total <= 0:
        raise ValueError(f"not an interval: {text!r}")
    return total


# A query takes its number of state partitions from a session setting when it starts.
_STARTING = threading.Lock()


def _start(writer, out: str, checkpoint: str | None, trigger: dict | None, name: str | None,
           state_partitions: int | None, spark: SparkSession) -> StreamingQuery:
    """Start the query. ``state_partitions`` fixes the number of state-store
    partitions; it is read once, when the query first starts, and then kept in
    the checkpoint (AQE cannot coalesce stateful partitions later)."""
    w = writer.option("checkpointLocation", checkpoint or f"{out}/_checkpoint").trigger(**(trigger or DEFAULT_TRIGGER))
    if name:
        w = w.queryName(name)
    with _STARTING:
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions or old)))
        try:
            return w.start()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)


def _names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


# ---- running counts: state and final rows -------------------------------------------
def _counting(counts: DataFrame, final: DataFrame | None, out: str, **start) -> StreamingQuery:
    """Run an aggregation whose result is its state. ``final`` (of a watermarked one) goes
    to Spark's file sink in append mode: each row once, when its time is over."""
    if final is None:
        writer = counts.writeStream.outputMode("update").format("noop")
    else:
        writer = final.writeStream.outputMode("append").format("parquet").option("path", f"{out}/final")
    return _start(writer, out, spark=counts.sparkSession, **start)


def _state(spark: SparkSession, out: str, checkpoint: str | None) -> DataFrame | None:
    """The state's keys and values as of the last finished batch; None before the first."""
    try:
        return spark.read.format("statestore").load(checkpoint or f"{out}/_checkpoint").select("key.*", "value.*")
    except PySparkException as e:
        if not (e.getCondition() or "").startswith("STDS_"):
            raise
        return None


def _final(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(f"{out}/final") if path_exists(spark, f"{out}/final") else None


def _current(spark: SparkSession, out: str, checkpoint: str | None, schema: T.StructType, of_state) -> DataFrame:
    """Rows of ``schema`` from the state (``of_state`` shapes them) and the final rows."""
    parts = [_final(spark, out, schema)]
    state = _state(spark, out, checkpoint)
    if state is not None:
        parts.append(of_state(state.withColumnRenamed("count", "clicks")).select(*_names(schema)))
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], schema)
    if len(parts) == 1:
        return parts[0]
    # a row that became final between the two reads is in both
    keys = [c for c in _names(schema) if c != "clicks"]
    return parts[0].unionByName(parts[1]).groupBy(*keys).agg(F.max("clicks").alias("clicks"))


# ---- daily totals ----------------------------------------------------------------------
def _local_instant(ms, tz: str | None):
    """Wall-clock time in ``tz`` as if it were UTC: an event time whose whole days are
    the days of ``tz``."""
    return instant_of(epoch_ms_of_ntz(local_time_of(ms, tz)))


def _window_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", day_of(F.unix_millis("window.start"), "UTC"))


def run_daily_totals(clicks: DataFrame, out: str, checkpoint: str | None = None,
                     tz: str | None = None, watermark: str | None = None,
                     trigger: dict | None = None, name: str | None = None,
                     state_partitions: int | None = None) -> StreamingQuery:
    """Running clicks per (day, area, city, ad), days in ``tz`` (default: the session
    time zone).

    Without ``watermark`` the state keeps every key forever (as a running total
    must). With ``watermark``, a day that is older than the watermark is final: its rows
    go to ``<out>/final`` and leave the state, and later clicks for it are dropped.
    """
    start = dict(checkpoint=checkpoint, trigger=trigger, name=name, state_partitions=state_partitions)
    if not watermark:
        keyed = clicks.select(local_date_of("ts_ms", tz).alias("day_date"), "area", "city", "adid")
        return _counting(keyed.groupBy("day_date", "area", "city", "adid").count(), None, out, **start)
    keyed = clicks.withColumn("event_time", _local_instant("ts_ms", tz)).withWatermark("event_time", watermark)
    counts = keyed.groupBy(F.window("event_time", "1 day").alias("window"), "area", "city", "adid").count()
    final = _window_day(counts.withColumnRenamed("count", "clicks")).select(*_names(DAILY_TOTALS))
    return _counting(counts, final, out, **start)


def _daily_of_state(state: DataFrame) -> DataFrame:
    if "window" in state.columns:
        return _window_day(state)
    return state.withColumn("day", F.date_format("day_date", DAY_FORMAT))


def read_daily_totals(spark: SparkSession, out: str, since_day: str | None = None,
                      checkpoint: str | None = None) -> DataFrame:
    """(day, area, city, adid, clicks): current running totals, from ``since_day``
    (``yyyy-MM-dd``) on if given."""
    rows = _current(spark, out, checkpoint, DAILY_TOTALS, _daily_of_state)
    return rows if since_day is None else rows.where(F.col("day") >= since_day)


def read_final_daily_totals(spark: SparkSession, out: str) -> DataFrame:
    """(day, area, city, adid, clicks) of the days that the watermark has passed."""
    rows = _final(spark, out, DAILY_TOTALS)
    return spark.createDataFrame([], DAILY_TOTALS) if rows is None else rows


def read_daily_top_ads(spark: SparkSession, out: str, n: int = TOP_ADS,
                       since_day: str | None = None, checkpoint: str | None = None) -> DataFrame:
    return ads.daily_top_ads(read_daily_totals(spark, out, since_day, checkpoint), n)


def read_daily_top_json(spark: SparkSession, out: str, n: int = TOP_ADS,
                        since_day: str | None = None, checkpoint: str | None = None) -> DataFrame:
    return ads.top_ads_json(read_daily_top_ads(spark, out, n, since_day, checkpoint))


def run_daily_snapshots(clicks: DataFrame, out: str, checkpoint: str | None = None, tz: str | None = None,
                        trigger: dict | None = None, name: str | None = None,
                        state_partitions: int | None = None) -> StreamingQuery:
    """Every key in every batch, as the original state stream emits them: complete mode,
    one snapshot of all totals per batch under ``<out>/snapshots``."""
    def batch(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows.select(*_names(DAILY_TOTALS)), f"{out}/snapshots", batch_id)
    writer = ads.daily_area_city(clicks, tz).writeStream.outputMode("complete").foreachBatch(batch)
    return _start(writer, out, checkpoint, trigger, name, state_partitions, clicks.sparkSession)


def read_snapshots(spark: SparkSession, out: str) -> DataFrame:
    """(day, area, city, adid, clicks, batch): the totals after each batch."""
    return read_batches(spark, f"{out}/snapshots", DAILY_TOTALS)


def read_last_snapshot(spark: SparkSession, out: str) -> DataFrame:
    rows = read_snapshots(spark, out)
    last = rows.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == F.lit(last)).drop("batch")


# ---- top ads kept up to date ------------------------------------------------------------
def run_daily_top_ads(clicks: DataFrame, out: str, checkpoint: str | None = None, tz: str | None = None,
                      n: int = TOP_ADS, trigger: dict | None = None, name: str | None = None,
                      state_partitions: int | None = None, full_every: int = FULL_EVERY) -> StreamingQuery:
    """Top ``n`` ads per (day, area), kept up to date: a batch writes its changed totals per
    (day, area, ad) and the new ranking of the (day, area) groups it touched, nothing else.

    Counts never decrease, so an ad that the batch didn't touch and that was not among the
    top ``n`` can't get there: the changed totals and the old ranking of a group are all
    that its new ranking needs. Every ``full_every``-th batch writes all groups, so that
    a reader needs at most that many folders.
    """
    spark = clicks.sparkSession

    def batch(rows: DataFrame, batch_id: int) -> None:
        changed = write_batch(rows.select(*_names(AREA_TOTALS)), f"{out}/totals", batch_id, spark)
        old = _newest(since_full(read_batches(spark, f"{out}/top", DAILY_TOP), batch_id, full_every))
        touched = changed.select("day", "area").distinct()
        same_group = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("day", "area")]
        same_ad = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("day", "area", "adid")]
        unchanged = (old.alias("o").join(touched.alias("t"), same_group, "left_semi")
                     .alias("o").join(changed.alias("t"), same_ad, "left_anti").select("day", "area", "adid", "clicks"))
        top = ads.daily_top_ads(changed.unionByName(unchanged), n)
        if batch_id % full_every == 0:
            top = top.unionByName(old.alias("o").join(touched.alias("t"), same_group, "left_anti"))
        write_batch(top.select(*_names(DAILY_TOP)), f"{out}/top", batch_id)

    keyed = clicks.select(local_date_of("ts_ms", tz).alias("_d"), "area", "adid")
    totals = (keyed.groupBy("_d", "area", "adid").count()
              .select(F.date_format("_d", DAY_FORMAT).alias("day"), "area", "adid", F.col("count").alias("clicks")))
    writer = totals.writeStream.outputMode("update").foreachBatch(batch)
    return _start(writer, out, checkpoint, trigger, name, state_partitions, spark)


def _newest(top: DataFrame) -> DataFrame:
    """Of each (day, area) the ranking of its last batch (a group has a few rows a batch)."""
    last = F.max("batch").over(Window.partitionBy("day", "area"))
    return top.withColumn("_last", last).where("batch = _last").select(*_names(DAILY_TOP))


def read_top_ads(spark: SparkSession, out: str, full_every: int = FULL_EVERY) -> DataFrame:
    """(day, area, rank, adid, clicks) as of the last batch of ``run_daily_top_ads``."""
    rows = read_batches(spark, f"{out}/top", DAILY_TOP)
    last = rows.agg(F.max("batch")).first()[0]
    return _newest(rows if last is None else since_full(rows, last + 1, full_every))


def read_top_ads_json(spark: SparkSession, out: str, full_every: int = FULL_EVERY) -> DataFrame:
    return ads.top_ads_json(read_top_ads(spark, out, full_every))


# ---- blacklist --------------------------------------------------------------------
def run_blacklist(clicks: DataFrame, out: str, checkpoint: str | None = None,
                  threshold: int = BLACKLIST_THRESHOLD, trigger: dict | None = None,
                  name: str | None = None, state_partitions: int | None = None,
                  full_every: int = FULL_EVERY) -> StreamingQuery:
    """Click-threshold blacklist, the original loop: each micro-batch drops the clicks of
    users blocked before it, adds the others to the counts per (user, ad), and blocks the
    users of whom a count reaches ``threshold``; the crossing batch counts in full.

    A batch writes its accepted clicks (``<out>/accepted``), the new counts of the pairs
    it touched (``<out>/counts``; every ``full_every``-th batch all pairs) and the users it
    blocks (``<out>/blocked``).
    """
    spark = clicks.sparkSession

    def batch(rows: DataFrame, batch_id: int) -> None:
        blocked = read_batches(spark, f"{out}/blocked", BLOCKED_USERS).where(F.col("batch") < batch_id)
        accepted = write_batch(blacklist.drop_blocked(rows.select(*_names(AD_CLICK)), blocked), f"{out}/accepted", batch_id, spark)
        before = _last_counts(since_full(read_batches(spark, f"{out}/counts", USER_AD_COUNTS), batch_id, full_every))
        pair = [F.col(f"n.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("userid", "adid")]
        new = blacklist.user_ad_counts(accepted)
        counts = new.alias("n").join(before.alias("b"), pair, "left").select(
            "n.userid", "n.adid", (F.col("n.clicks") + F.coalesce("b.clicks", F.lit(0))).alias("clicks"))
        if batch_id % full_every == 0:
            counts = counts.unionByName(before.alias("b").join(new.alias("n"), pair, "left_anti"))
        counts = write_batch(counts, f"{out}/counts", batch_id)
        # a full batch also holds the counts of users blocked before
        over = blacklist.drop_blocked(counts.where(F.col("clicks") >= threshold), blocked)
        write_batch(over.select("userid").distinct(), f"{out}/blocked", batch_id)

    return _start(clicks.writeStream.outputMode("append").foreachBatch(batch), out, checkpoint, trigger, name,
                  state_partitions, spark)


def _last_counts(counts: DataFrame) -> DataFrame:
    """(userid, adid, clicks): counts never decrease, so the last one is the largest."""
    return counts.groupBy("userid", "adid").agg(F.max("clicks").alias("clicks"))


def read_accepted_clicks(spark: SparkSession, out: str) -> DataFrame:
    """(ts_ms, area, city, userid, adid, batch): the clicks that passed the blacklist as it
    stood before their batch."""
    return read_batches(spark, f"{out}/accepted", AD_CLICK)


def read_block_batches(spark: SparkSession, out: str) -> DataFrame:
    """(userid, block_batch): the micro-batch in which each user was blocked."""
    return (read_batches(spark, f"{out}/blocked", BLOCKED_USERS)
            .groupBy("userid").agg(F.min("batch").alias("block_batch")))


def read_blacklist(spark: SparkSession, out: str) -> DataFrame:
    """(userid): every blocked user."""
    return read_block_batches(spark, out).select("userid")


def read_user_ad_counts(spark: SparkSession, out: str, full_every: int = FULL_EVERY) -> DataFrame:
    """(userid, adid, clicks): counted clicks per (user, ad)."""
    rows = read_batches(spark, f"{out}/counts", USER_AD_COUNTS)
    last = rows.agg(F.max("batch")).first()[0]
    return _last_counts(rows if last is None else since_full(rows, last + 1, full_every))


# ---- click trend ----------------------------------------------------------------------
def run_click_trend(clicks: DataFrame, out: str, checkpoint: str | None = None,
                    bucket_ms: int = TREND_BUCKET_MS, watermark: str | None = None,
                    trigger: dict | None = None, name: str | None = None,
                    state_partitions: int | None = None) -> StreamingQuery:
    """Running clicks per (ad, ``bucket_ms`` bucket); trends over sliding windows
    and their JSON documents are read from it (``read_click_trend``). With ``watermark``
    buckets older than the watermark are final and leave the state."""
    start = dict(checkpoint=checkpoint, trigger=trigger, name=name, state_partitions=state_partitions)
    if not watermark:
        keyed = clicks.select("adid", bucket_start("ts_ms", bucket_ms).alias("bucket_ms"))
        return _counting(keyed.groupBy("adid", "bucket_ms").count(), None, out, **start)
    timed = clicks.withColumn("event_time", instant_of("ts_ms")).withWatermark("event_time", watermark)
    counts = timed.groupBy("adid", F.window("event_time", f"{int(bucket_ms)} milliseconds").alias("window")).count()
    final = _window_bucket(counts.withColumnRenamed("count", "clicks")).select(*_names(AD_BUCKETS))
    return _counting(counts, final, out, **start)


def _window_bucket(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket_ms", F.unix_millis("window.start")) if "window" in rows.columns else rows


def read_click_buckets(spark: SparkSession, out: str, since_ms: int | None = None,
                       checkpoint: str | None = None) -> DataFrame:
    """(adid, bucket_ms, clicks); with ``since_ms`` the buckets that start at it or later."""
    rows = _current(spark, out, checkpoint, AD_BUCKETS, _window_bucket)
    return rows if since_ms is None else rows.where(F.col("bucket_ms") >= since_ms)


def _window_buckets(spark: SparkSession, out: str, window: str, since_ms: int | None) -> DataFrame:
    return read_click_buckets(spark, out, None if since_ms is None else since_ms - interval_ms(window))


def read_click_trend(spark: SparkSession, out: str, window: str = TREND_WINDOW,
                     slide: str = TREND_SLIDE, keep: int = TREND_KEEP, label_fmt: str = TREND_LABEL,
                     tz: str | None = None, since_ms: int | None = None) -> DataFrame:
    """(window_end_ms, adid, trend_json) over the counted buckets; ``since_ms``
    restricts to windows ending after it (e.g. the last hour for a dashboard)."""
    trend = ads.click_trend(_window_buckets(spark, out, window, since_ms), window, slide, keep)
    if since_ms is not None:
        trend = trend.where(F.col("window_end_ms") > since_ms)
    return ads.trend_json(trend, label_fmt, tz)


def read_latest_click_trend(spark: SparkSession, out: str, window: str = TREND_WINDOW,
                            slide: str = TREND_SLIDE, keep: int = TREND_KEEP,
                            label_fmt: str = TREND_LABEL, tz: str | None = None,
                            since_ms: int | None = None) -> DataFrame:
    """(adid, window_end_ms, trend_json): each ad's newest trend document."""
    buckets = _window_buckets(spark, out, window, since_ms)
    return ads.latest_trend_json(buckets, window, slide, keep, label_fmt, tz)


# ---- click trend over windows held as state ------------------------------------------------
WINDOW_BUCKETS = T.StructType([
    T.StructField("window_start_ms", T.LongType()),
    T.StructField("window_end_ms", T.LongType()),
    *AD_BUCKETS.fields,
])


def run_window_trend(clicks: DataFrame, out: str, watermark: str, checkpoint: str | None = None,
                     window: str = TREND_WINDOW, slide: str = TREND_SLIDE, bucket_ms: int = TREND_BUCKET_MS,
                     trigger: dict | None = None, name: str | None = None,
                     state_partitions: int | None = None) -> StreamingQuery:
    """Clicks per (sliding window, ad, bucket), the windows held as state as the original
    windowed stream holds them. When the watermark passes a window's end, its rows go to
    ``<out>/final`` and leave the state; clicks that come later for it are dropped."""
    timed = clicks.select("adid", bucket_start("ts_ms", bucket_ms).alias("bucket_ms"),
                          instant_of("ts_ms").alias("event_time")).withWatermark("event_time", watermark)
    counts = timed.groupBy(F.window("event_time", window, slide).alias("window"), "adid", "bucket_ms").count()
    final = _window_bounds(counts.withColumnRenamed("count", "clicks"))
    return _counting(counts, final.select(*_names(WINDOW_BUCKETS)), out, checkpoint=checkpoint, trigger=trigger,
                     name=name, state_partitions=state_partitions)


def _window_bounds(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"window_start_ms": F.unix_millis("window.start"), "window_end_ms": F.unix_millis("window.end")})


def read_open_windows(spark: SparkSession, out: str, checkpoint: str | None = None) -> DataFrame:
    """(window_start_ms, window_end_ms, adid, bucket_ms, clicks) of the windows in the state."""
    state = _state(spark, out, checkpoint)
    if state is None:
        return spark.createDataFrame([], WINDOW_BUCKETS)
    return _window_bounds(state.withColumnRenamed("count", "clicks")).select(*_names(WINDOW_BUCKETS))


def read_window_trend(spark: SparkSession, out: str, keep: int = TREND_KEEP, checkpoint: str | None = None) -> DataFrame:
    """(window_start_ms, window_end_ms, adid, bucket_ms, clicks): the first ``keep`` buckets
    of each window and ad, of finished and open windows (see ``ads.trend_json``)."""
    rows = _current(spark, out, checkpoint, WINDOW_BUCKETS, _window_bounds)
    order = Window.partitionBy("window_end_ms", "adid").orderBy("bucket_ms")
    return rows.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= keep).drop("_rn")


# ---- debugging sink -------------------------------------------------------------------
def console_preview(stream: DataFrame, n: int = 10, mode: str = "append",
                    trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Print the first ``n`` rows of every micro-batch."""
    w = (stream.writeStream.format("console").outputMode(mode).option("numRows", n)
         .option("truncate", False).trigger(**(trigger or DEFAULT_TRIGGER)))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()
