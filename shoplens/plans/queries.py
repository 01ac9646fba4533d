"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed from the driver's test tables through the adapters. Parameters are the
"""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shoplens.operators import ads, blacklist, category, pageflow
from shoplens.operators.filters import in_action_time_range
from shoplens import streaming
from shoplens.params import JobParams
from shoplens.plans import jobs
from shoplens.session import shared_path
from shoplens.sinks.tables import preview, replace_table, replace_version
from shoplens.sources import testviews as tv
from shoplens.sources.actions import read_actions
from shoplens.sources.clicks import (
    GOOD, REASONS, click_lines, observed_counts, parse_ad_clicks, parse_counted, read_click_lines, read_click_lines_stream,
    reject_counts, write_click_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def actions_date_range(spark, sf_dir):
    bounds = "2024-01-08 00:00:00", "2024-01-21"
    return in_action_time_range(tv.actions(spark, sf_dir, *bounds), *bounds)


@query
def category_action_counts(spark, sf_dir):
    return category.category_counts(tv.actions(spark, sf_dir))


@query
def category_counts_sparse_lists(spark, sf_dir):
    """Order lists with empty members at the start, in the middle and at the end."""
    k = F.col("click_product_id") % 4
    lists = F.when(k == 0, F.lit("1,,2,,")).when(k == 1, F.lit(",3")).when(k == 2, F.lit(",,")).otherwise(F.lit(""))
    sparse = tv.actions(spark, sf_dir).where("click_category_id <> -1").select(
        F.lit(-1).cast("bigint").alias("click_category_id"), lists.alias("order_category_ids"),
        F.lit(None).cast("string").alias("pay_category_ids"))
    return category.category_counts(sparse)


@query
def job_category_top10(spark, sf_dir):
    """The batch job end to end: the log written as files by day, read and typed, the
    parameter document with a blank bound (which prunes days), one task id on every row."""
    log = shared_path(spark, "logs", "actions", unique=True)
    (tv.actions(spark, sf_dir).withColumn("page_id", F.col("page_id").cast("string"))
     .hint("rebalance", "date").write.partitionBy("date").parquet(log))  # a large day becomes several files
    params = JobParams.from_json('{"startDate": "2024-01-08 00:00:00", "endDate": "  "}')
    return jobs.category_top10_job(read_actions(spark, log), params, "task-0")


@query
def category_top10(spark, sf_dir):
    return category.top_categories(tv.actions(spark, sf_dir), 10)


@query
def category_session_top10(spark, sf_dir):
    return category.top_sessions(tv.actions(spark, sf_dir), 10, 10)


@query
def table_round_trip(spark, sf_dir):
    """J1's result written as a catalog table (replaced when it exists) and read back."""
    location = shared_path(spark, "tables", "category_top10", unique=True)
    name = "category_top10_" + location.rsplit("/", 1)[-1][:12]
    replace_table(category.top_categories(tv.actions(spark, sf_dir), 10), name, path=location)
    return spark.table(name)


@query
def table_versions(spark, sf_dir):
    """J1's result as a view that is switched from one written version to the next: from the
    counts of all categories to the top ones."""
    location = shared_path(spark, "tables", "category_versions", unique=True)
    name = "category_versions_" + location.rsplit("/", 1)[-1][:12]
    counts = category.category_counts(tv.actions(spark, sf_dir))
    replace_version(counts, name, location)
    replace_version(category.top_categories(tv.actions(spark, sf_dir), 10), name, location)
    return spark.table(name)


@query
def actions_preview(spark, sf_dir):
    """The first 100 actions of the log, as a job prints them (here to nowhere)."""
    with contextlib.redirect_stdout(io.StringIO()):
        return preview(tv.actions(spark, sf_dir).orderBy(tv.TIE), 100)


# ---- page flow ---------------------------------------------------------------
FLOW = (1, 2, 3, 4, 5, 6, 7)


def _rounded(df: DataFrame, col: str = "rate", places: int = 6) -> DataFrame:
    return df.withColumn(col, F.round(col, places))


@query
def page_visits(spark, sf_dir):
    return pageflow.page_visits(tv.actions(spark, sf_dir), FLOW)


@query
def page_jump_counts(spark, sf_dir):
    return pageflow.jump_counts(tv.actions(spark, sf_dir), FLOW, dedupe="none", tie=tv.TIE)


@query
def page_jump_counts_all_targets(spark, sf_dir):
    """Local rows (the target jumps) written as a table and joined: also jumps never seen."""
    location = shared_path(spark, "tables", "target_jumps", unique=True)
    name = "target_jumps_" + location.rsplit("/", 1)[-1][:12]
    pairs = spark.createDataFrame([*pageflow.target_jumps(FLOW), (7, 1), (1, 99)], "from_page bigint, to_page bigint")
    replace_table(pairs, name, path=location)
    seen = pageflow.jump_counts(tv.actions(spark, sf_dir), FLOW, dedupe="none", tie=tv.TIE)
    return spark.table(name).join(seen.drop("flow"), ["from_page", "to_page"], "left").select(
        "from_page", "to_page", F.coalesce("jumps", F.lit(0)).alias("jumps"))


@query
def page_jump_counts_last(spark, sf_dir):
    return pageflow.jump_counts(tv.actions(spark, sf_dir), FLOW, dedupe="last", tie=tv.TIE)


@query
def page_jump_rate(spark, sf_dir):
    return _rounded(pageflow.jump_rate(tv.actions(spark, sf_dir), FLOW, dedupe="last", tie=tv.TIE))


@query
def page_jump_rate_all(spark, sf_dir):
    return _rounded(pageflow.jump_rate(tv.actions(spark, sf_dir), FLOW, dedupe="none", tie=tv.TIE))


@query
def page_jump_rate_whole(spark, sf_dir):
    return pageflow.jump_rate(tv.actions(spark, sf_dir), FLOW, dedupe="none", whole_percent=True,
                             tie=tv.TIE)


@query
def page_jump_rate_ranges(spark, sf_dir):
    """The rate with sessions split by ranges of the sort order instead of by minute."""
    return _rounded(pageflow.jump_rate(tv.actions(spark, sf_dir), FLOW, dedupe="last", tie=tv.TIE, chunk=pageflow.RANGES))


@query
def page_jump_counts_one_session(spark, sf_dir):
    """All actions as one session without an id, and as of one minute: the densest key."""
    flat = tv.actions(spark, sf_dir).withColumns({
        "session_id": F.lit(None).cast("string"),
        "action_time": F.concat(F.lit("2024-01-01 00:00:"), F.substring("action_time", 18, 2))})
    return pageflow.jump_counts(flat, FLOW, dedupe="none", tie=tv.TIE, chunk=pageflow.RANGES)


@query
def page_jump_rate_no_tie(spark, sf_dir):
    """Sessions cut to whole hours, so that many actions share a time; no tie column."""
    hourly = tv.actions(spark, sf_dir).withColumn(
        "action_time", F.concat(F.substring("action_time", 1, 13), F.lit(":00:00")))
    return _rounded(pageflow.jump_rate(hourly, FLOW, dedupe="last"))


# ---- ad clicks -----------------------------------------------------------------
# Test-data parameters (clicks are ~20 minutes apart at sf0.01, and the largest
# (user, ad) count is 6-10): hourly buckets, 6-hour windows sliding by 1 hour,
# threshold 5, 6-hour micro-batches for the blacklist loop.
TZ = "UTC"
BUCKET_MS = 3_600_000
WINDOW, SLIDE, KEEP = "6 hours", "1 hour", 6
LABEL_FMT = "HH:mm"
THRESHOLD = 5
BATCH_MS = 6 * 3_600_000
AVAILABLE_NOW = {"availableNow": True}


def parsed_clicks(spark, sf_dir):
    """Clicks that went through the text-line format and the parser."""
    lines = click_lines(tv.ad_clicks(spark, sf_dir))
    clicks, _ = parse_ad_clicks(lines)
    return clicks


@query
def ad_click_parse(spark, sf_dir):
    return parsed_clicks(spark, sf_dir)


def spoilt_lines(spark, sf_dir):
    """Click lines spoilt by their event id: the last field gone, a sixth one (still good,
    fields are read by position), a time that is no number."""
    clicks = tv.ad_clicks(spark, sf_dir)
    line = click_lines(clicks.withColumn("adid", F.concat_ws("#", "adid", "event_id"))).select("value")
    event, k = F.substring_index("value", "#", -1), F.substring_index("value", "#", -1).cast("bigint") % 4
    plain = F.substring_index("value", "#", 1)
    spoilt = (F.when(k == 0, plain).when(k == 1, F.regexp_replace(plain, " [^ ]+$", ""))
              .when(k == 2, F.concat(plain, F.lit(" "), event)).otherwise(F.concat(F.lit("x"), plain)))
    return line.select(spoilt.alias("value"))


@query
def ad_click_rejects(spark, sf_dir):
    """Good lines and rejected ones by reason."""
    good, rejects = parse_ad_clicks(spoilt_lines(spark, sf_dir))
    return reject_counts(rejects).unionByName(
        good.agg(F.count("*").alias("lines")).withColumn("reason", F.lit("good")))


def _outcomes(spark, counts):
    return spark.createDataFrame([(r, counts[r]) for r in (GOOD, *REASONS) if counts[r]], "reason string, lines bigint")


@query
def ad_click_rejects_observed(spark, sf_dir):
    """The same counts, observed while the good clicks are written: one pass over the lines."""
    seen = Observation("lines")
    clicks = parse_counted(spoilt_lines(spark, sf_dir), seen)
    clicks.write.parquet(shared_path(spark, "clicks", unique=True))
    return _outcomes(spark, seen.get)


@query
def stream_rejects_observed(spark, sf_dir):
    """The same counts from the progress of a stream that keeps the good clicks."""
    topic, out = shared_path(spark, "topics", "spoilt", unique=True), _stream_out(spark, "good_clicks")
    spoilt_lines(spark, sf_dir).repartition(4).write.text(topic)
    clicks = parse_counted(read_click_lines_stream(spark, "text", topic, maxFilesPerTrigger=2), "lines")
    q = (clicks.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(**AVAILABLE_NOW).start())
    _run(q)
    return _outcomes(spark, observed_counts(q.recentProgress, "lines"))


@query
def ads_daily_area_city(spark, sf_dir):
    return ads.daily_area_city(parsed_clicks(spark, sf_dir), TZ)


@query
def ads_daily_top3(spark, sf_dir):
    return ads.daily_top_ads(ads.daily_area_city(parsed_clicks(spark, sf_dir), TZ), 3)


@query
def ads_daily_top3_json(spark, sf_dir):
    return ads.top_ads_json(ads.daily_top_ads(ads.daily_area_city(parsed_clicks(spark, sf_dir), TZ), 3))


@query
def ad_click_buckets(spark, sf_dir):
    return ads.click_buckets(parsed_clicks(spark, sf_dir), BUCKET_MS)


@query
def ad_click_trend(spark, sf_dir):
    return ads.click_trend(ads.click_buckets(parsed_clicks(spark, sf_dir), BUCKET_MS), WINDOW, SLIDE, KEEP)


@query
def ad_click_trend_json(spark, sf_dir):
    trend = ads.click_trend(ads.click_buckets(parsed_clicks(spark, sf_dir), BUCKET_MS), WINDOW, SLIDE, KEEP)
    return ads.trend_json(trend, LABEL_FMT, TZ)


@query
def ad_click_trend_keep3(spark, sf_dir):
    """Windows with more buckets than are kept, labels in the default format."""
    trend = ads.click_trend(ads.click_buckets(parsed_clicks(spark, sf_dir), BUCKET_MS), WINDOW, SLIDE, 3)
    return ads.trend_json(trend, tz=TZ)


@query
def ad_click_trend_latest(spark, sf_dir):
    buckets = ads.click_buckets(parsed_clicks(spark, sf_dir), BUCKET_MS)
    return ads.latest_trend_json(buckets, WINDOW, SLIDE, KEEP, LABEL_FMT, TZ)


# ---- blacklist -------------------------------------------------------------------
@query
def blacklist_users(spark, sf_dir):
    return blacklist.blocked_users(parsed_clicks(spark, sf_dir), THRESHOLD)


@query
def blacklist_user_ad_counts(spark, sf_dir):
    return blacklist.user_ad_counts(parsed_clicks(spark, sf_dir))


@query
def blacklist_filtered_clicks(spark, sf_dir):
    clicks = tv.ad_clicks(spark, sf_dir)
    return blacklist.drop_blocked(clicks, blacklist.blocked_users(clicks, THRESHOLD))


@query
def blacklist_filtered_prefiltered(spark, sf_dir):
    """The same through the bitmap of blocked users: few clicks reach the anti join."""
    clicks = tv.ad_clicks(spark, sf_dir)
    return blacklist.drop_blocked_prefiltered(clicks, blacklist.blocked_users(clicks, THRESHOLD))


@query
def blacklist_block_batches(spark, sf_dir):
    clicks = blacklist.with_batches(parsed_clicks(spark, sf_dir), BATCH_MS)
    return blacklist.block_batches(clicks, THRESHOLD)


@query
def blacklist_accepted_counts(spark, sf_dir):
    clicks = blacklist.with_batches(parsed_clicks(spark, sf_dir), BATCH_MS)
    return blacklist.accepted_counts(clicks, THRESHOLD)


# ---- streaming twins -------------------------------------------------------------
# The events table is read as a file stream, turned into ad-click lines and parsed
# back, then fed to the streaming job under an availableNow trigger; the result is
# read from the job's state or its folders of micro-batches. Output folders are unique
# per call, below the shared checkpoint folder.
def stream_clicks(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a pattern that matches the table alone, be it one file or a folder of files
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    customer, nation, region = tv.load_tables(spark, sf_dir, "customer", "nation", "region")
    clicks, _ = parse_ad_clicks(click_lines(tv.ad_clicks_from_events(events, customer, nation, region)))
    return clicks


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _stream_out(spark, name):
    return shared_path(spark, "streams", name, unique=True)


def _state_parts(spark):
    # State partitions are fixed when a query first starts; size them to the
    # cluster's cores rather than to a shuffle-partition default sized for batch.
    return spark.sparkContext.defaultParallelism


@query
def stream_ads_daily_area_city(spark, sf_dir):
    out = _stream_out(spark, "daily")
    _run(streaming.run_daily_totals(stream_clicks(spark, sf_dir), out, tz=TZ, trigger=AVAILABLE_NOW,
                                    state_partitions=_state_parts(spark)))
    return streaming.read_daily_totals(spark, out)


def published_click_stream(spark, sf_dir):
    """The click feed published as text lines (as a topic would hold them; as many files
    as the table gives tasks) and read back as a stream."""
    topic = shared_path(spark, "topics", "ads_log", unique=True)
    write_click_lines(tv.ad_clicks(spark, sf_dir), topic)
    clicks, _ = parse_ad_clicks(read_click_lines_stream(spark, "text", topic))
    return clicks


SLICE_MS = 5 * 86_400_000


def run_in_slices(spark, sf_dir, start, slice_ms=SLICE_MS, late=0):
    """Publish the click feed in slices of time (written once, a folder per slice); the job
    is started on the same checkpoint again with each further slice and takes it as one
    micro-batch. With ``late``, every seventh click is published that many slices after
    its own. Returns the slices in the order of the job's data batches."""
    topic = shared_path(spark, "topics", "ads_log", unique=True)
    own = F.floor(F.col("ts_ms") / slice_ms)
    feed = tv.ad_clicks(spark, sf_dir).withColumn("slice", own + F.when(F.col("event_id") % 7 == 0, late).otherwise(0))
    write_click_lines(feed, topic, partition_by=["slice"])
    slices = sorted(r["slice"] for r in read_click_lines(spark, topic).select("slice").distinct().collect())  # of time, not of rows
    for i in range(len(slices)):
        known = ",".join(str(x) for x in slices[:i + 1])
        clicks, _ = parse_ad_clicks(read_click_lines_stream(spark, "text", f"{topic}/slice={{{known}}}"))
        _run(start(clicks))
    return slices


def _blacklist_in_slices(spark, sf_dir):
    """(output folder, (batch, slice)): a data batch of this job is every batch it has."""
    out = _stream_out(spark, "blacklist_slices")
    slices = run_in_slices(spark, sf_dir, lambda clicks: streaming.run_blacklist(
        clicks, out, threshold=THRESHOLD, trigger=AVAILABLE_NOW, full_every=4))
    return out, spark.createDataFrame(list(enumerate(slices)), "batch bigint, slice bigint")


@query
def stream_blacklist_accepted_counts(spark, sf_dir):
    """The feedback loop over micro-batches: users blocked in one are not counted in the
    next ones."""
    out, _ = _blacklist_in_slices(spark, sf_dir)
    return streaming.read_user_ad_counts(spark, out, full_every=4)


@query
def stream_accepted_clicks(spark, sf_dir):
    """The clicks themselves that pass the blacklist as it stands before their batch."""
    out, slices = _blacklist_in_slices(spark, sf_dir)
    clicks = streaming.read_accepted_clicks(spark, out).join(F.broadcast(slices), "batch")
    return clicks.select("ts_ms", "area", "city", "userid", "adid", "slice")


@query
def stream_top3_kept(spark, sf_dir):
    """Top-3 ads kept up to date over several micro-batches: each ranks the groups it touched."""
    out = _stream_out(spark, "top3")
    run_in_slices(spark, sf_dir, lambda clicks: streaming.run_daily_top_ads(
        clicks, out, tz=TZ, trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark), full_every=4), late=1)
    return streaming.read_top_ads(spark, out, full_every=4)


@query
def stream_top3_kept_json(spark, sf_dir):
    out = _stream_out(spark, "top3")
    run_in_slices(spark, sf_dir, lambda clicks: streaming.run_daily_top_ads(
        clicks, out, tz=TZ, trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark), full_every=4), late=1)
    return streaming.read_top_ads_json(spark, out, full_every=4)


WATERMARK = "3 days"


@query
def stream_daily_final(spark, sf_dir):
    """Days that the watermark has passed, each written once; every seventh click comes two
    slices late, and those whose day is already final by then are dropped."""
    out = _stream_out(spark, "daily_final")
    run_in_slices(spark, sf_dir, lambda clicks: streaming.run_daily_totals(
        clicks, out, tz=TZ, watermark=WATERMARK, trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark)), late=2)
    return streaming.read_final_daily_totals(spark, out)


@query
def stream_daily_watermarked(spark, sf_dir):
    """The same job's current totals: final days and those still in the state."""
    out = _stream_out(spark, "daily_watermarked")
    run_in_slices(spark, sf_dir, lambda clicks: streaming.run_daily_totals(
        clicks, out, tz=TZ, watermark=WATERMARK, trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark)), late=2)
    return streaming.read_daily_totals(spark, out)


@query
def stream_daily_snapshot(spark, sf_dir):
    """Every key in every batch; the snapshot of the last one."""
    out = _stream_out(spark, "snapshots")
    run_in_slices(spark, sf_dir, lambda clicks: streaming.run_daily_snapshots(
        clicks, out, tz=TZ, trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark)))
    return streaming.read_last_snapshot(spark, out)


@query
def stream_window_trend(spark, sf_dir):
    """Sliding windows held as state, the finished ones written as the watermark passes."""
    out = _stream_out(spark, "windows")
    run_in_slices(spark, sf_dir, lambda clicks: streaming.run_window_trend(
        clicks, out, "1 day", window=WINDOW, slide=SLIDE, bucket_ms=BUCKET_MS, trigger=AVAILABLE_NOW,
        state_partitions=_state_parts(spark)))
    return streaming.read_window_trend(spark, out, KEEP)


@query
def stream_blacklist_block_batches(spark, sf_dir):
    out, slices = _blacklist_in_slices(spark, sf_dir)
    blocks = streaming.read_block_batches(spark, out)
    return blocks.join(F.broadcast(slices), blocks.block_batch == slices.batch).select(
        "userid", F.col("slice").alias("block_batch"))


@query
def stream_restart_daily(spark, sf_dir):
    """Daily totals of a job that is stopped and started again on its checkpoint while the
    feed goes on."""
    out = _stream_out(spark, "daily_restart")
    run_in_slices(spark, sf_dir, lambda clicks: streaming.run_daily_totals(
        clicks, out, tz=TZ, trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark)), 15 * 86_400_000)
    return streaming.read_daily_totals(spark, out)


@query
def stream_lines_ads_daily_area_city(spark, sf_dir):
    out = _stream_out(spark, "daily_lines")
    _run(streaming.run_daily_totals(published_click_stream(spark, sf_dir), out, tz=TZ,
                                    trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark)))
    return streaming.read_daily_totals(spark, out)


@query
def stream_lines_blacklist_users(spark, sf_dir):
    """Who is blocked does not depend on where the batch boundaries fall (only the
    frozen counts do), so this equals the batch query."""
    out = _stream_out(spark, "blacklist_lines")
    _run(streaming.run_blacklist(published_click_stream(spark, sf_dir), out, threshold=THRESHOLD,
                                 trigger=AVAILABLE_NOW))
    return streaming.read_blacklist(spark, out)


@query
def stream_trigger_daily(spark, sf_dir):
    """The running job as it is deployed: a micro-batch every five seconds, until stopped."""
    out = _stream_out(spark, "daily_trigger")
    q = streaming.run_daily_totals(published_click_stream(spark, sf_dir), out, tz=TZ,
                                   state_partitions=_state_parts(spark))
    q.processAllAvailable()
    q.stop()
    if q.exception() is not None:
        raise q.exception()
    return streaming.read_daily_totals(spark, out)


@query
def stream_ads_daily_top3(spark, sf_dir):
    out = _stream_out(spark, "daily")
    _run(streaming.run_daily_totals(stream_clicks(spark, sf_dir), out, tz=TZ, trigger=AVAILABLE_NOW,
                                    state_partitions=_state_parts(spark)))
    return streaming.read_daily_top_ads(spark, out, 3)


@query
def stream_blacklist_users(spark, sf_dir):
    out = _stream_out(spark, "blacklist")
    _run(streaming.run_blacklist(stream_clicks(spark, sf_dir), out, threshold=THRESHOLD,
                                 trigger=AVAILABLE_NOW))
    return streaming.read_blacklist(spark, out)


@query
def stream_blacklist_counts(spark, sf_dir):
    out = _stream_out(spark, "blacklist")
    _run(streaming.run_blacklist(stream_clicks(spark, sf_dir), out, threshold=THRESHOLD,
                                 trigger=AVAILABLE_NOW))
    return streaming.read_user_ad_counts(spark, out)


@query
def stream_click_trend(spark, sf_dir):
    out = _stream_out(spark, "trend")
    _run(streaming.run_click_trend(stream_clicks(spark, sf_dir), out, bucket_ms=BUCKET_MS,
                                   trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark)))
    return streaming.read_click_trend(spark, out, WINDOW, SLIDE, KEEP, LABEL_FMT, TZ)


@query
def stream_click_trend_latest(spark, sf_dir):
    out = _stream_out(spark, "trend")
    _run(streaming.run_click_trend(stream_clicks(spark, sf_dir), out, bucket_ms=BUCKET_MS,
                                   trigger=AVAILABLE_NOW, state_partitions=_state_parts(spark)))
    return streaming.read_latest_click_trend(spark, out, WINDOW, SLIDE, KEEP, LABEL_FMT, TZ)


@query
def stream_ads_daily_top3_json(spark, sf_dir):
    out = _stream_out(spark, "daily")
    _run(streaming.run_daily_totals(stream_clicks(spark, sf_dir), out, tz=TZ, trigger=AVAILABLE_NOW,
                                    state_partitions=_state_parts(spark)))
    return streaming.read_daily_top_json(spark, out, 3)
