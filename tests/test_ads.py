import json

from shoplens.functions.time import day_of
from shoplens.operators import ads
from shoplens.sources.clicks import click_lines, parse_ad_clicks
from tests.conftest import clicks_df

MIDNIGHT = 1_543_190_400_000          # 2018-11-26 00:00:00 UTC


def test_parse_lines_and_rejects(spark):
    # click_lines: good, 4-field, 6-field, non-numeric timestamp, empty line
    lines = spark.createDataFrame(
        [("1543190400000 north beijing 1 2",), ("1543190400000 north beijing 1",),
         ("1543190400000 north beijing 1 2 extra",), ("noon north beijing 1 2",), ("",),
         ("1543190400001 south shanghai 3 4 ",)], "value string")
    clicks, rejects = parse_ad_clicks(lines, strict=True)
    assert sorted(tuple(r) for r in clicks.collect()) == [
        (1543190400000, "north", "beijing", "1", "2"), (1543190400001, "south", "shanghai", "3", "4")]
    assert rejects.count() == 4
    loose, loose_rejects = parse_ad_clicks(lines)      # by position: a sixth field is ignored
    assert loose.count() == 3 and loose_rejects.count() == 3


def test_lines_round_trip(spark):
    rows = [(MIDNIGHT, "north", "beijing", "1", "2"), (MIDNIGHT + 5, "east", "tianjin", "6", "1")]
    clicks, rejects = parse_ad_clicks(click_lines(clicks_df(spark, rows)))
    assert sorted(tuple(r) for r in clicks.collect()) == sorted(rows) and rejects.count() == 0


def test_day_boundary_and_time_zone(spark):
    # clicks_midnight: 1 ms before and at midnight UTC
    df = clicks_df(spark, [(MIDNIGHT - 1, "a", "c", "1", "1"), (MIDNIGHT, "a", "c", "1", "1")])
    utc = sorted((r.day, r.clicks) for r in ads.daily_area_city(df, "UTC").collect())
    assert utc == [("2018-11-25", 1), ("2018-11-26", 1)]
    sh = sorted((r.day, r.clicks) for r in ads.daily_area_city(df, "Asia/Shanghai").collect())
    assert sh == [("2018-11-26", 2)]
    days = [r[0] for r in df.select(day_of("ts_ms")).collect()]     # session zone is UTC here
    assert days == ["2018-11-25", "2018-11-26"]


def test_top_ads_json_in_rank_order(spark):
    rows = []
    for adid, n in [("1", 2), ("2", 5), ("3", 5), ("4", 1)]:
        rows += [(MIDNIGHT, "north", "beijing", "u", adid)] * n
    rows += [(MIDNIGHT, "north", "tianjin", "u", "1")] * 4      # city totals roll up to the area
    top = ads.daily_top_ads(ads.daily_area_city(clicks_df(spark, rows), "UTC"), 3)
    doc = ads.top_ads_json(top).collect()[0]
    assert doc.top_json == '{"1":6,"2":5,"3":5}'
    assert list(json.loads(doc.top_json)) == ["1", "2", "3"]


def test_buckets_and_trend(spark):
    # clicks_buckets: 0, 9 999, 10 000 and 60 000 ms past a bucket edge
    edge = MIDNIGHT
    df = clicks_df(spark, [(edge + d, "a", "c", "u", "7") for d in (0, 9_999, 10_000, 60_000)])
    b = sorted((r.bucket_ms - edge, r.clicks) for r in ads.click_buckets(df, 10_000).collect())
    assert b == [(0, 2), (10_000, 1), (60_000, 1)]
    trend = ads.click_trend(ads.click_buckets(df, 10_000), "60 seconds", "10 seconds", 6)
    by_end = {}
    for r in trend.collect():
        by_end.setdefault(r.window_end_ms - edge, []).append(r.bucket_ms - edge)
    # a 60 s window holds at most 6 of the 10 s buckets; each bucket is in 6 windows
    assert by_end[60_000] == [0, 10_000]
    assert sorted(by_end[70_000]) == [10_000, 60_000]
    assert len(by_end) == 12
    docs = {r.window_end_ms - edge: r.trend_json
            for r in ads.trend_json(trend, "mm:ss", "UTC").collect()}
    assert docs[60_000] == '[{"00:00":2},{"00:10":1}]'


def test_time_arithmetic_matches_python(spark):
    import datetime as dt
    import random
    from zoneinfo import ZoneInfo
    from pyspark.sql import functions as F
    from shoplens.functions.time import bucket_start, day_of, local_date_of
    rnd = random.Random(7)
    values = [rnd.randrange(-2_000_000_000_000, 4_000_000_000_000) for _ in range(300)] + [0, -1, 86_399_999]
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    rows = df.select("ms", bucket_start("ms", 10_000).alias("b"), day_of("ms", "UTC").alias("d"),
                     F.date_format(local_date_of("ms", "Asia/Shanghai"), "yyyy-MM-dd").alias("s")).collect()
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    for r in rows:
        t = epoch + dt.timedelta(milliseconds=r.ms)
        assert r.b == r.ms - r.ms % 10_000                  # Python % floors, like pmod here
        assert r.d == t.strftime("%Y-%m-%d")
        assert r.s == t.astimezone(ZoneInfo("Asia/Shanghai")).strftime("%Y-%m-%d")


def test_newest_trend_equals_the_newest_of_all_windows(spark):
    rows = [(MIDNIGHT + d, "a", "c", "u", ad) for ad, ds in
            {"1": [0, 9_999, 10_000, 60_000, 130_000, 135_000], "2": [5_000], None: [70_000, 72_000]}.items() for d in ds]
    buckets = ads.click_buckets(clicks_df(spark, rows), 10_000)
    for keep in (6, 2):
        docs = ads.trend_json(ads.click_trend(buckets, "60 seconds", "10 seconds", keep), "mm:ss", "UTC")
        newest = {}
        for r in docs.collect():
            newest[r.adid] = max(newest.get(r.adid, (0, "")), (r.window_end_ms, r.trend_json))
        got = ads.latest_trend_json(buckets, "60 seconds", "10 seconds", keep, "mm:ss", "UTC")
        assert {r.adid: (r.window_end_ms, r.trend_json) for r in got.collect()} == newest
