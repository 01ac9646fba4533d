import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens import streaming
from shoplens.operators import ads, blacklist
from shoplens.sinks.batches import read_batches
from shoplens.schemas import DAILY_TOP, USER_AD_COUNTS
from shoplens.sources.clicks import parse_ad_clicks, read_click_lines_stream
from tests.conftest import clicks_df
from tests.test_blacklist import model_loop

NOW = {"availableNow": True}
T0 = 1_543_190_400_000      # 2018-11-26 00:00:00 UTC


def _write_batches(batches):
    """One text file per micro-batch; lines "<ts> <area> <city> <user> <ad>"."""
    d = tempfile.mkdtemp(prefix="shoplens-lines-")
    for i, batch in enumerate(batches):
        with open(os.path.join(d, f"part-{i:04d}.txt"), "w") as f:
            f.write("\n".join(" ".join(str(x) for x in row) for row in batch) + "\n")
        os.utime(os.path.join(d, f"part-{i:04d}.txt"), (1_000_000 + i, 1_000_000 + i))
    return d


def _clicks_stream(spark, d):
    lines = read_click_lines_stream(spark, "text", d, maxFilesPerTrigger=1)
    clicks, _ = parse_ad_clicks(lines)
    return clicks


def _done(q):
    q.awaitTermination()
    assert q.exception() is None


def _tuples(df):
    return sorted(map(tuple, df.collect()))


def _out():
    return tempfile.mkdtemp(prefix="shoplens-out-")


def test_blacklist_stream_equals_loop_and_batch(spark):
    batches = [[(T0 + i, "north", "bj", u, a) for i, (u, a) in enumerate(b)] for b in [
        [("u1", "x"), ("u1", "x"), ("u2", "x")],
        [("u1", "x"), ("u1", "y"), ("u2", "y")],
        [("u1", "y"), ("u2", "x"), ("u2", "x")],
        [("u2", "x"), ("u1", "x"), ("u3", "x")],
    ]]
    out = _out()
    q = streaming.run_blacklist(_clicks_stream(spark, _write_batches(batches)), out, threshold=3,
                                trigger=NOW)
    q.awaitTermination()
    assert q.exception() is None
    full = _out()
    _done(streaming.run_blacklist(_clicks_stream(spark, _write_batches(batches)), full, threshold=3, trigger=NOW, full_every=2))
    assert _tuples(streaming.read_user_ad_counts(spark, full, full_every=2)) == _tuples(streaming.read_user_ad_counts(spark, out))
    assert _tuples(streaming.read_block_batches(spark, full)) == _tuples(streaming.read_block_batches(spark, out))
    at = {r.batch: r.n for r in read_batches(spark, f"{full}/counts", USER_AD_COUNTS).groupBy("batch")
          .agg(F.count("*").alias("n")).collect()}
    assert at == {0: 2, 1: 3, 2: 4, 3: 1}                  # batch 2 writes all pairs, the others what they touched
    counts, blocked = model_loop([[(r[3], r[4]) for r in b] for b in batches], 3)
    got = {(r.userid, r.adid): r.clicks for r in streaming.read_user_ad_counts(spark, out).collect()}
    assert got == counts
    assert {r.userid for r in streaming.read_blacklist(spark, out).collect()} == blocked
    blocked_at = {r.userid: r.block_batch for r in streaming.read_block_batches(spark, out).collect()}
    # batch twin with the file index as batch id
    rows = [(b * 10_000 + r[0] - T0, *r[1:]) for b, batch in enumerate(batches) for r in batch]
    df = blacklist.with_batches(clicks_df(spark, rows), 10_000)
    twin = {(r.userid, r.adid): r.clicks for r in blacklist.accepted_counts(df, 3).collect()}
    assert twin == counts
    assert blocked_at == {r.userid: r.block_batch for r in blacklist.block_batches(df, 3).collect()}
    # the accepted clicks themselves: those up to and including the user's blocking batch
    passed = sorted((b, *r) for b, batch in enumerate(batches) for r in batch if b <= blocked_at.get(r[3], len(batches)))
    assert sorted((r.batch, r.ts_ms, r.area, r.city, r.userid, r.adid)
                  for r in streaming.read_accepted_clicks(spark, out).collect()) == passed


def test_daily_totals_stream_restart_adds_nothing(spark):
    batches = [[(T0 + 1, "north", "bj", "u1", "1"), (T0 + 2, "north", "tj", "u1", "2")],
               [(T0 + 3, "north", "bj", "u2", "1"), (T0 - 1, "south", "sh", "u3", "3")],
               [(T0 + 4, "north", "bj", "u2", "2"), (T0 + 5, "north", "bj", "u2", "2")]]
    src = _write_batches(batches)
    out = _out()
    for _ in range(2):       # the second run resumes from the checkpoint: nothing new
        q = streaming.run_daily_totals(_clicks_stream(spark, src), out, tz="UTC", trigger=NOW,
                                       state_partitions=3)
        q.awaitTermination()
        assert q.exception() is None
    allrows = [r for b in batches for r in b]
    expected = ads.daily_area_city(clicks_df(spark, allrows), "UTC")
    got = streaming.read_daily_totals(spark, out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    top = ads.daily_top_ads(expected, 3)
    assert sorted(map(tuple, streaming.read_daily_top_ads(spark, out).collect())) == \
        sorted(map(tuple, top.collect()))


def test_trend_stream_equals_batch(spark):
    batches = [[(T0 + d, "a", "c", "u", ad) for d, ad in b] for b in [
        [(0, "1"), (9_999, "1"), (10_000, "2")],
        [(60_000, "1"), (65_000, "2")],
        [(15_000, "1"), (130_000, "1")],
    ]]
    out = _out()
    q = streaming.run_click_trend(_clicks_stream(spark, _write_batches(batches)), out,
                                  bucket_ms=10_000, trigger=NOW)
    q.awaitTermination()
    assert q.exception() is None
    allrows = [r for b in batches for r in b]
    trend = ads.click_trend(ads.click_buckets(clicks_df(spark, allrows), 10_000),
                            "60 seconds", "10 seconds", 6)
    expected = ads.trend_json(trend, "mm:ss", "UTC")
    got = streaming.read_click_trend(spark, out, "60 seconds", "10 seconds", 6, "mm:ss", "UTC")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    latest = {r.adid: (r.window_end_ms - T0, r.trend_json) for r in
              streaming.read_latest_click_trend(spark, out, "60 seconds", "10 seconds", 6, "mm:ss",
                                                "UTC").collect()}
    assert latest == {"1": (190_000, '[{"02:10":1}]'), "2": (120_000, '[{"01:00":1}]')}
    recent = streaming.read_click_trend(spark, out, "60 seconds", "10 seconds", 6, "mm:ss", "UTC",
                                        since_ms=T0 + 120_000)
    assert sorted(map(tuple, recent.collect())) == sorted(
        t for t in map(tuple, expected.collect()) if t[0] > T0 + 120_000)


def test_watermark_drops_late_clicks(spark):
    day = 86_400_000
    batches = [[(T0, "n", "bj", "u", "1")],
               [(T0 + 3 * day, "n", "bj", "u", "1")],
               [(T0 + 3 * day + 1, "n", "bj", "u", "1")],
               [(T0 + 5, "n", "bj", "u", "1")]]          # 3 days late
    src = _write_batches(batches)
    late, keep = _out(), _out()
    q = streaming.run_daily_totals(_clicks_stream(spark, src), late, tz="UTC", watermark="1 day", trigger=NOW)
    q.awaitTermination()
    q = streaming.run_daily_totals(_clicks_stream(spark, src), keep, tz="UTC", trigger=NOW)
    q.awaitTermination()
    with_wm = {r.day: r.clicks for r in streaming.read_daily_totals(spark, late).collect()}
    without = {r.day: r.clicks for r in streaming.read_daily_totals(spark, keep).collect()}
    assert without == {"2018-11-26": 2, "2018-11-29": 2}
    assert with_wm == {"2018-11-26": 1, "2018-11-29": 2}


def test_trend_watermark_path_matches_batch_for_in_order_data(spark):
    batches = [[(T0 + d, "a", "c", "u", "1") for d in b] for b in [[0, 5_000], [20_000], [70_000]]]
    out = _out()
    q = streaming.run_click_trend(_clicks_stream(spark, _write_batches(batches)), out,
                                  bucket_ms=10_000, watermark="10 minutes", trigger=NOW,
                                  state_partitions=2)
    q.awaitTermination()
    assert q.exception() is None
    allrows = [r for b in batches for r in b]
    expected = ads.trend_json(ads.click_trend(ads.click_buckets(clicks_df(spark, allrows), 10_000),
                                              "60 seconds", "10 seconds", 6), "mm:ss", "UTC")
    got = streaming.read_click_trend(spark, out, "60 seconds", "10 seconds", 6, "mm:ss", "UTC")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_console_preview_runs(spark):
    src = _write_batches([[(T0, "a", "c", "u", "1")]])
    q = streaming.console_preview(_clicks_stream(spark, src), n=10, trigger=NOW,
                                  checkpoint=_out())
    q.awaitTermination()
    assert q.exception() is None


def test_daily_totals_come_from_the_state(spark):
    src = _write_batches([[(T0 - 86_400_000, "n", "bj", "u", "1"), (T0, "n", "bj", "u", "1")],
                          [(T0 + 5, "n", "bj", "u", "2"), (T0 + 6, None, "bj", "u", "2")]])
    out = _out()
    _done(streaming.run_daily_totals(_clicks_stream(spark, src), out, tz="UTC", trigger=NOW, state_partitions=2))
    assert os.listdir(out) == ["_checkpoint"]              # nothing but the state
    recent = streaming.read_daily_totals(spark, out, since_day="2018-11-26")
    assert sorted((r.day, str(r.area), r.adid, r.clicks) for r in recent.collect()) == [
        ("2018-11-26", "None", "2", 1), ("2018-11-26", "n", "1", 1), ("2018-11-26", "n", "2", 1)]
    top = streaming.read_daily_top_json(spark, out, 3).where("area is not null")
    assert {r.day: r.top_json for r in top.collect()} == {"2018-11-25": '{"1":1}', "2018-11-26": '{"1":1,"2":1}'}


def test_a_stream_without_clicks_has_an_empty_result(spark, tmp_path):
    src = str(tmp_path / "lines")
    os.makedirs(src)
    clicks, _ = parse_ad_clicks(read_click_lines_stream(spark, "text", src))
    a, b, c, d, e = (str(tmp_path / x) for x in "abcde")
    _done(streaming.run_daily_totals(clicks, a, tz="UTC", trigger=NOW))
    _done(streaming.run_blacklist(clicks, b, trigger=NOW))
    _done(streaming.run_daily_top_ads(clicks, c, tz="UTC", trigger=NOW))
    _done(streaming.run_window_trend(clicks, d, "1 minute", trigger=NOW))
    _done(streaming.run_daily_snapshots(clicks, e, tz="UTC", trigger=NOW))
    for df in (streaming.read_daily_totals(spark, a), streaming.read_blacklist(spark, b), streaming.read_accepted_clicks(spark, b),
               streaming.read_user_ad_counts(spark, b), streaming.read_top_ads(spark, c), streaming.read_window_trend(spark, d),
               streaming.read_final_daily_totals(spark, a), streaming.read_last_snapshot(spark, e)):
        assert df.collect() == []


def test_top_ads_are_ranked_only_where_a_batch_touched(spark):
    day = 86_400_000
    batches = [[(T0, "n", "bj", "u", ad) for ad in "1122334"] + [(T0, "s", "sh", "u", "9")],
               [(T0 + 1, "n", "tj", "u", "4"), (T0 + 2, "n", "bj", "u", "4")],       # 4 overtakes
               [(T0 + day, "s", "sh", "u", "1")],                                    # a new group
               [(T0 + 3, "s", "sh", "u", "8"), (T0 + 3, "s", "sh", "u", "8")],
               [(T0 + day + 1, "s", "sh", "u", "1")]]
    out = _out()
    _done(streaming.run_daily_top_ads(_clicks_stream(spark, _write_batches(batches)), out, tz="UTC", n=3, trigger=NOW,
                                      state_partitions=2, full_every=4))
    written = read_batches(spark, f"{out}/top", DAILY_TOP).select("batch", "day", "area").distinct()
    assert sorted((r.batch, r.day[-2:], r.area) for r in written.collect()) == [
        (0, "26", "n"), (0, "26", "s"), (1, "26", "n"), (2, "27", "s"), (3, "26", "s"),
        (4, "26", "n"), (4, "26", "s"), (4, "27", "s")]    # batch 4 is a full one
    twin = ads.daily_top_ads(ads.daily_area_city(clicks_df(spark, [r for b in batches for r in b]), "UTC"), 3)
    assert _tuples(streaming.read_top_ads(spark, out, full_every=4)) == _tuples(twin)
    assert _tuples(streaming.read_top_ads_json(spark, out, full_every=4)) == _tuples(ads.top_ads_json(twin))
    totals = os.listdir(f"{out}/totals")
    assert sorted(totals) == [f"batch={i}" for i in range(5)]


@pytest.mark.parametrize("seed", [4, 5])
def test_kept_top_ads_equal_the_batch_job_after_every_batch(spark, seed):
    import random
    rnd = random.Random(seed)
    batches = [[(T0 + rnd.randrange(3) * 86_400_000, rnd.choice("ns"), rnd.choice("xy"), "u", rnd.choice("123456"))
                for _ in range(rnd.randint(1, 25))] for _ in range(6)]
    src, out, seen = _write_batches([]), _out(), []
    for i, b in enumerate(batches):
        with open(os.path.join(src, f"part-{i}.txt"), "w") as f:
            f.write("".join(" ".join(map(str, r)) + "\n" for r in b))
        seen += b
        _done(streaming.run_daily_top_ads(_clicks_stream(spark, src), out, tz="UTC", n=2, trigger=NOW, state_partitions=2,
                                          full_every=3))
        twin = ads.daily_top_ads(ads.daily_area_city(clicks_df(spark, seen), "UTC"), 2)
        assert _tuples(streaming.read_top_ads(spark, out, full_every=3)) == _tuples(twin)


def test_every_snapshot_has_every_key(spark):
    batches = [[(T0, "n", "bj", "u", "1"), (T0, "n", "bj", "u", "2")], [(T0 + 1, "n", "bj", "u", "1")], [(T0 + 2, "s", "sh", "u", "3")]]
    out = _out()
    _done(streaming.run_daily_snapshots(_clicks_stream(spark, _write_batches(batches)), out, tz="UTC", trigger=NOW, state_partitions=2))
    for i in range(3):
        twin = ads.daily_area_city(clicks_df(spark, [r for b in batches[:i + 1] for r in b]), "UTC")
        got = streaming.read_snapshots(spark, out).where(F.col("batch") == i).drop("batch")
        assert _tuples(got) == _tuples(twin)
    assert _tuples(streaming.read_last_snapshot(spark, out)) == _tuples(twin)


def test_finished_windows_leave_the_state_and_are_written_once(spark):
    batches = [[(T0 + s * 1000, "n", "c", "u", ad) for s, ad in b] for b in [
        [(0, "1"), (5, "1"), (12, "2")], [(70, "1"), (75, "2")], [(200, "1")], [(200, "2")],
        [(201, "1"), (3, "1")]]]                              # the last click is late by the watermark of the batch before
    out = _out()
    run = lambda: streaming.run_window_trend(
        _clicks_stream(spark, _write_batches(batches)), out, "20 seconds", window="60 seconds", slide="10 seconds",
        bucket_ms=10_000, trigger=NOW, state_partitions=2)
    _done(run())
    mark = T0 + 201_000 - 20_000
    open_ends = {r.window_end_ms for r in streaming.read_open_windows(spark, out).collect()}
    assert open_ends and min(open_ends) > mark                # older windows are gone from the state
    final = spark.read.parquet(f"{out}/final")
    assert final.count() == final.distinct().count() and {r.window_end_ms <= mark for r in final.collect()} == {True}
    on_time = [r for b in batches for r in b][:-1]
    twin = ads.click_trend(ads.click_buckets(clicks_df(spark, on_time), 10_000), "60 seconds", "10 seconds", 6)
    cols = ["window_start_ms", "window_end_ms", "adid", "bucket_ms", "clicks"]
    assert _tuples(streaming.read_window_trend(spark, out).select(*cols)) == _tuples(twin.select(*cols))


def test_replayed_batch_changes_nothing(spark):
    # The driver dies after a batch wrote its output but before the commit log
    # recorded it: on restart Spark runs that batch again with the same id.
    batches = [[(T0 + i, "north", "bj", u, a) for i, (u, a) in enumerate(b)] for b in [
        [("u1", "x"), ("u1", "x"), ("u2", "x")],
        [("u1", "x"), ("u1", "y"), ("u2", "y")],
        [("u1", "y"), ("u2", "x"), ("u2", "x"), ("u2", "x")],
    ]]
    src, out = _write_batches(batches), _out()
    run = lambda: streaming.run_blacklist(_clicks_stream(spark, src), out, threshold=3,
                                          trigger=NOW, state_partitions=2)
    q = run()
    q.awaitTermination()
    first = (sorted(map(tuple, streaming.read_user_ad_counts(spark, out).collect())),
             sorted(map(tuple, streaming.read_block_batches(spark, out).collect())))
    last_commit = os.path.join(out, "_checkpoint", "commits", str(len(batches) - 1))
    assert os.path.exists(last_commit)
    for f in (last_commit, os.path.join(os.path.dirname(last_commit), f".{len(batches) - 1}.crc")):
        if os.path.exists(f):
            os.remove(f)
    q = run()
    q.awaitTermination()
    assert q.exception() is None
    assert q.lastProgress is not None and q.lastProgress["batchId"] == len(batches) - 1   # replayed
    again = (sorted(map(tuple, streaming.read_user_ad_counts(spark, out).collect())),
             sorted(map(tuple, streaming.read_block_batches(spark, out).collect())))
    assert again == first
    counts, blocked = model_loop([[(r[3], r[4]) for r in b] for b in batches], 3)
    assert dict(((u, a), n) for u, a, n in first[0]) == counts
    assert {u for u, _ in first[1]} == blocked


def test_rocksdb_state_store_gives_the_same_totals(spark):
    from shoplens.session import ROCKSDB_PROVIDER
    batches = [[(T0 + 1, "north", "bj", "u1", "1"), (T0 + 2, "north", "tj", "u1", "2")],
               [(T0 + 3, "north", "bj", "u2", "1")]]
    src, out = _write_batches(batches), _out()
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB_PROVIDER)          # read when the query starts
    try:
        q = streaming.run_daily_totals(_clicks_stream(spark, src), out, tz="UTC", trigger=NOW,
                                       state_partitions=2)
        q.awaitTermination()
        assert q.exception() is None
    finally:
        spark.conf.set(key, old)
    expected = ads.daily_area_city(clicks_df(spark, [r for b in batches for r in b]), "UTC")
    assert sorted(map(tuple, streaming.read_daily_totals(spark, out).collect())) == \
        sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_blacklist_stream_random_batches_match_loop(spark, seed):
    import random
    rnd = random.Random(seed)
    batches = [[(T0 + i, "a", "c", rnd.choice(["u1", "u2", "u3"]), rnd.choice(["x", "y"]))
                for i in range(rnd.randint(1, 8))] for _ in range(4)]
    out = _out()
    q = streaming.run_blacklist(_clicks_stream(spark, _write_batches(batches)), out, threshold=3,
                                trigger=NOW, state_partitions=2)
    q.awaitTermination()
    assert q.exception() is None
    counts, blocked = model_loop([[(r[3], r[4]) for r in b] for b in batches], 3)
    assert {(r.userid, r.adid): r.clicks for r in streaming.read_user_ad_counts(spark, out).collect()} == counts
    assert {r.userid for r in streaming.read_blacklist(spark, out).collect()} == blocked


def test_watermark_honours_the_time_zone(spark):
    click = [[(T0 + 20 * 3_600_000, "n", "bj", "u", "1")]]           # 20:00 UTC
    days = []
    for watermark in (None, "1 day"):
        out = _out()
        q = streaming.run_daily_totals(_clicks_stream(spark, _write_batches(click)), out, tz="Asia/Shanghai",
                                       watermark=watermark, trigger=NOW)
        q.awaitTermination()
        assert q.exception() is None
        days += [r.day for r in streaming.read_daily_totals(spark, out).collect()]
    assert days == ["2018-11-27", "2018-11-27"]


@pytest.mark.parametrize("every", [1, 2, 3, 100])
def test_full_batches_keep_every_result_of_the_loop(spark, every):
    """Users blocked early go on clicking for many batches."""
    import random
    rnd = random.Random(7)
    batches = [[(T0 + i, "a", "c", rnd.choice(["u1", "u2", "u3", "u4"]), rnd.choice(["x", "y"]))
                for i in range(rnd.randint(1, 4))] for _ in range(9)]
    out = _out()
    _done(streaming.run_blacklist(_clicks_stream(spark, _write_batches(batches)), out, threshold=4, trigger=NOW, full_every=every))
    counts, blocked = model_loop([[(r[3], r[4]) for r in b] for b in batches], 4)
    assert {(r.userid, r.adid): r.clicks for r in streaming.read_user_ad_counts(spark, out, every).collect()} == counts
    assert {r.userid for r in streaming.read_blacklist(spark, out).collect()} == blocked


def test_recent_buckets(spark):
    day = 86_400_000
    batches = [[(T0 + d * day + 1_000, "a", "c", "u", "1")] for d in range(3)]
    out = _out()
    _done(streaming.run_click_trend(_clicks_stream(spark, _write_batches(batches)), out, bucket_ms=10_000, trigger=NOW))
    recent = streaming.read_click_buckets(spark, out, since_ms=T0 + 2 * day)
    assert [r.bucket_ms for r in recent.collect()] == [T0 + 2 * day]


STREAMS_OVER_TABLES = ["stream_ads_daily_area_city", "stream_ads_daily_top3", "stream_ads_daily_top3_json",
                       "stream_blacklist_users", "stream_blacklist_counts", "stream_click_trend"]


def test_table_streams_read_folders_of_files(spark, tmp_path):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    for t in ("events", "customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").repartition(3).write.parquet(f"{tmp_path}/{t}.parquet")
    for name in STREAMS_OVER_TABLES:
        got, exp = (sorted(map(tuple, E.queries()[name](spark, d).collect())) for d in (str(tmp_path), SF_SMALL))
        assert got == exp and got, name
