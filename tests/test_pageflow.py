import pytest

from hypothesis import given, settings, strategies as st

from shoplens.operators import pageflow
from tests.conftest import action, actions_df

TIE = "action_seq"


def _rows(sessions):
    """sessions: {session_id: [page, ...]} in time order (one second apart)."""
    rows, seq = [], 0
    for sid, pages in sessions.items():
        for i, p in enumerate(pages):
            rows.append(action(session_id=sid, page_id=p,
                               action_time=f"2018-11-26 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}",
                               action_seq=seq))
            seq += 1
    return rows


def model_jumps(sessions, dedupe):
    """The original job literally: zip the sorted page list with its tail; with
    dedupe='last' the pairs go through a map keyed by from-page (last one wins)."""
    out = []
    for pages in sessions.values():
        pairs = list(zip(pages, pages[1:]))
        out += list(dict(pairs).items()) if dedupe == "last" else pairs
    return out


def model_rate(sessions, flow, dedupe):
    targets = set(zip(flow, flow[1:]))
    counts = {}
    for a, b in model_jumps(sessions, dedupe):
        if (a, b) in targets:
            counts[(a, b)] = counts.get((a, b), 0) + 1
    visits = {}
    for pages in sessions.values():
        for p in pages:
            if p in flow:
                visits[p] = visits.get(p, 0) + 1
    return {f"{a}-{b}": n / visits[a] * 100 for (a, b), n in counts.items()}


def _rate(spark, sessions, flow, dedupe, chunk="hour"):
    df = actions_df(spark, _rows(sessions))
    return {r.flow: r.rate for r in pageflow.jump_rate(df, flow, dedupe, chunk=chunk, tie=TIE).collect()}


def test_last_jump_per_page_and_filters(spark):
    # session_jumps: 1,2,1,3,1,2 -> from page 1 the last jump is 1-2; 2 jumps to 1 (not a target)
    sessions = {"s1": [1, 2, 1, 3, 1, 2], "s2": [1], "s3": [1, 9, 2, 3]}
    flow = (1, 2, 3)
    got = _rate(spark, sessions, flow, "last")
    assert got == model_rate(sessions, flow, "last")
    assert got == {"1-2": 1 / 5 * 100, "2-3": 1 / 3 * 100}     # s3: 1-9, 9-2 break 1-2
    assert _rate(spark, sessions, flow, "none") == model_rate(sessions, flow, "none")


def test_same_second_ordered_by_tie(spark):
    # session_same_second: two actions in one second, ordered by the tie column
    rows = [action(session_id="s", page_id=2, action_time="2018-11-26 10:00:00", action_seq=2),
            action(session_id="s", page_id=1, action_time="2018-11-26 10:00:00", action_seq=1),
            action(session_id="s", page_id=3, action_time="2018-11-26 10:00:01", action_seq=0)]
    df = actions_df(spark, rows)
    got = sorted((r.from_page, r.to_page) for r in pageflow.jumps(df, "none", tie=TIE).collect())
    assert got == [(1, 2), (2, 3)]


def test_whole_percent_truncates(spark):
    sessions = {"a": [1, 2], "b": [1, 3], "c": [1, 3]}
    df = actions_df(spark, _rows(sessions))
    got = {r.flow: r.rate for r in pageflow.jump_rate(df, (1, 2), "none", whole_percent=True,
                                                      tie=TIE).collect()}
    assert got == {"1-2": 33}


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d"]),
                       st.lists(st.integers(1, 5), min_size=1, max_size=30), min_size=1))
def test_rates_match_literal_model(spark, sessions):
    flow = (1, 2, 3, 4, 5)
    for dedupe in ("last", "none"):
        expected = model_rate(sessions, flow, dedupe)
        got = _rate(spark, sessions, flow, dedupe, chunk="minute")
        assert got.keys() == expected.keys()
        for k in got:
            assert abs(got[k] - expected[k]) < 1e-9


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=200))
def test_chunked_successor_equals_plain_lead(spark, pages):
    # One long session spread over many minute chunks (seconds advance by 1).
    df = actions_df(spark, _rows({"hot": pages}))
    plain = sorted(map(str, pageflow.page_successors(df, tie=TIE, chunk=None).drop("position").collect()))
    for chunk in ("minute", "hour", "day"):
        assert sorted(map(str, pageflow.page_successors(df, tie=TIE, chunk=chunk).drop("position").collect())) == plain


def test_null_times_sort_first_and_keep_their_successor(spark):
    rows = [action(session_id="s", page_id=1, action_time=None, action_seq=0),
            action(session_id="s", page_id=2, action_time="2018-11-26 10:00:00", action_seq=1),
            action(session_id="s", page_id=3, action_time="2018-11-26 12:00:00", action_seq=2)]
    df = actions_df(spark, rows)
    plain = sorted(map(str, pageflow.page_successors(df, tie=TIE, chunk=None).drop("position").collect()))
    chunked = sorted(map(str, pageflow.page_successors(df, tie=TIE, chunk="hour").drop("position").collect()))
    assert plain == chunked
    got = {r.page_id: r.next_page for r in pageflow.page_successors(df, tie=TIE, chunk="hour").collect()}
    assert got == {1: 2, 2: 3, 3: None}


@pytest.mark.parametrize("session", ["hot", None])
def test_hot_session_is_spread_over_partitions(spark, session):
    from pyspark.sql import functions as F
    from shoplens.sources import testviews
    from tests.conftest import SF_CHECK
    # a third of all actions moved into one session (rows derived from the test tables)
    acts = testviews.actions(spark, SF_CHECK)
    hot = acts.withColumn("session_id", F.when(F.col("action_seq") % 3 == 0, F.lit(session))
                          .otherwise(F.col("session_id")))
    total = hot.count()
    shares = {}
    # measure the shuffle's own distribution (AQE would merge this small input's partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for chunk in (None, "minute"):
            succ = pageflow.page_successors(hot, tie=TIE, chunk=chunk)
            # count next_page so the window itself is computed (not pruned away)
            per_part = (succ.where(F.col("session_id").eqNullSafe(F.lit(session)))
                        .select("next_page", F.spark_partition_id().alias("p"))
                        .groupBy("p").agg(F.count("*").alias("n"), F.count("next_page")).collect())
            shares[chunk] = max(r["n"] for r in per_part) / total
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shares[None] >= 0.33                     # the plain window: one task holds the hot session
    assert shares["minute"] < 0.33 / 2              # chunked: spread over the partitions
    plain = pageflow.jump_rate(hot, (1, 2, 3, 4, 5, 6, 7), "last", chunk=None, tie=TIE).collect()
    chunked = pageflow.jump_rate(hot, (1, 2, 3, 4, 5, 6, 7), "last", chunk="minute", tie=TIE).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, chunked))


def test_plain_action_schema_needs_no_tie_column(spark):
    sessions = {"a": [1, 2, 3], "b": [1, 2]}
    df = actions_df(spark, _rows(sessions)).drop("action_seq")      # exactly the ACTION schema
    got = {r.flow: r.rate for r in pageflow.jump_rate(df, (1, 2, 3), "last").collect()}
    assert got == model_rate(sessions, (1, 2, 3), "last")


def test_null_session_keeps_successors_across_minutes(spark):
    rows = [action(session_id=None, page_id=p, action_time=f"2018-11-26 10:{m:02d}:00", action_seq=i)
            for i, (p, m) in enumerate([(1, 0), (2, 5), (3, 9)])]
    rows.append(action(session_id="s", page_id=4, action_time="2018-11-26 10:01:00", action_seq=9))
    df = actions_df(spark, rows)
    plain = sorted(map(str, pageflow.page_successors(df, tie=TIE, chunk=None).drop("position").collect()))
    chunked = sorted(map(str, pageflow.page_successors(df, tie=TIE, chunk="minute").drop("position").collect()))
    assert plain == chunked


@pytest.mark.parametrize("dedupe", ["last", "none"])
def test_actions_of_one_second_give_one_result_for_any_partitioning(spark, dedupe):
    pages = [3, 1, 2, 2, 1, 4, 3, 5]
    rows = [action(session_id="s", page_id=p, action_time="2018-11-26 10:00:00", action_seq=i) for i, p in enumerate(pages)]
    df = actions_df(spark, rows).drop("action_seq")
    results = {tuple(sorted((r.flow, r.rate) for r in pageflow.jump_rate(df.repartition(n), (1, 2, 3, 4, 5), dedupe).collect()))
               for n in (1, 2, 3, 5)}
    assert results == {tuple(sorted(model_rate({"s": sorted(pages)}, (1, 2, 3, 4, 5), dedupe).items()))}


@pytest.mark.parametrize("bits", [2, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_ranged_successor_equals_plain_lead(spark, bits, seed, monkeypatch):
    """Null and repeated keys, equal rows, sessions that end at a block's or a range's end."""
    import random
    from shoplens.operators import successor
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.choice(["10:00", "10:00", "10:01", None]), rnd.randrange(3)) for _ in range(150)]
    df = spark.createDataFrame(rows + [("z", "09:00", 1)], "s string, t string, page int").repartition(5)
    plain = successor.with_successor(df, ["s"], ["t", "page"], "page", "nxt")
    ranged = successor.with_successor_ranged(df, ["s"], ["t", "page"], "page", "nxt", "position", block_bits=bits)
    assert sorted(map(str, map(tuple, ranged.drop("position").collect()))) == sorted(map(str, map(tuple, plain.collect())))
    key = lambda r: (r.s is not None, r.s or "", r.position)
    for a, b in zip(sorted(ranged.collect(), key=key), sorted(ranged.collect(), key=key)[1:]):
        if a.s == b.s:
            assert (a.t is not None, a.t or "", a.page) <= (b.t is not None, b.t or "", b.page) and a.nxt == b.page


def test_one_session_of_one_minute_is_spread_over_the_partitions(spark):
    from pyspark.sql import functions as F
    from shoplens.operators import successor
    n = 40_000
    rows = spark.range(n).select(F.lit(None).cast("string").alias("session_id"), F.lit("2024-01-01 00:00:07").alias("action_time"),
                                 F.lit(3).alias("page_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = successor.with_successor_ranged(rows, ["session_id"], ["action_time", "page_id"], "page_id", "nxt", "at", block_bits=10)
        sizes = {r["part"]: r["n"] for r in got.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).collect()}
        assert len(sizes) > 2 and max(sizes.values()) < n / 2           # ranges of equal rows
        assert got.where("nxt is null").count() == 1
        per_task = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("nxt").alias("n")).collect()
        assert len(per_task) > 2 and max(r["n"] for r in per_task) < n * 0.6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("dedupe", ["last", "none"])
def test_rates_by_ranges_equal_rates_by_minutes(spark, dedupe):
    from shoplens.sources import testviews
    from tests.conftest import SF_SMALL
    acts = testviews.actions(spark, SF_SMALL)
    flow = (1, 2, 3, 4, 5, 6, 7)
    minute = pageflow.jump_rate(acts, flow, dedupe, tie=TIE).collect()
    ranges = pageflow.jump_rate(acts, flow, dedupe, tie=TIE, chunk=pageflow.RANGES).collect()
    assert sorted(map(tuple, minute)) == sorted(map(tuple, ranges)) and minute
