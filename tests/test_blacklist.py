import pytest

from hypothesis import given, settings, strategies as st

from shoplens.operators import blacklist
from tests.conftest import clicks_df


def model_loop(batches, threshold):
    """The original micro-batch loop: read the blacklist at batch start, drop its
    users, increment (user, ad) counts per click, block at >= threshold."""
    counts, blocked = {}, set()
    for batch in batches:
        start_blocked = set(blocked)
        for user, ad in batch:
            if user in start_blocked:
                continue
            counts[(user, ad)] = counts.get((user, ad), 0) + 1
            if counts[(user, ad)] >= threshold:
                blocked.add(user)
    return counts, blocked


def _df(spark, batches):
    rows = []
    for b, batch in enumerate(batches):
        for i, (user, ad) in enumerate(batch):
            rows.append((b * 5000 + i, "a", "c", user, ad))
    return blacklist.with_batches(clicks_df(spark, rows), 5000)


def test_threshold_crossed_mid_batch(spark):
    # clicks_threshold: u1 reaches 3 on ad x mid-batch, clicks ad y later in that
    # batch (counted) and again in the next batch (dropped)
    batches = [[("u1", "x"), ("u1", "x"), ("u1", "x"), ("u1", "y"), ("u2", "x")],
               [("u1", "y"), ("u1", "x"), ("u2", "x")]]
    df = _df(spark, batches)
    got = {(r.userid, r.adid): r.clicks for r in blacklist.accepted_counts(df, 3).collect()}
    counts, blocked = model_loop(batches, 3)
    assert got == counts == {("u1", "x"): 3, ("u1", "y"): 1, ("u2", "x"): 2}
    assert {r.userid for r in blacklist.blocked_users(df, 3).collect()} == blocked == {"u1"}
    kept = blacklist.drop_blocked(df, blacklist.blocked_users(df, 3))
    assert {r.userid for r in kept.collect()} == {"u2"}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["a", "b"])),
                         max_size=12), min_size=1, max_size=6),
       st.integers(2, 4))
def test_closed_form_matches_loop(spark, batches, threshold):
    df = _df(spark, batches)
    counts, blocked = model_loop(batches, threshold)
    got = {(r.userid, r.adid): r.clicks for r in blacklist.accepted_counts(df, threshold).collect()}
    assert got == counts
    assert {r.userid for r in blacklist.blocked_users(df, threshold).collect()} == blocked


def test_a_hot_user_is_spread_over_partitions(spark):
    """A third of the clicks are one user's, over many ads and batches."""
    from pyspark.sql import functions as F
    hot = spark.range(3000).select(
        F.col("id").alias("ts_ms"), F.lit("a").alias("area"), F.lit("c").alias("city"),
        F.when(F.col("id") % 3 == 0, F.lit("bot")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("userid"),
        (F.col("id") % 101).cast("string").alias("adid"), (F.col("id") / 300).cast("bigint").alias("batch"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per = blacklist._per_batch(hot, "batch")
        w = blacklist._crossings(per, 5, "batch")
        plan = w._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(userid" in plan and "Window" in plan
        window = plan[plan.index("Window ["):]
        assert window[window.index("hashpartitioning("):].startswith("hashpartitioning(userid#") and ", adid#" in window[
            window.index("hashpartitioning("):][:60]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.userid for r in blacklist.block_batches(hot, 5).collect()] == ["bot"]


@pytest.mark.parametrize("bits", [15, 16, 22])
def test_prefiltered_anti_join_equals_the_plain_one(spark, bits):
    import random
    rnd = random.Random(bits)
    clicks = clicks_df(spark, [(i, "a", "c", rnd.choice([None, f"u{rnd.randrange(3000)}"]), "1") for i in range(4000)])
    for users in ([f"u{i}" for i in range(0, 3000, 7)], [], [None, "u1"], [f"u{i}" for i in range(3000)]):
        black = spark.createDataFrame([(u,) for u in users], "userid string")
        plain, quick = (sorted(map(str, map(tuple, f(clicks, black).select(*clicks.columns).collect()))) for f in (
            blacklist.drop_blocked, lambda c, b: blacklist.drop_blocked_prefiltered(c, b, bits)))
        assert plain == quick


def test_few_clicks_reach_the_anti_join(spark):
    """Only rows whose user is set in the bitmap are shuffled."""
    clicks = clicks_df(spark, [(i, "a", "c", f"u{i}", "1") for i in range(5000)])
    black = spark.createDataFrame([(f"u{i}",) for i in range(0, 5000, 100)], "userid string")
    out = blacklist.drop_blocked_prefiltered(clicks, black)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert out.count() == 4950
        plan = out._jdf.queryExecution().executedPlan()
        out.collect()
        rows, text = [], []

        def walk(node):
            name = node.nodeName()
            text.append(name)
            if name.startswith("AdaptiveSparkPlan"):
                walk(node.executedPlan())
            elif name.endswith("QueryStage"):
                walk(node.plan())
            elif name == "Exchange":
                rows.append(node.metrics().apply("shuffleRecordsWritten").value())
            for i in range(node.children().size()):
                walk(node.children().apply(i))
        walk(plan)
        assert rows and max(rows) < 500, text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
