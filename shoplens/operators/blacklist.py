"""Click-threshold blacklist.

A user is blocked once any (user, ad) click count reaches ``threshold``; from
then on all clicks of that user are dropped before counting. Two facts give a
closed form at micro-batch grain, so no per-row state is needed:

* blocking never depends on the filter: a user's clicks are dropped only after
  the user is blocked, so the blacklist equals "users with some (user, ad) total
  >= threshold" over the unfiltered clicks;
* the filter is applied at batch start, so the batch in which a (user, ad)
  running count first reaches the threshold is counted in full, and every later
  batch of that user is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shoplens.defaults import BLACKLIST_THRESHOLD
from shoplens.functions.time import bucket_index

BITMAP_BITS = 22


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """(userid, adid, clicks)."""
    return clicks.groupBy("userid", "adid").agg(F.count("*").alias("clicks"))


def blocked_users(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """(userid) of users with at least one (user, ad) count >= ``threshold``."""
    return (user_ad_counts(clicks).where(F.col("clicks") >= threshold)
            .select("userid").distinct())


def drop_blocked(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not on the blacklist. The blacklist can grow with the
    user base, so no broadcast is forced; AQE broadcasts it when its measured
    size is small and keeps a shuffle join otherwise."""
    return clicks.join(blacklist.select("userid"), "userid", "left_anti")


def drop_blocked_prefiltered(clicks: DataFrame, blacklist: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """``drop_blocked`` for a blacklist of any size, where few clicks are of blocked users:
    only the clicks whose hashed user is set in a bitmap of the blocked ones are shuffled
    to the anti join, all others pass as they are. Exact: a user that isn't set isn't
    blocked, and the anti join decides the rest.

    The bitmap has 2^``bits`` bits (512 KB by default, whatever the blacklist's size),
    made of partial ones per task; it goes to the tasks with the plan. The clicks are read
    twice (once for each side), which costs less than shuffling them where they are files.
    """
    place = lambda user: F.pmod(F.xxhash64(user), F.lit(1 << bits))
    per_row = 1 << 15  # bits of one row of Spark's bitmap aggregate
    at = F.bitmap_bit_position(place("userid")), F.bitmap_bucket_number(place("userid"))
    rows = (blacklist.where("userid is not null").select(at[0].alias("bit"), at[1].alias("bucket"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect())  # 2^bits / per_row rows
    maps = {r["bucket"]: bytes(r["bitmap"]) for r in rows}
    whole = b"".join(maps.get(b, bytes(per_row // 8)) for b in range(0, (1 << bits) // per_row + 2))
    byte = at[1] * (per_row // 8) + F.shiftright(at[0], 3) + 1  # of the user's bit, from 1
    value = F.conv(F.hex(F.substring(F.lit(whole), byte.cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.bit_get(value, (at[0] % 8).cast("int")) == 1, F.lit(False))
    marked = clicks.withColumn("_hit", hit)
    passed = marked.where(~F.col("_hit")).drop("_hit")
    return passed.unionByName(drop_blocked(marked.where("_hit").drop("_hit"), blacklist).select(*clicks.columns))


def with_batches(clicks: DataFrame, batch_ms: int = 5_000, col: str = "batch") -> DataFrame:
    """Assign each click to the micro-batch of its time (``ts_ms div batch_ms``)."""
    return clicks.withColumn(col, bucket_index("ts_ms", batch_ms))


def _per_batch(clicks: DataFrame, batch_col: str) -> DataFrame:
    return clicks.groupBy("userid", "adid", batch_col).agg(F.count("*").alias("n"))


def _crossings(per: DataFrame, threshold: int, batch_col: str) -> DataFrame:
    """(userid, block_batch) from clicks per (user, ad, batch).

    The running count is taken per (user, ad), so a hot user is spread over the ads
    they click; each pair gives its first crossing, and the least one per user is a
    partial aggregate.
    """
    pair = (Window.partitionBy("userid", "adid").orderBy(batch_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (per.withColumn("_total", F.sum("n").over(pair)).where(F.col("_total") >= threshold)
            .groupBy("userid").agg(F.min(batch_col).alias("block_batch")))


def block_batches(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                  batch_col: str = "batch") -> DataFrame:
    """(userid, block_batch): the first batch at whose end some (user, ad)
    running count reaches ``threshold``."""
    return _crossings(_per_batch(clicks, batch_col), threshold, batch_col)


def accepted_counts(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                    batch_col: str = "batch") -> DataFrame:
    """(userid, adid, clicks) as counted by the micro-batch loop: clicks in
    batches up to and including the user's blocking batch. Clicks are aggregated per
    (user, ad, batch) before they meet the blocking batches."""
    per = _per_batch(clicks, batch_col)
    rows = per.join(_crossings(per, threshold, batch_col), "userid", "left")
    kept = rows.where(F.col("block_batch").isNull() | (F.col(batch_col) <= F.col("block_batch")))
    return kept.groupBy("userid", "adid").agg(F.sum("n").alias("clicks"))
