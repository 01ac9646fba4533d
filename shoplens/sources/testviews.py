"""Adapters from the driver's test tables (``events``, ``customer``, ``nation``,
``region``) to the action log and the ad-click feed.

Fixed mapping (the DuckDB oracle SQL in ``shoplens.plans.oracle`` spells out the
same expressions; k is the integer member ``k`` of ``events.props``):

* session = user and ISO week (``<user_id>-<monday yyyy-MM-dd>``)
* page = k % 10 + 1; ``view`` is a search with keyword ``kw<k % 10>``
* ``click`` -> category k % 20 + 1, product k % 100 + 1 (else -1)
* ``purchase`` -> order categories ``"k%20+1,(k*7)%20+1"``, products ``"k%100+1,(k*7)%100+1"``
* ``signup`` -> pay categories ``"k%20+1,(k*3)%20+1"``, products ``"k%100+1,(k*3)%100+1"``
* city = user_id % 26 + 1; ``action_seq`` = event_id (tie-break inside a second)
* ad clicks: ``click`` events; city = nation name, area = region name with spaces
  replaced by ``_`` (the line format is space-separated), userid = user_id, adid = k % 6 + 1
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.functions.time import epoch_ms_of_ntz

TIE = "action_seq"


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


def _pair(a, b):
    return F.concat_ws(",", a.cast("string"), b.cast("string"))


def actions_from_events(events: DataFrame) -> DataFrame:
    k = F.col("_k")
    et = F.col("event_type")
    ts = F.col("ts")
    return (events.select("event_id", "ts", "user_id", "event_type", _k().alias("_k"))
            .select(
                F.date_format(ts, "yyyy-MM-dd").alias("date"),
                F.col("user_id"),
                F.concat_ws("-", F.col("user_id").cast("string"),
                            F.date_format(F.date_trunc("week", ts), "yyyy-MM-dd")).alias("session_id"),
                (k % 10 + 1).alias("page_id"),
                F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("action_time"),
                F.when(et == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
                F.when(et == "click", k % 20 + 1).otherwise(F.lit(-1).cast("bigint")).alias("click_category_id"),
                F.when(et == "click", k % 100 + 1).otherwise(F.lit(-1).cast("bigint")).alias("click_product_id"),
                F.when(et == "purchase", _pair(k % 20 + 1, (k * 7) % 20 + 1)).alias("order_category_ids"),
                F.when(et == "purchase", _pair(k % 100 + 1, (k * 7) % 100 + 1)).alias("order_product_ids"),
                F.when(et == "signup", _pair(k % 20 + 1, (k * 3) % 20 + 1)).alias("pay_category_ids"),
                F.when(et == "signup", _pair(k % 100 + 1, (k * 3) % 100 + 1)).alias("pay_product_ids"),
                (F.col("user_id") % 26 + 1).alias("city_id"),
                F.col("event_id").alias(TIE),
            ))


def customer_geo(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """customer -> (c_custkey, city, area). nation and region are tiny fixed
    dimensions; Spark broadcasts them from their measured file size."""
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", F.col("n_name").alias("city"),
                   F.regexp_replace("r_name", " ", "_").alias("area")))
    return (customer.select("c_custkey", "c_nationkey")
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "city", "area"))


def ad_clicks_from_events(events: DataFrame, customer: DataFrame, nation: DataFrame,
                          region: DataFrame) -> DataFrame:
    """(ts_ms, area, city, userid, adid, event_id) for every click event."""
    clicks = (events.where(F.col("event_type") == "click")
              .select("event_id", "ts", "user_id", _k().alias("_k")))
    geo = customer_geo(customer, nation, region)
    return (clicks.join(geo, clicks.user_id == geo.c_custkey)
            .select(epoch_ms_of_ntz("ts").alias("ts_ms"), "area", "city",
                    F.col("user_id").cast("string").alias("userid"),
                    (F.col("_k") % 6 + 1).cast("string").alias("adid"),
                    "event_id"))


def load_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def in_ts_range(events: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Events whose action time, as text, lies between ``start`` and ``end``, said of the
    time column itself, so that the scan can skip. Bounds are ``yyyy-MM-dd`` or
    ``yyyy-MM-dd HH:mm:ss``; as text, a bare day as ``end`` comes before its first second."""
    if start:
        events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        stop = datetime.fromisoformat(end) + timedelta(seconds=1 if len(end) > 10 else 0)
        events = events.where(F.col("ts") < F.lit(str(stop)).cast("timestamp_ntz"))
    return events


def actions(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    (events,) = load_tables(spark, sf_dir, "events")
    return actions_from_events(in_ts_range(events, start, end))


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks_from_events(*load_tables(spark, sf_dir, "events", "customer", "nation", "region"))
