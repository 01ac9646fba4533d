"""Explicit schemas of the inputs and of what the streaming jobs log."""

from pyspark.sql import types as T

# One row per user action on the shop site (search, click, order or payment).
ACTION = T.StructType([
    T.StructField("date", T.StringType()),                 # yyyy-MM-dd
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),          # yyyy-MM-dd HH:mm:ss
    T.StructField("search_keyword", T.StringType()),       # set only for a search
    T.StructField("click_category_id", T.LongType()),      # -1 when not a click
    T.StructField("click_product_id", T.LongType()),       # -1 when not a click
    T.StructField("order_category_ids", T.StringType()),   # comma-joined, null when not an order
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),     # comma-joined, null when not a payment
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

# One ad click, parsed from the line "timestamp area city userid adid".
AD_CLICK = T.StructType([
    T.StructField("ts_ms", T.LongType()),      # epoch milliseconds
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.StringType()),
    T.StructField("adid", T.StringType()),
])

CLICK_LINE = T.StructType([T.StructField("value", T.StringType())])

DAILY_TOTALS = T.StructType([
    T.StructField("day", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("adid", T.StringType()),
    T.StructField("clicks", T.LongType()),
])

AD_BUCKETS = T.StructType([
    T.StructField("adid", T.StringType()),
    T.StructField("bucket_ms", T.LongType()),
    T.StructField("clicks", T.LongType()),
])

# Totals and rankings per (day, area), as kept up to date by the streaming job.
AREA_TOTALS = T.StructType([
    T.StructField("day", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("adid", T.StringType()),
    T.StructField("clicks", T.LongType()),
])

DAILY_TOP = T.StructType([
    T.StructField("day", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("adid", T.StringType()),
    T.StructField("clicks", T.LongType()),
])

# What the blacklist loop keeps.
USER_AD_COUNTS = T.StructType([
    T.StructField("userid", T.StringType()),
    T.StructField("adid", T.StringType()),
    T.StructField("clicks", T.LongType()),
])

BLOCKED_USERS = T.StructType([T.StructField("userid", T.StringType())])
