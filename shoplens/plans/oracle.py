"""DuckDB SQL for every registered query, over the driver's test tables.

The two CTEs below restate the adapters of ``shoplens.sources.testviews`` in SQL;
each query appends its own CTEs and final SELECT. Doubles are rounded to 6
places on both sides; column names match the Spark queries exactly.
"""

ACTIONS_CTE = """
ev AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
actions AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(date_trunc('week', ts), '%Y-%m-%d') AS session_id,
         k % 10 + 1 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k % 100 + 1 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k * 7) % 20 + 1 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 100 + 1 AS VARCHAR) || ',' || CAST((k * 7) % 100 + 1 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k * 3) % 20 + 1 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k % 100 + 1 AS VARCHAR) || ',' || CAST((k * 3) % 100 + 1 AS VARCHAR) END AS pay_product_ids,
         user_id % 26 + 1 AS city_id,
         event_id AS action_seq
  FROM ev)"""

CLICKS_CTE = """
ev AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
clicks AS (
  SELECT epoch_us(e.ts) // 1000 AS ts_ms,
         replace(r.r_name, ' ', '_') AS area,
         n.n_name AS city,
         CAST(e.user_id AS VARCHAR) AS userid,
         CAST(e.k % 6 + 1 AS VARCHAR) AS adid,
         e.event_id
  FROM ev e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE e.event_type = 'click')"""


def with_actions(body: str) -> str:
    return "WITH " + ACTIONS_CTE + body


def with_clicks(body: str) -> str:
    return "WITH " + CLICKS_CTE + body


CATEGORY_EXPANDED = """,
cat AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS action
  FROM actions WHERE click_category_id IS NOT NULL AND click_category_id <> -1
  UNION ALL
  SELECT unnest(string_split(order_category_ids, ',')) AS category_id, 'order' AS action
  FROM actions WHERE coalesce(click_category_id, -1) = -1 AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT unnest(string_split(pay_category_ids, ',')) AS category_id, 'pay' AS action
  FROM actions WHERE coalesce(click_category_id, -1) = -1 AND order_category_ids IS NULL
    AND pay_category_ids IS NOT NULL),
counts AS (
  SELECT category_id,
         count(*) FILTER (WHERE action = 'click') AS click_count,
         count(*) FILTER (WHERE action = 'order') AS order_count,
         count(*) FILTER (WHERE action = 'pay') AS pay_count
  FROM cat GROUP BY category_id),
top AS (
  SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC LIMIT 10)"""

SQL: dict[str, str] = {}

SQL["actions_date_range"] = with_actions("""
SELECT * FROM actions
WHERE action_time >= '2024-01-08 00:00:00' AND action_time <= '2024-01-21'""")

SQL["actions_preview"] = with_actions("""
SELECT * FROM actions ORDER BY action_seq LIMIT 100""")

SQL["category_action_counts"] = with_actions(CATEGORY_EXPANDED + """
SELECT * FROM counts""")

SQL["category_counts_sparse_lists"] = with_actions(""",
clicked AS (SELECT click_product_id % 4 AS k FROM actions WHERE click_category_id <> -1),
ids AS (
  SELECT k, unnest(CASE k WHEN 0 THEN ['1', '', '2'] WHEN 1 THEN ['', '3'] WHEN 2 THEN CAST([] AS VARCHAR[]) ELSE [''] END) AS category_id
  FROM clicked)
SELECT category_id, CAST(0 AS BIGINT) AS click_count, count(*) AS order_count, CAST(0 AS BIGINT) AS pay_count
FROM ids GROUP BY category_id""")

SQL["job_category_top10"] = ("WITH all_" + ACTIONS_CTE.strip().replace("actions AS (", "all_actions AS (", 1) + """,
actions AS (SELECT * FROM all_actions WHERE action_time >= '2024-01-08 00:00:00')""" + CATEGORY_EXPANDED + """
SELECT 'task-0' AS taskid, top.* FROM top""").replace("WITH all_ev", "WITH ev")

SQL["category_top10"] = with_actions(CATEGORY_EXPANDED + """
SELECT * FROM top""")

SQL["table_round_trip"] = SQL["category_top10"]
SQL["table_versions"] = SQL["category_top10"]

SQL["category_session_top10"] = with_actions(CATEGORY_EXPANDED + """,
sc AS (
  SELECT CAST(a.click_category_id AS VARCHAR) AS category_id, a.session_id, count(*) AS click_count
  FROM actions a
  WHERE a.click_category_id <> -1
    AND CAST(a.click_category_id AS VARCHAR) IN (SELECT category_id FROM top)
  GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id ASC) AS rn
  FROM sc)
SELECT category_id, session_id, click_count FROM ranked WHERE rn <= 10""")

# ---- page flow (target flow 1,2,3,4,5,6,7) ---------------------------------
FLOW = (1, 2, 3, 4, 5, 6, 7)
_FLOW_PAGES = ", ".join(str(p) for p in FLOW)
_FLOW_LABELS = ", ".join(f"'{a}-{b}'" for a, b in zip(FLOW, FLOW[1:]))

_SUCC = """,
succ AS (
  SELECT session_id, page_id, action_time, action_seq,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_seq) AS next_page
  FROM actions)"""

_JUMPS_ALL = _SUCC + """,
j AS (SELECT page_id AS from_page, next_page AS to_page FROM succ WHERE next_page IS NOT NULL)"""

_JUMPS_LAST = _SUCC + """,
lastj AS (
  SELECT page_id AS from_page, next_page AS to_page,
         row_number() OVER (PARTITION BY session_id, page_id
                            ORDER BY action_time DESC, action_seq DESC) AS rn
  FROM succ WHERE next_page IS NOT NULL),
j AS (SELECT from_page, to_page FROM lastj WHERE rn = 1)"""

_COUNTS = """,
c AS (
  SELECT CAST(from_page AS VARCHAR) || '-' || CAST(to_page AS VARCHAR) AS flow, from_page, to_page,
         count(*) AS jumps
  FROM j
  WHERE CAST(from_page AS VARCHAR) || '-' || CAST(to_page AS VARCHAR) IN (%s)
  GROUP BY 1, 2, 3),
v AS (SELECT page_id, count(*) AS visits FROM actions WHERE page_id IN (%s) GROUP BY page_id)""" % (
    _FLOW_LABELS, _FLOW_PAGES)

SQL["page_visits"] = with_actions(""",
v AS (SELECT page_id, count(*) AS visits FROM actions WHERE page_id IN (%s) GROUP BY page_id)
SELECT * FROM v""" % _FLOW_PAGES)

SQL["page_jump_counts"] = with_actions(_JUMPS_ALL + _COUNTS + """
SELECT flow, from_page, to_page, jumps FROM c""")

SQL["page_jump_counts_all_targets"] = with_actions(_JUMPS_ALL + _COUNTS + """,
t AS (SELECT * FROM (VALUES %s) t(from_page, to_page))
SELECT CAST(t.from_page AS BIGINT) AS from_page, CAST(t.to_page AS BIGINT) AS to_page, coalesce(c.jumps, 0) AS jumps
FROM t LEFT JOIN c ON t.from_page = c.from_page AND t.to_page = c.to_page""" % ", ".join(
    str(x) for x in [*zip(FLOW, FLOW[1:]), (7, 1), (1, 99)]))

SQL["page_jump_counts_last"] = with_actions(_JUMPS_LAST + _COUNTS + """
SELECT flow, from_page, to_page, jumps FROM c""")

SQL["page_jump_rate"] = with_actions(_JUMPS_LAST + _COUNTS + """
SELECT flow, round(CAST(jumps AS DOUBLE) / visits * 100, 6) AS rate
FROM c JOIN v ON c.from_page = v.page_id""")

SQL["page_jump_rate_ranges"] = SQL["page_jump_rate"]

SQL["page_jump_counts_one_session"] = with_actions(""",
j AS (
  SELECT page_id AS from_page, lead(page_id) OVER (ORDER BY right(action_time, 2), action_seq) AS to_page FROM actions)""" + _COUNTS + """
SELECT flow, from_page, to_page, jumps FROM c""")

SQL["page_jump_rate_all"] = with_actions(_JUMPS_ALL + _COUNTS + """
SELECT flow, round(CAST(jumps AS DOUBLE) / visits * 100, 6) AS rate
FROM c JOIN v ON c.from_page = v.page_id""")

SQL["page_jump_rate_whole"] = with_actions(_JUMPS_ALL + _COUNTS + """
SELECT flow, CAST(trunc(CAST(jumps AS DOUBLE) / visits * 100) AS BIGINT) AS rate
FROM c JOIN v ON c.from_page = v.page_id""")

# Sessions cut to whole hours: of one hour the pages come in order.
_HOURLY = """,
succ AS (
  SELECT session_id, page_id, left(action_time, 13) AS hour,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY left(action_time, 13), page_id) AS next_page,
         row_number() OVER (PARTITION BY session_id ORDER BY left(action_time, 13), page_id) AS pos
  FROM actions),
lastj AS (
  SELECT page_id AS from_page, next_page AS to_page,
         row_number() OVER (PARTITION BY session_id, page_id ORDER BY pos DESC) AS rn
  FROM succ WHERE next_page IS NOT NULL),
j AS (SELECT from_page, to_page FROM lastj WHERE rn = 1)"""

SQL["page_jump_rate_no_tie"] = with_actions(_HOURLY + _COUNTS + """
SELECT flow, round(CAST(jumps AS DOUBLE) / visits * 100, 6) AS rate
FROM c JOIN v ON c.from_page = v.page_id""")

# ---- ad clicks (UTC days, 1 h buckets, 6 h windows sliding by 1 h, keep 6) ----------
_DAY = "strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d')"

_DAILY = """,
daily AS (SELECT """ + _DAY + """ AS day, area, city, adid, count(*) AS clicks
          FROM clicks GROUP BY 1, 2, 3, 4)"""

_TOP3 = _DAILY + """,
area_totals AS (SELECT day, area, adid, CAST(sum(clicks) AS BIGINT) AS clicks FROM daily GROUP BY 1, 2, 3),
ranked AS (SELECT day, area,
                  CAST(row_number() OVER (PARTITION BY day, area ORDER BY clicks DESC, adid ASC) AS INTEGER) AS rank,
                  adid, clicks FROM area_totals),
top3 AS (SELECT * FROM ranked WHERE rank <= 3)"""

_BUCKETS = """,
buckets AS (SELECT adid, (ts_ms // 3600000) * 3600000 AS bucket_ms, count(*) AS clicks
            FROM clicks GROUP BY 1, 2)"""

_TREND = _BUCKETS + """,
wins AS (
  SELECT (b.bucket_ms // 3600000) * 3600000 - r.i * 3600000 AS window_start_ms,
         (b.bucket_ms // 3600000) * 3600000 - r.i * 3600000 + 21600000 AS window_end_ms,
         b.adid, b.bucket_ms, b.clicks
  FROM buckets b CROSS JOIN range(0, 6) r(i)),
trend AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end_ms, adid ORDER BY bucket_ms) AS rn FROM wins)
  WHERE rn <= 6)"""

SQL["ad_click_parse"] = with_clicks("""
SELECT ts_ms, area, city, userid, adid FROM clicks""")

SQL["ad_click_rejects"] = with_clicks("""
SELECT CASE event_id % 4 WHEN 1 THEN 'too few fields' WHEN 3 THEN 'bad time' ELSE 'good' END AS reason, count(*) AS lines
FROM clicks GROUP BY 1""")

SQL["ad_click_rejects_observed"] = SQL["ad_click_rejects"]
SQL["stream_rejects_observed"] = SQL["ad_click_rejects"]

SQL["ads_daily_area_city"] = with_clicks(_DAILY + """
SELECT * FROM daily""")

SQL["ads_daily_top3"] = with_clicks(_TOP3 + """
SELECT * FROM top3""")

SQL["ads_daily_top3_json"] = with_clicks(_TOP3 + """
SELECT day, area, '{' || string_agg('"' || adid || '":' || CAST(clicks AS VARCHAR), ',' ORDER BY rank) || '}' AS top_json
FROM top3 GROUP BY day, area""")

SQL["ad_click_buckets"] = with_clicks(_BUCKETS + """
SELECT * FROM buckets""")

SQL["ad_click_trend"] = with_clicks(_TREND + """
SELECT window_start_ms, window_end_ms, adid, bucket_ms, clicks FROM trend""")

SQL["ad_click_trend_json"] = with_clicks(_TREND + """
SELECT window_end_ms, adid,
       '[' || string_agg('{"' || strftime(make_timestamp(bucket_ms * 1000), '%H:%M') || '":' || CAST(clicks AS VARCHAR) || '}',
                         ',' ORDER BY bucket_ms) || ']' AS trend_json
FROM trend GROUP BY window_end_ms, adid""")

SQL["ad_click_trend_keep3"] = with_clicks(_TREND + """
SELECT window_end_ms, adid,
       '[' || string_agg('{"' || strftime(make_timestamp(bucket_ms * 1000), '%M:%S') || '":' || CAST(clicks AS VARCHAR) || '}',
                         ',' ORDER BY bucket_ms) || ']' AS trend_json
FROM trend WHERE rn <= 3 GROUP BY window_end_ms, adid""")

SQL["ad_click_trend_latest"] = with_clicks(_TREND + """,
docs AS (
  SELECT window_end_ms, adid,
         '[' || string_agg('{"' || strftime(make_timestamp(bucket_ms * 1000), '%H:%M') || '":' || CAST(clicks AS VARCHAR) || '}',
                           ',' ORDER BY bucket_ms) || ']' AS trend_json
  FROM trend GROUP BY window_end_ms, adid)
SELECT adid, window_end_ms, trend_json FROM (
  SELECT *, row_number() OVER (PARTITION BY adid ORDER BY window_end_ms DESC) AS rn FROM docs)
WHERE rn = 1""")

# ---- blacklist (threshold 5, 6-hour micro-batches) ----------------------------------
_BLOCKED = """,
uac AS (SELECT userid, adid, count(*) AS clicks FROM clicks GROUP BY 1, 2),
blocked AS (SELECT DISTINCT userid FROM uac WHERE clicks >= 5)"""

_PER_BATCH = """,
per AS (SELECT userid, adid, ts_ms // BATCH_MS AS batch, count(*) AS n FROM clicks GROUP BY 1, 2, 3),
cum AS (SELECT *, sum(n) OVER (PARTITION BY userid, adid ORDER BY batch
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM per),
blk AS (SELECT userid, min(batch) AS block_batch FROM cum WHERE c >= 5 GROUP BY userid)"""

SQL["blacklist_users"] = with_clicks(_BLOCKED + """
SELECT userid FROM blocked""")

SQL["blacklist_user_ad_counts"] = with_clicks(_BLOCKED + """
SELECT userid, adid, clicks FROM uac""")

SQL["blacklist_filtered_clicks"] = with_clicks(_BLOCKED + """
SELECT * FROM clicks WHERE userid NOT IN (SELECT userid FROM blocked)""")

SQL["blacklist_filtered_prefiltered"] = SQL["blacklist_filtered_clicks"]

_BLOCK_BATCHES = _PER_BATCH + """
SELECT userid, block_batch FROM blk"""

_ACCEPTED = _PER_BATCH + """
SELECT p.userid, p.adid, CAST(sum(p.n) AS BIGINT) AS clicks
FROM per p LEFT JOIN blk b ON p.userid = b.userid
WHERE b.block_batch IS NULL OR p.batch <= b.block_batch
GROUP BY 1, 2"""

for _name, _ms in (("", 6 * 3_600_000), ("stream_", 5 * 86_400_000)):
    SQL[_name + "blacklist_block_batches"] = with_clicks(_BLOCK_BATCHES.replace("BATCH_MS", str(_ms)))
    SQL[_name + "blacklist_accepted_counts"] = with_clicks(_ACCEPTED.replace("BATCH_MS", str(_ms)))

_DAYS5 = str(5 * 86_400_000)

SQL["stream_accepted_clicks"] = with_clicks(_PER_BATCH.replace("BATCH_MS", _DAYS5) + """
SELECT ts_ms, area, city, clicks.userid, adid, ts_ms // """ + _DAYS5 + """ AS slice
FROM clicks LEFT JOIN blk ON clicks.userid = blk.userid
WHERE blk.block_batch IS NULL OR ts_ms // """ + _DAYS5 + """ <= blk.block_batch""")

# A click is late if its day had ended by the watermark of the slices published before
# its own: three days before the newest click in them. A day is final once it has ended
# by the watermark of all slices.
_ON_TIME = """,
published AS (
  SELECT *, ts_ms // """ + _DAYS5 + """ + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS slice,
         (ts_ms // 86400000 + 1) * 86400000 AS day_end
  FROM clicks),
newest AS (SELECT slice, max(ts_ms) AS ts FROM published GROUP BY slice),
marks AS (
  SELECT slice, max(ts) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 259200000 AS mark FROM newest),
on_time AS (
  SELECT p.* FROM published p JOIN marks m ON p.slice = m.slice WHERE m.mark IS NULL OR p.day_end > m.mark)"""

SQL["stream_daily_final"] = with_clicks(_ON_TIME + """
SELECT """ + _DAY + """ AS day, area, city, adid, count(*) AS clicks FROM on_time
WHERE day_end <= (SELECT max(ts) - 259200000 FROM newest) GROUP BY 1, 2, 3, 4""")

SQL["stream_daily_watermarked"] = with_clicks(_ON_TIME + """
SELECT """ + _DAY + """ AS day, area, city, adid, count(*) AS clicks FROM on_time GROUP BY 1, 2, 3, 4""")

# ---- streaming twins: each equals its batch query (where the whole table arrives in
# one micro-batch, no user of the blacklist is blocked before it).
SQL["stream_daily_snapshot"] = SQL["ads_daily_area_city"]
SQL["stream_top3_kept"] = SQL["ads_daily_top3"]
SQL["stream_top3_kept_json"] = SQL["ads_daily_top3_json"]
SQL["stream_window_trend"] = SQL["ad_click_trend"]
SQL["stream_trigger_daily"] = SQL["ads_daily_area_city"]
SQL["stream_restart_daily"] = SQL["ads_daily_area_city"]
SQL["stream_click_trend_latest"] = SQL["ad_click_trend_latest"]
SQL["stream_ads_daily_area_city"] = SQL["ads_daily_area_city"]
SQL["stream_lines_ads_daily_area_city"] = SQL["ads_daily_area_city"]
SQL["stream_lines_blacklist_users"] = SQL["blacklist_users"]
SQL["stream_ads_daily_top3"] = SQL["ads_daily_top3"]
SQL["stream_blacklist_users"] = SQL["blacklist_users"]
SQL["stream_click_trend"] = SQL["ad_click_trend_json"]
SQL["stream_blacklist_counts"] = SQL["blacklist_user_ad_counts"]
SQL["stream_ads_daily_top3_json"] = SQL["ads_daily_top3_json"]
