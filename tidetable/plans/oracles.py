"""The same queries in SQL, for an independent engine over the same tables.

They follow the definitions directly (expanded windows, self-joins, plain window functions) and share no shape with the
DataFrame plans.
"""

from __future__ import annotations

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def tumble(ts: str, micros: int) -> str:
    """Start of the tumbling window of a timestamp, aligned to the epoch."""
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {micros})"


CENTS = "CAST(round(value * 100) AS BIGINT)"

HOT_ITEMS = f"""
WITH panes AS (
  SELECT user_id AS item_id, {tumble('ts', HOUR)} - INTERVAL 1 HOUR * hop.i AS w_start
  FROM events, generate_series(0, 23) AS hop(i)
  WHERE event_type = 'view'
), counts AS (
  SELECT item_id, w_start, w_start + INTERVAL 1 DAY AS w_end, count(*) AS views
  FROM panes GROUP BY item_id, w_start
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY w_start ORDER BY views DESC, item_id) AS rank FROM counts
)
SELECT item_id, w_start, w_end, views, rank FROM ranked WHERE rank <= 5
"""

REPORT = f"""
SELECT w_start, w_end,
       repeat('-', 38) || chr(10)
       || string_agg('No' || rank || ':  商品ID=' || item_id || '  浏览量=' || views || chr(10), '' ORDER BY rank)
       || repeat('-', 38) || chr(10) || chr(10) AS report
FROM ({HOT_ITEMS}) GROUP BY w_start, w_end
"""

TUMBLE_COUNT = f"""
SELECT event_type, {tumble('ts', HOUR)} AS w_start, {tumble('ts', HOUR)} + INTERVAL 1 HOUR AS w_end, count(*) AS n
FROM events GROUP BY ALL
"""

TUMBLE_BOUNDS = f"""
SELECT user_id, {tumble('ts', 6 * HOUR)} AS w_start, {tumble('ts', 6 * HOUR)} + INTERVAL 6 HOUR AS w_end,
       {tumble('ts', 6 * HOUR)} + INTERVAL 6 HOUR - INTERVAL 1 MILLISECOND AS row_time, count(user_id) AS n
FROM events GROUP BY ALL
"""

ARRIVAL_TUMBLE = """
SELECT source, make_timestamp((doc_id - doc_id % 60) * 1000000) AS w_start,
       make_timestamp((doc_id - doc_id % 60 + 60) * 1000000) AS w_end, count(doc_id) AS n
FROM documents GROUP BY ALL
"""

HOP_COUNT = f"""
WITH panes AS (
  SELECT event_type, {CENTS} AS cents, {tumble('ts', 5 * MINUTE)} - INTERVAL 5 MINUTE * hop.i AS w_start
  FROM events, generate_series(0, 11) AS hop(i)
)
SELECT event_type, w_start, w_start + INTERVAL 60 MINUTE AS w_end, count(*) AS n,
       CAST(sum(cents) AS DOUBLE) / count(*) AS avg_cents, max(cents) AS top_cents
FROM panes GROUP BY event_type, w_start
"""

HOP_GAPPED = f"""
SELECT event_type, {tumble('ts', 2 * HOUR)} AS w_start, {tumble('ts', 2 * HOUR)} + INTERVAL 1 HOUR AS w_end,
       count(event_type) AS n, {tumble('ts', 2 * HOUR)} + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS row_time
FROM events WHERE epoch_us(ts) % {2 * HOUR} < {HOUR} GROUP BY ALL
"""

REGION_PV = f"""
SELECT r_name AS region, {tumble('o_orderdate', 30 * DAY)} AS "winStart",
       {tumble('o_orderdate', 30 * DAY)} + INTERVAL 30 DAY AS "winEnd", count(*) AS pv
FROM orders JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL
"""

PVUV_HOURLY = """
SELECT strftime(ts, '%Y-%m-%d %H:00') AS dt, count(*) AS pv, count(DISTINCT user_id) AS uv FROM events GROUP BY 1
"""

PVUV_TUMBLE = f"""
SELECT event_type, {tumble('ts', DAY)} AS w_start, {tumble('ts', DAY)} + INTERVAL 1 DAY AS w_end,
       count(*) AS pv, count(DISTINCT user_id) AS uv
FROM events GROUP BY ALL
"""

PVUV_PANES = f"""
WITH placed AS (
  SELECT event_id, event_type, user_id, {tumble('ts', DAY)} AS w_start FROM events
), flagged AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_type, w_start, user_id ORDER BY event_id) = 1 AS BIGINT) AS fresh
  FROM placed
)
SELECT event_id, event_type, w_start, w_start + INTERVAL 1 DAY AS w_end,
       count(*) OVER upto AS pv, CAST(sum(fresh) OVER upto AS BIGINT) AS uv
FROM flagged
WINDOW upto AS (PARTITION BY event_type, w_start ORDER BY event_id ROWS UNBOUNDED PRECEDING)
"""

WINDOW_AVG = f"""
SELECT user_id, {tumble('ts', DAY)} AS w_start, {tumble('ts', DAY)} + INTERVAL 1 DAY AS w_end,
       CAST(sum({CENTS}) AS DOUBLE) / count(*) AS avg_cents
FROM events GROUP BY ALL
"""

AVG_PANES = f"""
SELECT event_id, user_id, {tumble('ts', DAY)} AS w_start, {tumble('ts', DAY)} + INTERVAL 1 DAY AS w_end,
       CAST(sum({CENTS}) OVER upto AS DOUBLE) / count(*) OVER upto AS avg_cents
FROM events
WINDOW upto AS (PARTITION BY user_id, {tumble('ts', DAY)} ORDER BY event_id ROWS UNBOUNDED PRECEDING)
"""

AVG_ON_CHANGE = f"""
WITH averages AS (
  SELECT user_id, {tumble('ts', DAY)} AS w_start,
         CAST(sum({CENTS} // 10000) AS DOUBLE) / count(*) AS avg_step
  FROM events GROUP BY ALL
)
SELECT user_id, w_start, w_start + INTERVAL 1 DAY AS w_end, avg_step FROM averages
QUALIFY lag(avg_step) OVER (PARTITION BY user_id ORDER BY w_start) IS DISTINCT FROM avg_step
"""

PANES_ON_CHANGE = f"""
WITH panes AS (
  SELECT event_id, user_id, {tumble('ts', DAY)} AS w_start,
         CAST(sum({CENTS} // 10000) OVER upto AS DOUBLE) / count(*) OVER upto AS avg_step
  FROM events
  WINDOW upto AS (PARTITION BY user_id, {tumble('ts', DAY)} ORDER BY event_id ROWS UNBOUNDED PRECEDING)
)
SELECT event_id, user_id, w_start, w_start + INTERVAL 1 DAY AS w_end, avg_step FROM panes
QUALIFY lag(avg_step) OVER (PARTITION BY user_id ORDER BY event_id) IS DISTINCT FROM avg_step
"""

RUNNING_TOTAL = f"""
SELECT event_id, event_type, {CENTS} AS cents,
       CAST(sum({CENTS}) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM events
"""

CARRIED_TOTAL = f"""
WITH sums AS (
  SELECT event_type, {tumble('ts', HOUR)} AS w_start, sum({CENTS}) AS s FROM events GROUP BY ALL
)
SELECT event_type, w_start, w_start + INTERVAL 1 HOUR AS w_end,
       CAST(sum(s) OVER (PARTITION BY event_type ORDER BY w_start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM sums
"""

OVER_RANGE = """
SELECT o_orderkey, o_orderpriority, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
            OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate RANGE UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM orders
"""

# whitespace class written out, because the two engines' classes differ by one character
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

WORD_COUNT = f"""
WITH cut AS (
  SELECT doc_id, rtrim(text, {SPACES}) AS kept, text FROM documents
), words AS (
  SELECT doc_id, unnest(string_split(translate(kept, {SPACES}, '      '), ' ')) AS word
  FROM cut WHERE NOT (kept = '' AND text <> '')
), slices AS (
  SELECT word, make_timestamp((doc_id - doc_id % 60) * 1000000) AS slice, count(*) AS n FROM words GROUP BY ALL
)
SELECT word, slice - INTERVAL 1 MINUTE * hop.i AS w_start, slice - INTERVAL 1 MINUTE * hop.i + INTERVAL 5 MINUTE AS w_end,
       CAST(sum(n) AS BIGINT) AS n
FROM slices, generate_series(0, 4) AS hop(i) GROUP BY ALL
"""

WORD_COUNT_TUMBLE = f"""
WITH cut AS (
  SELECT doc_id, rtrim(text, {SPACES}) AS kept, text FROM documents
), words AS (
  SELECT doc_id - doc_id % 300 AS s, unnest(string_split(translate(kept, {SPACES}, '      '), ' ')) AS word
  FROM cut WHERE NOT (kept = '' AND text <> '')
)
SELECT word, make_timestamp(s * 1000000) AS w_start, make_timestamp((s + 300) * 1000000) AS w_end, count(*) AS n
FROM words GROUP BY ALL
"""

SIDES = f"""
clicks AS (
  SELECT user_id, event_id, ts AS click_ts, {tumble('ts', DAY)} AS w_start FROM events WHERE event_type = 'click'
), purchases AS (
  SELECT user_id, event_id AS purchase_id, ts AS purchase_ts, {CENTS} AS cents, {tumble('ts', DAY)} AS w_start
  FROM events WHERE event_type = 'purchase'
)"""

INNER_JOIN = f"""
WITH {SIDES}
SELECT user_id, w_start, w_start + INTERVAL 1 DAY AS w_end, event_id, click_ts, purchase_id, purchase_ts, cents
FROM clicks JOIN purchases USING (user_id, w_start)
"""

LEFT_JOIN = f"""
WITH {SIDES}
SELECT user_id, w_start, w_start + INTERVAL 1 DAY AS w_end, event_id, click_ts, purchase_id, purchase_ts,
       coalesce(cents, 0) AS cents
FROM clicks LEFT JOIN purchases USING (user_id, w_start)
"""

ARRIVALS = """
arrivals AS (
  SELECT user_id, w_start, event_id AS seq FROM clicks
  UNION ALL SELECT user_id, w_start, purchase_id FROM purchases
)"""

JOIN_PANES = f"""
WITH {SIDES}, {ARRIVALS}
SELECT c.user_id, c.w_start, c.w_start + INTERVAL 1 DAY AS w_end, c.event_id, c.click_ts,
       p.purchase_id AS right_event_id, p.purchase_ts, p.cents,
       CAST(count(*) FILTER (WHERE a.seq <= greatest(c.event_id, p.purchase_id)) AS BIGINT) AS first_pane,
       CAST(count(*) FILTER (WHERE a.seq >= greatest(c.event_id, p.purchase_id)) AS BIGINT) AS fires
FROM clicks c JOIN purchases p ON c.user_id = p.user_id AND c.w_start = p.w_start
     JOIN arrivals a ON a.user_id = c.user_id AND a.w_start = c.w_start
GROUP BY ALL
"""

LEFT_JOIN_PANES = f"""
{JOIN_PANES}
UNION ALL
SELECT * FROM (
  WITH {SIDES}, {ARRIVALS}
  SELECT c.user_id, c.w_start, c.w_start + INTERVAL 1 DAY AS w_end, c.event_id, c.click_ts,
         CAST(NULL AS BIGINT) AS right_event_id, CAST(NULL AS TIMESTAMP) AS purchase_ts, CAST(0 AS BIGINT) AS cents,
         count(*) FILTER (WHERE a.seq <= c.event_id) AS first_pane,
         count(*) FILTER (WHERE a.seq >= c.event_id AND NOT EXISTS (
           SELECT 1 FROM purchases p WHERE p.user_id = a.user_id AND p.w_start = a.w_start AND p.purchase_id <= a.seq
         )) AS fires
  FROM clicks c JOIN arrivals a ON a.user_id = c.user_id AND a.w_start = c.w_start
  GROUP BY ALL
) WHERE fires > 0
"""

INTERVAL_JOIN = f"""
WITH {SIDES}
SELECT c.user_id, event_id, click_ts, purchase_id, purchase_ts, cents
FROM clicks c JOIN purchases p ON c.user_id = p.user_id AND purchase_ts BETWEEN click_ts AND click_ts + INTERVAL 1 HOUR
"""

DIMENSION = "SELECT c_custkey AS id, c_name AS username FROM customer"

SUM_RETRACT = f"""
WITH steps AS (
  SELECT event_type, event_id, {CENTS} AS cents,
         CAST(sum({CENTS}) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
  FROM events
), updates AS (
  SELECT *, lag(total) OVER (PARTITION BY event_type ORDER BY event_id) AS old FROM steps
)
SELECT true AS op, event_type, event_id, total FROM updates WHERE old IS DISTINCT FROM total
UNION ALL
SELECT false, event_type, event_id, old FROM updates WHERE old IS NOT NULL AND old <> total
"""

PVUV_RETRACT = """
WITH flagged AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:00') AS dt,
         row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d %H:00'), user_id ORDER BY event_id) = 1 AS fresh
  FROM events
), counted AS (
  SELECT event_id, dt, count(*) OVER upto AS pv, CAST(sum(CAST(fresh AS INT)) OVER upto AS BIGINT) AS uv
  FROM flagged WINDOW upto AS (PARTITION BY dt ORDER BY event_id ROWS UNBOUNDED PRECEDING)
)
SELECT true AS op, dt, event_id, pv, uv FROM counted
UNION ALL
SELECT false, dt, event_id, old.pv, old.uv
FROM (SELECT dt, event_id, lag({'pv': pv, 'uv': uv}) OVER (PARTITION BY dt ORDER BY event_id) AS old FROM counted)
WHERE old IS NOT NULL
"""

JSON_TUMBLE = f"""
SELECT CAST(user_id AS VARCHAR) AS id, {tumble('ts', DAY)} AS w_start, {tumble('ts', DAY)} + INTERVAL 1 DAY AS w_end,
       count(*) AS n
FROM events GROUP BY ALL
"""

SUM_TABLE = f"SELECT event_type, CAST(sum({CENTS}) AS BIGINT) AS total FROM events GROUP BY event_type"

DIMENSION_JOIN = f"""
SELECT o_orderkey, id, username, o_orderdate FROM orders JOIN ({DIMENSION}) ON o_custkey = id
"""

UNION_FILTER = """
SELECT o_custkey, o_orderpriority, o_totalprice FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 200000
"""

VERSIONS = f"""
WITH arrived AS (
  SELECT event_type, epoch_us(ts) - epoch_us(ts) % {DAY} AS s, epoch_us(ts) - epoch_us(ts) % {DAY} + {DAY} AS e,
         epoch_us(ts) + CASE WHEN event_id % 10 = 0 THEN {6 * HOUR} ELSE 0 END AS came
  FROM events
), ticks AS (
  SELECT event_type, s, e, count(*) AS new,
         CASE WHEN came <= e THEN least(e, (came + {6 * HOUR} - 1) // {6 * HOUR} * {6 * HOUR})
              ELSE (came + {3 * HOUR} - 1) // {3 * HOUR} * {3 * HOUR} END AS tick
  FROM arrived WHERE came <= e + {DAY} GROUP BY ALL
)
SELECT event_type, make_timestamp(s) AS w_start, make_timestamp(e) AS w_end, make_timestamp(tick) AS fired_at,
       CASE WHEN tick < e THEN 'early' WHEN tick = e THEN 'on time' ELSE 'late' END AS kind,
       row_number() OVER versions AS version, CAST(sum(new) OVER versions AS BIGINT) AS n
FROM ticks WINDOW versions AS (PARTITION BY event_type, s ORDER BY tick)
"""

PAYLOAD_TOTALS = f"SELECT '(' || event_type || ',' || total || ')' AS value FROM ({CARRIED_TOTAL})"

ORACLES = {
    "hot_items_topk": HOT_ITEMS,
    "hot_items_report": REPORT,
    "hot_items_csv": HOT_ITEMS,
    "tumble_count": TUMBLE_COUNT,
    "tumble_bounds_rowtime": TUMBLE_BOUNDS,
    "arrival_tumble": ARRIVAL_TUMBLE,
    "hop_count": HOP_COUNT,
    "hop_gapped": HOP_GAPPED,
    "region_pv": REGION_PV,
    "region_pv_csv": REGION_PV,
    "union_all_filtered": """
SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000
UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_totalprice < 100000
""",
    "union_then_filter": UNION_FILTER,
    "append_projection": "SELECT o_orderkey AS product_id, o_totalprice AS amount FROM orders",
    "typed_rows": "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS username FROM customer",
    "pvuv_hourly": PVUV_HOURLY,
    "pvuv_tumble": PVUV_TUMBLE,
    "pvuv_panes": PVUV_PANES,
    "window_avg": WINDOW_AVG,
    "user_avg": WINDOW_AVG,
    "window_avg_panes": AVG_PANES,
    "avg_emit_on_change": AVG_ON_CHANGE,
    "panes_emit_on_change": PANES_ON_CHANGE,
    "local_times": """
SELECT event_id, ts + INTERVAL 8 HOUR AS local_ts, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:00') AS local_hour FROM events
""",
    "running_total": RUNNING_TOTAL,
    "carried_window_total": CARRIED_TOTAL,
    "over_range": OVER_RANGE,
    "word_count_sliding": WORD_COUNT,
    "window_inner_join": INNER_JOIN,
    "window_left_join": LEFT_JOIN,
    "window_join_panes": JOIN_PANES,
    "window_left_join_panes": LEFT_JOIN_PANES,
    "interval_join": INTERVAL_JOIN,
    "dimension_join_sql": DIMENSION_JOIN,
    "dimension_join_where": f"""
SELECT o_orderkey, o_custkey, username, o_orderdate FROM orders, ({DIMENSION}) WHERE o_custkey = id
""",
    "sum_retract": SUM_RETRACT,
    "pvuv_retract": PVUV_RETRACT,
    "apply_changelog": SUM_TABLE,
    "payload_words": """
SELECT event_type AS word, CAST(user_id AS INTEGER) AS frequency, event_id * 1000 AS timestamp FROM events
""",
    "line_fields": """
SELECT CAST(user_id AS VARCHAR) AS "userId", value AS price, event_id * 1000 AS timestamp FROM events
""",
    "payload_totals": PAYLOAD_TOTALS,
    "json_tumble": JSON_TUMBLE,
    "stream_hot_items": HOT_ITEMS,
    "stream_hot_items_timer": f"SELECT w_end, rank, item_id AS item, views AS n FROM ({HOT_ITEMS})",
    "stream_tumble_count": TUMBLE_COUNT,
    "stream_tumble_refined": TUMBLE_COUNT,
    "stream_hop_gapped": HOP_GAPPED,
    "stream_json_tumble": JSON_TUMBLE,
    "stream_region_pv": REGION_PV,
    "stream_pvuv_tumble": PVUV_TUMBLE,
    "stream_pvuv_hourly": PVUV_HOURLY,
    "stream_window_avg": WINDOW_AVG,
    "stream_avg_emit_on_change": AVG_ON_CHANGE,
    "stream_running_total": RUNNING_TOTAL,
    "stream_carried_total": CARRIED_TOTAL,
    "stream_payload_totals": PAYLOAD_TOTALS,
    "stream_text_avg": WINDOW_AVG,
    "stream_sum_retract": SUM_RETRACT,
    "stream_apply_changelog": SUM_TABLE,
    "stream_word_count": WORD_COUNT_TUMBLE,
    "stream_window_inner_join": INNER_JOIN,
    "stream_window_left_join": LEFT_JOIN,
    "stream_interval_join": INTERVAL_JOIN,
    "stream_dimension_join": DIMENSION_JOIN,
    "stream_union_filter": UNION_FILTER,
    "stream_tumble_sql": TUMBLE_COUNT,
    "stream_hop_sql": f"""
WITH panes AS (
  SELECT user_id, {tumble('ts', 6 * HOUR)} - INTERVAL 6 HOUR * hop.i AS w_start
  FROM events, generate_series(0, 3) AS hop(i) WHERE event_type = 'view'
)
SELECT user_id, w_start, w_start + INTERVAL 1 DAY AS w_end, count(*) AS n FROM panes GROUP BY user_id, w_start
""",
    "stream_dimension_sql": DIMENSION_JOIN,
    "stream_pvuv_retract": PVUV_RETRACT,
    "stream_keyed_table": SUM_TABLE,
    "stream_window_avg_panes": AVG_PANES,
    "stream_pvuv_panes": PVUV_PANES,
    "stream_window_join_panes": JOIN_PANES,
    "stream_window_left_join_panes": LEFT_JOIN_PANES,
    "stream_tumble_versions": VERSIONS,
    "stream_user_source": TUMBLE_COUNT,
}
