"""DuckDB SQL for running results, final windows, handovers, landings and range lookups."""

from __future__ import annotations

from oracle.queries import CHANGES, LOGS, WH, Q as BASE, _top

Q: dict[str, str] = {}

Q["page_view_lines"] = f"""
WITH {LOGS}
SELECT log_date, log_type, count(*) AS pv,
       '日期: ' || CAST(log_date AS VARCHAR) || ', 页面: ' || coalesce(log_type, 'null') || ', PV: ' || CAST(count(*) AS VARCHAR) AS line
FROM logs_n GROUP BY 1, 2
"""
Q["stream_page_view_lines"] = Q["page_view_lines"]

# ---- running results -----------------------------------------------------------

Q["keyword_running_counts"] = f"""
WITH {LOGS},
kw AS (
  SELECT log_date, ms AS ts, event_id, CAST(g - 1 AS INTEGER) AS pos, trim([k::VARCHAR, ' ' || (k % 10)::VARCHAR, ''][g]) AS keyword
  FROM logs_n, range(1, 4) r(g) WHERE log_type = 'click'
)
SELECT *, count(*) OVER (PARTITION BY log_date, keyword ORDER BY ts, event_id, pos ROWS UNBOUNDED PRECEDING) AS cnt
FROM kw WHERE keyword <> ''
"""

Q["path_running_counts"] = f"""
WITH {LOGS},
p AS (SELECT log_date, ms AS ts, event_id, log_type, lag(log_type) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS prev FROM logs_n),
m AS (SELECT log_date, ts, event_id, prev || '→' || log_type AS path FROM p WHERE prev <> log_type)
SELECT *, count(*) OVER (PARTITION BY log_date, path ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cnt FROM m
"""

Q["device_user_arrivals"] = f"""
WITH {LOGS},
d AS (
  SELECT log_date AS dt, ms AS ts, event_id,
         CASE WHEN uid % 5 = 0 THEN NULL WHEN uid % 2 = 0 THEN 'ios' ELSE 'android' END AS plat,
         CASE WHEN k % 7 = 0 THEN NULL ELSE 'brand' || (k % 4)::VARCHAR END AS brand,
         CASE WHEN k % 11 = 0 THEN NULL ELSE 'v' || (uid % 3)::VARCHAR END AS platv,
         CASE WHEN uid % 9 = 0 THEN NULL ELSE 'u' || uid::VARCHAR END AS userkey
  FROM logs_n
),
f AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, plat, brand, platv, userkey ORDER BY ts, event_id) AS rn
    FROM d WHERE userkey IS NOT NULL AND plat IS NOT NULL) WHERE rn = 1
)
SELECT *, count(*) OVER (PARTITION BY dt, plat, brand, platv ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS users FROM f
"""
Q["stream_device_user_arrivals"] = Q["device_user_arrivals"]
Q["stream_keyword_daily_once"] = BASE["keyword_top10"]

# ---- windows written once -------------------------------------------------------

# A row counts from the first window of its day that was open when its lot came; a window
# is there if the last watermark has passed its end.
Q["stream_gmv_final"] = f"""
WITH sales AS (
  SELECT CAST(user_id AS VARCHAR) AS id, json_extract_string(props, '$.k')::BIGINT::VARCHAR AS product_id,
         CAST(value AS DECIMAL(18,2)) AS amt, ts,
         least((date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))
                + CASE WHEN event_id % 101 = 0 THEN 9 WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) // 10, 3) AS lot
  FROM events WHERE event_type = 'purchase'
),
marks AS (SELECT l.lot, (SELECT max(ts) FROM sales s WHERE s.lot < l.lot) - INTERVAL 5 SECOND AS mark FROM range(0, 4) l(lot)),
reached AS (SELECT max(ts) - INTERVAL 5 SECOND AS mark FROM sales),
placed AS (
  SELECT CAST(CAST(s.ts AS DATE) AS TIMESTAMP) AS window_start, s.id, s.product_id, s.amt,
         greatest((hour(s.ts) * 3600 + minute(s.ts) * 60 + second(s.ts)) // 600 + 1,
                  coalesce(CAST(floor((epoch_us(m.mark) - epoch_us(CAST(CAST(s.ts AS DATE) AS TIMESTAMP))) / 600000000.0) AS BIGINT) + 1, 1)) AS pane
  FROM sales s JOIN marks m USING (lot)
),
panes AS (SELECT * FROM placed WHERE pane <= 144),
wins AS (SELECT window_start, unnest(generate_series(min(pane), 144)) AS w FROM panes GROUP BY window_start),
upto AS (
  SELECT w.window_start, w.w, p.id, p.product_id, p.amt
  FROM wins w JOIN panes p ON p.window_start = w.window_start AND p.pane <= w.w
  WHERE w.window_start + to_seconds(w.w * 600) <= (SELECT mark FROM reached)
),
gmv AS (SELECT window_start, w, sum(amt) AS gmv FROM upto GROUP BY 1, 2),
{_top('id', 'top5_ids')},
{_top('product_id', 'top5_product_ids')}
SELECT strftime(g.window_start, '%Y-%m-%d') AS order_date, g.window_start, g.window_start + to_seconds(g.w * 600) AS window_end,
       CAST(g.gmv AS DECIMAL(38,2)) AS gmv, coalesce(i.top5_ids, '') AS top5_ids, coalesce(p.top5_product_ids, '') AS top5_product_ids
FROM gmv g
LEFT JOIN top5_ids_t i ON i.window_start = g.window_start AND i.w = g.w
LEFT JOIN top5_product_ids_t p ON p.window_start = g.window_start AND p.w = g.w
"""

Q["stream_arrival_paths"] = f"""
WITH {LOGS},
a AS (SELECT *, event_id * 50 AS arrived, event_id * 50 // 10000 AS slot FROM logs_n),
p AS (SELECT slot, log_date, log_type, lag(log_type) OVER (PARTITION BY user_id, slot ORDER BY ms, event_id) AS prev FROM a),
m AS (SELECT TIMESTAMP '2024-03-01' + to_seconds((((slot + 1) * 10000 - 1) // 15000 + 1) * 15) AS flush_end, log_date, prev || '→' || log_type AS path
      FROM p WHERE prev <> log_type),
c AS (SELECT flush_end, log_date, path, count(*) AS cnt FROM m GROUP BY 1, 2, 3),
t AS (SELECT *, CAST(sum(cnt) OVER (PARTITION BY log_date, path ORDER BY flush_end ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM c)
SELECT *, CAST(log_date AS VARCHAR) || ' (' || path || ',' || CAST(total AS VARCHAR) || ')' AS line FROM t
"""

# ---- handover and landing ---------------------------------------------------------

HANDOVER = f"""{CHANGES},
taken AS (SELECT max(event_id) // 2 AS lsn FROM events),
snap AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, lsn DESC) AS rn FROM ch WHERE op IS NOT NULL AND lsn <= (SELECT lsn FROM taken)
  ) WHERE rn = 1 AND op <> 'd'
),
both_parts AS (
  SELECT user_id, event_type, value, 'r' AS op, CAST(0 AS BIGINT) AS ts_ms, source_table, (SELECT lsn FROM taken) AS lsn FROM snap
  UNION ALL
  SELECT user_id, event_type, value, op, ts_ms, source_table, lsn FROM ch WHERE op IS NOT NULL AND lsn > (SELECT lsn FROM taken)
)"""
Q["change_handover"] = f"WITH {HANDOVER} SELECT * FROM both_parts"
# The state is that of the whole log, as if there had been no snapshot.
Q["change_handover_state"] = f"SELECT user_id, event_type, value FROM ({BASE['change_current_state']})"

Q["ods_incremental_users"] = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
) WHERE rn = 1 AND event_type <> 'error'
"""

# ---- ranges ------------------------------------------------------------------------

RANGES = """
r AS (
  SELECT s AS start_ip, least(s + (CAST(1 AS BIGINT) << CAST(k % 32 AS INTEGER)) - 1, 4294967295) AS end_ip, 'r' || CAST(k AS VARCHAR) AS region
  FROM (SELECT CAST(p_partkey AS BIGINT) AS k, (CAST(p_partkey AS BIGINT) * 2654435761) % 4294967296 AS s FROM part)
  UNION ALL SELECT 0, 4294967295, 'all'
),
a AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ((event_id + 17) * 2654435761) % 4294967296 END AS ip FROM events)"""
HITS = "SELECT a.event_id, a.ip, arg_min(r.region, (r.end_ip - r.start_ip, r.start_ip, r.region)) AS region FROM a LEFT JOIN r ON a.ip BETWEEN r.start_ip AND r.end_ip GROUP BY 1, 2"
Q["ip_interval_lookup"] = f"WITH {RANGES} {HITS}"
Q["ip_interval_lookup_v6"] = f"""
WITH {RANGES}
SELECT event_id, '20010db8' || lpad(lower(to_hex(ip)), 8, '0') || lpad(lower(to_hex(event_id % 65536)), 16, '0') AS ip, region FROM ({HITS})
"""

# ---- warehouse ----------------------------------------------------------------------

Q["dwd_order_info"] = f"""
WITH {WH},
clean AS (SELECT order_id, count(*) AS line_num, CAST(sum(quantity) AS BIGINT) AS item_num, sum(amount) AS amount
          FROM (SELECT DISTINCT order_id, line_no, sku_id, quantity, amount, return_flag FROM ol) WHERE quantity > 0 GROUP BY 1)
SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id,
       CASE o.o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' WHEN 'F' THEN 'finished' ELSE 'unknown' END AS status,
       coalesce(c.line_num, 0) AS line_num, coalesce(c.item_num, 0) AS item_num, CAST(coalesce(c.amount, 0) AS DECIMAL(38,4)) AS amount,
       CAST(CASE WHEN o.o_orderstatus = 'F' AND o.o_totalprice > 0 THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS DECIMAL(38,2)) AS paid_amount,
       o.o_orderstatus = 'F' AND o.o_totalprice > 0 AS is_paid,
       DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) % 30 AS INTEGER) AS dt
FROM orders o LEFT JOIN clean c ON c.order_id = o.o_orderkey
"""

Q["dwd_payment_info"] = """
SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS user_id, o_custkey AS buyer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, d AS order_dt, d AS dt
FROM (SELECT *, DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER) AS d FROM orders)
WHERE o_orderstatus = 'F' AND o_totalprice > 0
"""

SPAN = f"""
WITH {WH}
SELECT store_id, source_type, count(DISTINCT user_id) AS visitors{{}}
FROM page_log WHERE action = 'view' AND user_id IS NOT NULL AND dt BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY 1, 2
"""
Q["visitor_span"] = SPAN.format("")
Q["visitor_span_sketch"] = SPAN.format(", true AS sketch_close")
