"""DuckDB SQL of the newer streaming queries."""

from __future__ import annotations

from .oracle import B, GAP_SESS, WATERMARK

# the signal must come within an hour of its session; a session without one is
# out once the watermark, that of the slower stream, has passed its hour
LATE = B + """,
g AS (SELECT event_id, epoch_us(ts) + (event_id % 90) * 60000000 AS at FROM events WHERE event_id % 5 <> 0),
j AS (
  SELECT cls.*, g.event_id IS NOT NULL AS measured, epoch_us(ts) AS us,
    CASE WHEN session_duration_sec >= 30 AND event_velocity_per_sec <= 5 AND click_events > 0 THEN 'engaged'
         WHEN (session_duration_sec <= 2 OR event_velocity_per_sec > 15)
              AND (lower(source_medium) LIKE '%programmatic%' OR lower(source_medium) LIKE '%display%') THEN 'bursty_display'
         WHEN session_duration_sec <= 2 OR event_velocity_per_sec > 15 THEN 'bursty' ELSE 'mixed' END AS tier,
    greatest(5, CAST(trunc(session_duration_sec * 0.3) AS BIGINT)) AS lo
  FROM cls LEFT JOIN g ON cls.session_id = g.event_id AND g.at <= epoch_us(ts) + 3600000000)"""

# spans of five minutes are out once the watermark has passed them; the latest
# first hit among these, less a span, is the watermark of the sessions
SPLIT = """WITH p AS (SELECT user_id % 2 AS user_id, epoch_us(ts) // 300000000 AS span, min(epoch_us(ts)) AS first_us FROM events GROUP BY 1, 2)
SELECT s.* FROM (""" + GAP_SESS.replace("SELECT user_id, epoch_us", "SELECT user_id % 2 AS user_id, epoch_us") + """) s
WHERE session_end_us <= (SELECT (max(first_us) // 1000) * 1000 - 300000000 FROM p WHERE (span + 1) * 300000000 <= """ + WATERMARK + """)"""

STREAM_SQL = {
    "stream_split_sessions": SPLIT,

    "stream_attach_signals": "WITH " + LATE + """
SELECT client_id, session_id,
  CASE WHEN measured THEN edge_score ELSE CASE tier WHEN 'engaged' THEN 0.8 WHEN 'bursty_display' THEN 0.111 WHEN 'bursty' THEN 0.25 ELSE 0.556 END END AS edge_score,
  CASE WHEN measured THEN mouse_move_events WHEN click_events > 0 OR scroll_events > 0
       THEN (lo + greatest(lo, least(300, CAST(trunc(session_duration_sec * 0.8) AS BIGINT)))) // 2 ELSE 0 END AS mouse_move_events,
  CASE WHEN measured THEN 'MEASURED' ELSE 'IMPUTED' END AS edge_score_source
FROM j WHERE measured OR us + 3600000000 < """ + WATERMARK,

    "stream_upsert_feed": "WITH " + B.replace("CAST(e.props->>'k' AS BIGINT) AS k",
                                              "(CAST(e.props->>'k' AS BIGINT) + CASE WHEN e.event_id % 7 = 0 THEN 50 ELSE 0 END) % 100 AS k") + """
SELECT client_id, session_id, event_timestamp, source_medium, traffic_class,
       CASE WHEN traffic_class = 'Human' THEN conversion_value_usd ELSE 0.0::DOUBLE END AS conversion_value,
       CASE WHEN traffic_class <> 'Human' THEN 'internal' END AS traffic_type,
       CAST(CASE WHEN session_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS revision, CAST(ts AS DATE) AS day
FROM cls""",
}
