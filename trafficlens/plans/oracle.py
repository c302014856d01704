"""Independent ANSI SQL (DuckDB dialect) for each registered query.

Written flat over the driver tables ``events`` and ``nation`` (no nested
arrays), so it checks the Spark operators from a different formulation.
"""

from __future__ import annotations

# ---------------------------------------------------------------- base views
EV = """ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         CAST(e.props->>'k' AS BIGINT) AS k, n.n_name
  FROM events e LEFT JOIN nation n ON e.user_id % 25 = n.n_nationkey
)"""

# view A, flat
A = EV + """,
a AS (
  SELECT CAST(user_id AS VARCHAR) AS user_pseudo_id, event_id, epoch_us(ts) AS us,
         CAST(ts AS DATE) AS event_date,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'scroll' ELSE event_type END AS event_name,
         CASE WHEN k <> 0 THEN user_id * 100 + dayofmonth(ts) END AS session_id,
         CASE WHEN event_type = 'signup' THEN k END AS scroll_raw,
         CASE WHEN event_type = 'view' THEN '/p/' || CAST(k % 10 AS VARCHAR) END AS page_raw,
         CASE user_id % 8 WHEN 0 THEN 'google' WHEN 1 THEN 'meta' WHEN 2 THEN 'bing' WHEN 3 THEN 'programmatic'
              WHEN 4 THEN 'direct' WHEN 6 THEN 'google' WHEN 7 THEN 'newsletter' END AS src,
         CASE user_id % 8 WHEN 0 THEN 'cpc' WHEN 1 THEN 'paid_social' WHEN 2 THEN 'cpc' WHEN 3 THEN 'display'
              WHEN 4 THEN '(none)' WHEN 6 THEN 'organic' WHEN 7 THEN 'email' END AS med,
         CASE WHEN user_id % 11 <> 0 THEN n_name END AS country,
         CASE user_id % 4 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' END AS device,
         k
  FROM ev
),
hits AS (
  SELECT * FROM a
  WHERE event_name IN ('page_view','session_start','scroll','click','user_engagement','purchase','add_to_cart','view_item')
)"""

SESS = A + """,
s0 AS (
  SELECT user_pseudo_id AS client_id, session_id,
         min(us) AS start_us, max(us) AS end_us, count(*) AS total_events,
         count(*) FILTER (WHERE event_name IN ('click','user_engagement')) AS click_events,
         count(*) FILTER (WHERE event_name = 'scroll') AS scroll_events,
         max(coalesce(scroll_raw, 0)) AS max_scroll,
         arg_min(coalesce(src, '(direct)') || ' / ' || coalesce(med, '(none)'), us) AS source_medium,
         arg_min(coalesce(country, 'Unknown'), us) AS geo_country,
         arg_min(coalesce(device, 'desktop'), us) AS device_category,
         arg_min(coalesce(page_raw, '/'), us) AS landing_page
  FROM hits WHERE session_id IS NOT NULL
  GROUP BY 1, 2
),
sess AS (
  SELECT client_id, session_id,
         strftime(make_timestamp(start_us), '%Y-%m-%dT%H:%M:%S') AS event_timestamp,
         greatest((end_us - start_us) // 1000000, 0) AS session_duration_sec,
         total_events, click_events, scroll_events,
         coalesce(max_scroll, 0) AS page_scroll_depth_pct,
         round(total_events / greatest((end_us - start_us) // 1000000, 1), 2) AS event_velocity_per_sec,
         source_medium, geo_country, device_category, landing_page
  FROM s0
)"""

SESS_COLS = """client_id, session_id, event_timestamp, session_duration_sec, total_events, click_events,
  scroll_events, page_scroll_depth_pct, event_velocity_per_sec, source_medium, geo_country, device_category, landing_page"""

# view C, measured signals
SIG = """sig AS (
  SELECT user_pseudo_id AS client_id, session_id,
         max(k) / 100.0 AS edge_score,
         CAST(count(*) FILTER (WHERE event_name IN ('click','user_engagement')) * 10 AS BIGINT) AS mouse_move_events
  FROM hits WHERE session_id IS NOT NULL AND session_id % 5 <> 0
  GROUP BY 1, 2
)"""

ENRICHED = SESS + ",\n" + SIG + """,
att AS (
  SELECT s.*, g.edge_score AS m_score, g.mouse_move_events AS m_mouse,
         CASE WHEN s.session_duration_sec >= 30 AND s.event_velocity_per_sec <= 5 AND s.click_events > 0 THEN 'engaged'
              WHEN (s.session_duration_sec <= 2 OR s.event_velocity_per_sec > 15)
                   AND (lower(s.source_medium) LIKE '%programmatic%' OR lower(s.source_medium) LIKE '%display%') THEN 'bursty_display'
              WHEN s.session_duration_sec <= 2 OR s.event_velocity_per_sec > 15 THEN 'bursty'
              ELSE 'mixed' END AS behavior_tier
  FROM sess s LEFT JOIN sig g ON s.client_id = g.client_id AND s.session_id = g.session_id
),
lohi AS (
  SELECT *, greatest(5, CAST(trunc(session_duration_sec * 0.3) AS BIGINT)) AS lo FROM att
),
enr AS (
  SELECT client_id, session_id, behavior_tier, session_duration_sec,
         coalesce(m_score, CASE behavior_tier WHEN 'engaged' THEN 0.8 WHEN 'bursty_display' THEN 0.111
                                              WHEN 'bursty' THEN 0.25 ELSE 0.556 END) AS edge_score,
         coalesce(m_mouse, CASE WHEN click_events > 0 OR scroll_events > 0
                                THEN (lo + greatest(lo, least(300, CAST(trunc(session_duration_sec * 0.8) AS BIGINT)))) // 2
                                ELSE 0 END) AS mouse_move_events,
         CASE WHEN m_score IS NOT NULL THEN 'MEASURED' ELSE 'IMPUTED' END AS edge_score_source,
         CASE WHEN m_mouse IS NOT NULL THEN 'MEASURED' ELSE 'IMPUTED' END AS mouse_move_events_source
  FROM lohi
)"""

# view B, classified
B = EV + """,
b AS (
  SELECT event_id AS session_id, user_id AS client_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_timestamp,
         CAST(k AS DOUBLE) / 100.0 AS edge_score,
         round(value / 5.0, 2) AS event_velocity_per_sec,
         (event_id * 7) % 120 AS session_duration_sec,
         CAST(CASE WHEN event_type IN ('click','purchase','signup') THEN event_id % 231 + 20 ELSE 0 END AS BIGINT) AS mouse_move_events,
         CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS click_events,
         CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS BIGINT) AS scroll_events,
         k AS page_scroll_depth_pct,
         CAST(1 + event_id % 20 AS BIGINT) AS total_events,
         CASE event_id % 8 WHEN 0 THEN 'google / cpc' WHEN 1 THEN 'meta / paid_social' WHEN 2 THEN 'bing / cpc'
              WHEN 3 THEN 'programmatic / display' WHEN 4 THEN 'direct / (none)' WHEN 5 THEN '(direct) / (none)'
              WHEN 6 THEN 'google / organic' ELSE 'newsletter / email' END AS source_medium,
         n_name AS geo_country,
         CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_category,
         '/p/' || CAST(k % 10 AS VARCHAR) AS landing_page,
         CASE WHEN k >= 60 THEN 'Human' WHEN k >= 25 THEN 'LLM_Scraper' ELSE 'Ad_Fraud' END AS raw_traffic_label,
         CASE WHEN event_id % 10 < 4 THEN 'GPTBot/1.0 (+https://openai.com/gptbot)' ELSE 'Mozilla/5.0' END AS user_agent,
         CASE WHEN event_id % 3 = 0 THEN '' ELSE 'https://example.com/' END AS referrer,
         ts, value
  FROM ev
),
cls AS (
  SELECT *,
    CASE WHEN edge_score < 0.20::DOUBLE AND event_velocity_per_sec > 20.0::DOUBLE THEN 'Ad_Fraud'
         WHEN edge_score < 0.48::DOUBLE AND event_velocity_per_sec > 8.0::DOUBLE AND session_duration_sec < 10
              AND mouse_move_events = 0 THEN 'LLM_Scraper'
         WHEN edge_score >= 0.55::DOUBLE AND event_velocity_per_sec <= 5.0::DOUBLE AND session_duration_sec >= 30
              AND mouse_move_events > 0 THEN 'Human'
         WHEN edge_score >= 0.62::DOUBLE THEN 'Human'
         WHEN edge_score >= 0.38::DOUBLE THEN 'LLM_Scraper'
         ELSE 'Ad_Fraud' END AS traffic_class,
    CASE WHEN edge_score < 0.20::DOUBLE AND event_velocity_per_sec > 20.0::DOUBLE THEN 1
         WHEN edge_score < 0.48::DOUBLE AND event_velocity_per_sec > 8.0::DOUBLE AND session_duration_sec < 10
              AND mouse_move_events = 0 THEN 2
         WHEN edge_score >= 0.55::DOUBLE AND event_velocity_per_sec <= 5.0::DOUBLE AND session_duration_sec >= 30
              AND mouse_move_events > 0 THEN 3
         WHEN edge_score >= 0.62::DOUBLE THEN 4
         WHEN edge_score >= 0.38::DOUBLE THEN 5
         ELSE 6 END AS rule_fired,
    CASE WHEN lower(source_medium) LIKE '%google / cpc%' THEN 'Google Ads'
         WHEN lower(source_medium) LIKE '%meta / paid_social%' THEN 'Meta Ads'
         WHEN lower(source_medium) LIKE '%bing / cpc%' THEN 'Bing Ads'
         WHEN lower(source_medium) LIKE '%programmatic / display%' THEN 'Display'
         WHEN lower(source_medium) LIKE '%direct / (none)%' THEN 'Direct'
         WHEN lower(source_medium) LIKE '%(direct) / (none)%' THEN 'Direct'
         WHEN lower(source_medium) LIKE '%google / organic%' THEN 'Organic'
         ELSE 'Other' END AS channel,
    CASE source_medium WHEN 'google / cpc' THEN 150.0 WHEN 'meta / paid_social' THEN 120.0 WHEN 'bing / cpc' THEN 90.0
         WHEN 'direct / (none)' THEN 200.0 WHEN 'programmatic / display' THEN 60.0 WHEN '(direct) / (none)' THEN 200.0
         WHEN 'google / organic' THEN 180.0 ELSE 100.0 END::DOUBLE AS conversion_value_usd
  FROM b
)"""

CLEAN_COLS = """session_id, client_id, event_timestamp, source_medium, geo_country, device_category, landing_page,
  edge_score, session_duration_sec, event_velocity_per_sec, page_scroll_depth_pct, click_events, scroll_events,
  mouse_move_events, traffic_class, conversion_value_usd"""

PAID = """paid AS (
  SELECT * FROM (VALUES ('Google Ads', 0, 4.0::DOUBLE), ('Meta Ads', 1, 3.2::DOUBLE),
                        ('Bing Ads', 2, 3.5::DOUBLE), ('Display', 3, 2.5::DOUBLE)) t(name, priority, roas)
)"""

ATTR = B + ",\n" + PAID + """,
cstat AS (
  SELECT channel, count(*) AS raw_sessions,
         count(*) FILTER (WHERE traffic_class = 'Human') AS clean_sessions,
         coalesce(sum(conversion_value_usd) FILTER (WHERE traffic_class = 'Human'), 0.0) AS clean_kpi,
         coalesce(avg(conversion_value_usd) FILTER (WHERE traffic_class = 'Human'), 100.0) AS avg_conv_value
  FROM cls GROUP BY channel
),
d0 AS (
  SELECT p.name, p.priority, p.roas, c.channel IS NOT NULL AS observed,
         coalesce(c.raw_sessions, 0) AS raw_sessions, coalesce(c.clean_sessions, 0) AS clean_sessions,
         coalesce(c.clean_kpi, 0.0) AS clean_kpi, coalesce(c.avg_conv_value, 100.0) AS avg_conv_value
  FROM paid p LEFT JOIN cstat c ON p.name = c.channel
),
d1 AS (
  SELECT *, raw_sessions * avg_conv_value AS raw_kpi_estimate FROM d0
  WHERE observed OR NOT (SELECT bool_or(observed) FROM d0)
),
d2 AS (
  SELECT *, CASE WHEN coalesce(sum(clean_kpi) OVER (), 0) = 0 THEN 1.0 ELSE sum(clean_kpi) OVER () END AS total_clean,
            CASE WHEN coalesce(sum(raw_kpi_estimate) OVER (), 0) = 0 THEN 1.0 ELSE sum(raw_kpi_estimate) OVER () END AS total_raw
  FROM d1
),
attr AS (
  SELECT name, priority, roas, raw_sessions, clean_sessions, clean_kpi, raw_kpi_estimate, total_clean, total_raw,
         round(raw_kpi_estimate / total_raw * 100.0, 1) AS raw_contribution_pct,
         round(clean_kpi / total_clean * 100.0, 1) AS calibrated_contribution_pct,
         round((1.0 - clean_sessions / greatest(raw_sessions, 1)) * 100.0, 1) AS bot_inflation_pct,
         roas AS roi
  FROM d2
),
attr2 AS (
  SELECT *, CASE WHEN bot_inflation_pct >= 40 THEN 'High bot inflation -- calibrated lift significantly below raw'
                 WHEN bot_inflation_pct >= 20 THEN 'Moderate bot inflation -- calibrated view recommended for bidding'
                 ELSE 'Low bot contamination -- raw signal relatively reliable' END AS insight
  FROM attr
)"""

CHANNEL_OF_SRC = """CASE WHEN event_id % 8 = 0 THEN 'Google Ads' WHEN event_id % 8 = 1 THEN 'Meta Ads'
         WHEN event_id % 8 = 2 THEN 'Bing Ads' WHEN event_id % 8 = 3 THEN 'Display'
         WHEN event_id % 8 IN (4, 5) THEN 'Direct' WHEN event_id % 8 = 6 THEN 'Organic' ELSE 'Other' END"""

DAILY = B + """,
daily AS (
  SELECT CAST(ts AS DATE) AS day, count(*) AS raw, count(*) FILTER (WHERE traffic_class = 'Human') AS cleaned
  FROM cls GROUP BY 1
),
last7 AS (SELECT * FROM daily ORDER BY day DESC LIMIT 7)"""


def _panel(geo_expr: str) -> str:
    return B + """,
cl AS (
  SELECT """ + geo_expr + """ AS geo, CAST(date_trunc('week', ts) AS DATE) AS week, channel, conversion_value_usd
  FROM cls WHERE traffic_class = 'Human'
),
wk AS (
  SELECT geo, week, channel, sum(conversion_value_usd) AS kpi0, count(*) AS n
  FROM cl WHERE channel IN ('Google Ads','Meta Ads','Bing Ads','Display') GROUP BY 1, 2, 3
),
weeks AS (
  SELECT CAST(unnest(generate_series((SELECT min(week) FROM cl), (SELECT max(week) FROM cl), INTERVAL 7 DAY)) AS DATE) AS week
),
geos AS (SELECT DISTINCT geo FROM cl),
chans AS (SELECT * FROM (VALUES ('Google Ads', 4.0::DOUBLE), ('Meta Ads', 3.2::DOUBLE), ('Bing Ads', 3.5::DOUBLE),
                                ('Display', 2.5::DOUBLE)) t(channel, roas)),
panel AS (
  SELECT g.geo, w.week, c.channel, round(coalesce(k.kpi0, 0.0), 2) AS kpi,
         round(coalesce(k.kpi0, 0.0) / c.roas, 2) AS spend, coalesce(k.n, 0) AS sessions
  FROM geos g, weeks w, chans c
  LEFT JOIN wk k ON k.geo = g.geo AND k.week = w.week AND k.channel = c.channel
)"""


GAP_SESS = """WITH r AS (SELECT user_id, epoch_us(ts) AS us, event_id FROM events),
g AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM r),
m AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 1800000000 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS sn FROM g)
SELECT user_id, min(us) AS session_start_us, max(us) + 1800000000 AS session_end_us, count(*) AS n_events
FROM m GROUP BY user_id, sn"""


GAP_SESS_NULLS = GAP_SESS.replace("FROM events)", "FROM events WHERE event_id % 7 <> 0)")

# what the streams' last watermark is, in microseconds (Spark keeps milliseconds)
WATERMARK = "(SELECT (max(epoch_us(ts)) // 1000) * 1000 - 3600000000 FROM events)"

RAW_COLS = """session_id, client_id, event_timestamp, edge_score, event_velocity_per_sec, session_duration_sec, mouse_move_events,
  click_events, scroll_events, page_scroll_depth_pct, total_events, source_medium, geo_country, device_category, landing_page,
  raw_traffic_label, user_agent, traffic_class"""


def _lloyd(steps: int) -> str:
    """k-means by unrolled Lloyd steps over the view b."""
    f = ["edge_score", "event_velocity_per_sec", "session_duration_sec", "mouse_move_events"]
    start = [(0.8, 1.0, 60.0, 100.0), (0.4, 12.0, 30.0, 0.0), (0.1, 18.0, 90.0, 0.0)]
    full = " AND ".join(f"{c} IS NOT NULL" for c in f)
    parts = ["st AS (SELECT " + ", ".join(f"round(avg(CAST({c} AS DOUBLE)), 6) AS m{i}, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS s{i}"
                                          for i, c in enumerate(f)) + f" FROM b WHERE {full})",
             "z AS (SELECT client_id, session_id, " + ", ".join(f"round((CAST({c} AS DOUBLE) - m{i}) / s{i}, 6) AS z{i}" for i, c in enumerate(f))
             + f" FROM b, st WHERE {full})",
             "c0 AS (" + " UNION ALL ".join(
                 f"SELECT {k} AS c, " + ", ".join(f"round(({x}::DOUBLE - m{i}) / s{i}, 6) AS x{i}" for i, x in enumerate(row)) + " FROM st"
                 for k, row in enumerate(start)) + ")"]
    dist = " + ".join(f"pow(z{i} - x{i}, 2)" for i in range(len(f)))
    for n in range(steps + 1):
        parts.append(f"a{n} AS (SELECT client_id, session_id, z0, z1, z2, z3, arg_min(c, (d, c)) AS c FROM "
                     f"(SELECT z.*, c, {dist} AS d FROM z, c{n}) GROUP BY ALL)")
        if n < steps:
            parts.append(f"c{n + 1} AS (SELECT p.c, " + ", ".join(f"coalesce(y{i}, p.x{i}) AS x{i}" for i in range(len(f)))
                         + f" FROM c{n} p LEFT JOIN (SELECT c, "
                         + ", ".join(f"round(avg(z{i}), 6) AS y{i}" for i in range(len(f))) + f" FROM a{n} GROUP BY c) n ON n.c = p.c)")
    return ",\n".join(parts) + f"\nSELECT client_id, session_id, CAST(c AS INTEGER) AS cluster FROM a{steps}"


def _elimination(k: int) -> str:
    """The normal equations over the rows of j (spends x0.., KPI y) solved by
    Gauss-Jordan elimination, a CTE a step."""
    side = [f"x{i}" for i in range(k)] + ["y"]
    parts = ["q0 AS MATERIALIZED (SELECT count(*) AS n_points, " + ", ".join(
        f"covar_pop(x{i}, {side[c]}) AS m{i}_{c}" for i in range(k) for c in range(k + 1)) + " FROM j)"]
    for s in range(k):
        div = {c: f"m{s}_{c} / m{s}_{s}" for c in range(s + 1, k + 1)}
        cells = [f"{div[c]} AS m{s}_{c}" if i == s else f"m{i}_{c} - m{i}_{s} * ({div[c]}) AS m{i}_{c}" for i in range(k) for c in range(s + 1, k + 1)]
        parts.append(f"q{s + 1} AS MATERIALIZED (SELECT n_points, " + ", ".join(cells) + f" FROM q{s})")
    return ",\n".join(parts)


def _robust(feature: str) -> str:
    return f"""round(0.6745 * ({feature} - (SELECT med FROM st WHERE f = '{feature}'))
                / nullif((SELECT mad FROM st WHERE f = '{feature}'), 0), 4)"""


SQL: dict[str, str] = {
    "scan_date_range": "WITH " + A + """
SELECT event_id, user_pseudo_id, event_date, event_name FROM a
WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",

    "scan_partitioned_range": "WITH " + A + """
SELECT event_id, user_pseudo_id, event_date, event_name FROM a
WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",

    "scan_partitioned_days": "WITH " + A + """,
n AS (SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT event_id, user_pseudo_id, event_date, event_name FROM a
WHERE event_date IN (SELECT event_date FROM n WHERE n > (SELECT avg(n) FROM n))""",

    "scan_date_shards": """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",

    "event_allowlist": "WITH " + A + "\nSELECT event_id, user_pseudo_id, event_name FROM hits",

    "event_param_lookup": "WITH " + A + """
SELECT event_id, session_id, coalesce(scroll_raw, 0) AS percent_scrolled, coalesce(page_raw, '/') AS page_location FROM a""",

    "event_param_profile": "WITH " + A + """
SELECT 'ga_session_id' AS param_key, count(*) AS n_hits, count(session_id) AS n_int_values, CAST(0 AS BIGINT) AS n_string_values FROM a
UNION ALL
SELECT 'percent_scrolled', count(*), count(*), CAST(0 AS BIGINT) FROM a WHERE scroll_raw IS NOT NULL
UNION ALL
SELECT 'page_location', count(*), CAST(0 AS BIGINT), count(*) FROM a WHERE page_raw IS NOT NULL""",

    "sessions": "WITH " + SESS + "\nSELECT " + SESS_COLS + " FROM sess",

    "normalize_sessions": "WITH " + SESS + "\nSELECT " + SESS_COLS + " FROM sess",

    "normalize_sessions_nulls": "WITH " + SESS + """
SELECT client_id, session_id, event_timestamp, CASE WHEN session_id % 2 <> 0 THEN session_duration_sec ELSE 0 END AS session_duration_sec,
  CASE WHEN session_id % 3 <> 0 THEN total_events ELSE 0 END AS total_events, CASE WHEN session_id % 5 <> 0 THEN click_events ELSE 0 END AS click_events,
  CASE WHEN session_id % 7 <> 0 THEN scroll_events ELSE 0 END AS scroll_events,
  CASE WHEN session_id % 11 <> 0 THEN page_scroll_depth_pct ELSE 0 END AS page_scroll_depth_pct,
  CASE WHEN session_id % 13 <> 0 THEN event_velocity_per_sec ELSE 1.0::DOUBLE END AS event_velocity_per_sec,
  source_medium, geo_country, device_category, landing_page
FROM sess""",

    "sample_sessions": "WITH " + SESS + "\nSELECT " + SESS_COLS + """ FROM sess
ORDER BY md5(concat_ws('|', '42', client_id, CAST(session_id AS VARCHAR))), client_id, session_id LIMIT 1000""",

    "sample_sessions_tenth": "WITH " + SESS + "\nSELECT " + SESS_COLS + """ FROM sess
ORDER BY md5(concat_ws('|', '42', client_id, CAST(session_id AS VARCHAR))), client_id, session_id LIMIT (SELECT count(*) // 10 FROM sess)""",

    "top_sources": "WITH " + SESS + """
SELECT source_medium, count(*) AS sessions FROM sess GROUP BY 1 ORDER BY sessions DESC, source_medium LIMIT 5""",

    "gap_sessions": GAP_SESS,

    "time_between_events": "WITH " + A + """,
g AS (
  SELECT user_pseudo_id AS client_id, session_id,
         us - lag(us) OVER (PARTITION BY user_pseudo_id, session_id ORDER BY us, event_id) AS gap
  FROM hits WHERE session_id IS NOT NULL
)
SELECT client_id, session_id, count(gap) AS n_gaps,
       round(min(gap) / 1000000.0, 3) AS min_gap_sec, round(max(gap) / 1000000.0, 3) AS max_gap_sec,
       round(avg(gap) / 1000000.0, 3) AS avg_gap_sec, round(stddev_samp(gap) / 1000000.0, 3) AS stddev_gap_sec
FROM g GROUP BY 1, 2""",

    "request_cadence": "WITH " + A + """,
pm AS (SELECT user_pseudo_id AS client_id, us // 60000000 AS minute, count(*) AS hits FROM hits GROUP BY 1, 2)
SELECT client_id, max(hits) AS max_hits_per_window, count(*) AS active_windows, CAST(sum(hits) AS BIGINT) AS total_hits
FROM pm GROUP BY 1""",

    "scroll_duration_ratio": "WITH " + SESS + """
SELECT client_id, session_id,
       round(CAST(page_scroll_depth_pct AS DOUBLE) / greatest(session_duration_sec, 1), 4) AS scroll_depth_vs_session_duration
FROM sess""",

    "attach_signals": "WITH " + SESS + ",\n" + SIG + """
SELECT s.client_id, s.session_id, s.session_duration_sec, g.edge_score, g.mouse_move_events
FROM sess s LEFT JOIN sig g ON s.client_id = g.client_id AND s.session_id = g.session_id""",

    "behavior_tier": "WITH " + ENRICHED + "\nSELECT client_id, session_id, behavior_tier FROM att",

    "impute_signals": "WITH " + ENRICHED + """
SELECT client_id, session_id, behavior_tier, edge_score, mouse_move_events, edge_score_source, mouse_move_events_source FROM enr""",

    "edge_score_range": "WITH " + ENRICHED + """
SELECT min(edge_score) AS min_edge_score, max(edge_score) AS max_edge_score, count(edge_score) AS n_scored FROM enr""",

    "classify_sessions": "WITH " + B + "\nSELECT client_id, session_id, raw_traffic_label, traffic_class, rule_fired FROM cls",

    "class_distribution": "WITH " + B + "\nSELECT traffic_class, count(*) AS sessions FROM cls GROUP BY 1",

    "classification_accuracy": "WITH " + B + """
SELECT round(avg(CAST(coalesce(traffic_class = raw_traffic_label, false) AS DOUBLE)), 4) AS accuracy, count(*) AS n FROM cls""",

    "per_class_recall": "WITH " + B + """,
dim AS (SELECT * FROM (VALUES ('Human'), ('LLM_Scraper'), ('Ad_Fraud')) t(true_class)),
st AS (SELECT raw_traffic_label AS true_class, avg(CAST(traffic_class = raw_traffic_label AS DOUBLE)) AS r, count(*) AS n
       FROM cls GROUP BY 1)
SELECT d.true_class, round(st.r, 4) AS recall, coalesce(st.n, 0) AS n FROM dim d LEFT JOIN st ON d.true_class = st.true_class""",

    "confusion_matrix": "WITH " + B + """
SELECT raw_traffic_label AS true_class, traffic_class AS predicted_class, count(*) AS sessions FROM cls GROUP BY 1, 2""",

    "cleaned_sessions": "WITH " + B + "\nSELECT " + CLEAN_COLS + " FROM cls WHERE traffic_class = 'Human'",

    "bot_quarantine": "WITH " + B + """
SELECT client_id, session_id, source_medium, raw_traffic_label, traffic_class FROM cls WHERE traffic_class <> 'Human'""",

    "csv_roundtrip_clean": "WITH " + B + "\nSELECT " + CLEAN_COLS + " FROM cls WHERE traffic_class = 'Human'",

    "session_totals": "WITH " + B + """,
t AS (SELECT count(*) AS total_raw, count(*) FILTER (WHERE traffic_class = 'Human') AS total_cleaned FROM cls)
SELECT total_raw, total_cleaned, total_raw - total_cleaned AS bots_removed,
       round(CAST(total_raw - total_cleaned AS DOUBLE) * 100.0 / total_raw, 1) AS bots_removed_pct,
       round(CAST(total_cleaned AS DOUBLE) * 100.0 / total_raw, 1) AS human_pct
FROM t""",

    "vbb_summary": "WITH " + B + """
SELECT count(*) FILTER (WHERE traffic_class = 'Human') AS human_sessions,
       count(*) FILTER (WHERE traffic_class <> 'Human') AS bot_sessions,
       round(coalesce(sum(conversion_value_usd) FILTER (WHERE traffic_class = 'Human'), 0.0), 2) AS total_conv_value,
       round(avg(conversion_value_usd) FILTER (WHERE traffic_class = 'Human'), 2) AS avg_conv_value,
       round(count(*) FILTER (WHERE traffic_class <> 'Human') * 2.4::DOUBLE, 2) AS estimated_spend_saved
FROM cls""",

    "vbb_upload_payload": "WITH " + B + """
SELECT client_id, session_id, event_timestamp, source_medium, traffic_class,
       CASE WHEN traffic_class = 'Human' THEN conversion_value_usd ELSE 0.0::DOUBLE END AS conversion_value,
       CASE WHEN traffic_class <> 'Human' THEN 'internal' END AS traffic_type
FROM cls""",

    "channel_map": "WITH " + B + """
SELECT source_medium, count(*) AS sessions, any_value(channel) AS channel FROM cls GROUP BY 1""",

    "user_channel_map": "WITH " + B + """,
m AS (
  SELECT lower(n_name) AS key, 'Region ' || n_regionkey AS name, n_nationkey AS priority FROM nation WHERE n_nationkey % 3 <> 0
  UNION ALL VALUES ('cpc', 'Paid search', 50), ('paid_social', 'Paid social', 40), ('7', 'Seven', 70), ('x2', 'Pair', 60), ('no such key', 'Never', 1)),
r AS (SELECT client_id, session_id, concat_ws(' / ', source_medium, geo_country, 'X' || client_id) AS source_medium FROM b),
h AS (SELECT session_id, arg_min(name, (priority, key)) AS channel FROM r JOIN m ON contains(lower(source_medium), key) GROUP BY 1)
SELECT client_id, r.session_id, source_medium, coalesce(channel, 'Other') AS channel FROM r LEFT JOIN h ON r.session_id = h.session_id""",

    "channel_stats": "WITH " + ATTR + """
SELECT channel, raw_sessions, clean_sessions, round(clean_kpi, 2) AS clean_kpi, round(avg_conv_value, 4) AS avg_conv_value FROM cstat""",

    "observed_channels": "WITH " + B + """
SELECT channel FROM cls UNION SELECT channel FROM cls WHERE traffic_class = 'Human'""",

    "channel_attribution": "WITH " + ATTR + """
SELECT name, raw_contribution_pct, calibrated_contribution_pct, bot_inflation_pct, roi, insight FROM attr2""",

    "channel_rank_shift": "WITH " + ATTR + """,
rk AS (SELECT name, CAST(rank() OVER (ORDER BY raw_contribution_pct DESC, priority) AS INTEGER) AS raw_rank,
              CAST(rank() OVER (ORDER BY calibrated_contribution_pct DESC, priority) AS INTEGER) AS calibrated_rank,
              round(calibrated_contribution_pct - raw_contribution_pct, 1) AS contribution_shift_pct
       FROM attr2)
SELECT name, raw_rank, calibrated_rank, raw_rank - calibrated_rank AS rank_shift, contribution_shift_pct FROM rk""",

    "channel_spend": "WITH " + ATTR + """,
sh AS (SELECT *, calibrated_contribution_pct / 100.0 AS s0 FROM attr2),
sh2 AS (SELECT *, s0 / (CASE WHEN coalesce(sum(s0) OVER (), 0) = 0 THEN 1.0 ELSE sum(s0) OVER () END) AS share FROM sh)
SELECT name, round(share, 4) AS share, roas, round(total_clean * share / roas, 2) AS spend FROM sh2""",

    "roi_from_draws": "WITH " + EV + """
SELECT """ + CHANNEL_OF_SRC + """ AS channel, round(avg(2.0 + k / 50.0), 2) AS posterior_roi, count(*) AS n_draws
FROM ev GROUP BY 1""",

    "roi_override": "WITH " + ATTR + """,
post AS (SELECT """ + CHANNEL_OF_SRC + """ AS name, round(avg(2.0 + k / 50.0), 2) AS posterior_roi FROM ev GROUP BY 1)
SELECT a.name, a.roi AS prior_roi, coalesce(p.posterior_roi, a.roi) AS roi, p.posterior_roi IS NOT NULL AS posterior_used
FROM attr2 a LEFT JOIN post p ON a.name = p.name""",

    "daily_sessions": "WITH " + DAILY + """
SELECT day, strftime(day, '%a %d %b') AS label, raw, cleaned FROM last7""",

    "daily_sessions_ordered": "WITH " + DAILY + """
SELECT CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS position, day, strftime(day, '%a %d %b') AS label, raw, cleaned FROM last7""",

    "weekly_channel_panel_bounded": "WITH " + _panel("'national'").replace("FROM cls WHERE traffic_class = 'Human'",
        "FROM cls WHERE traffic_class = 'Human' AND session_id % 1000 <> 1 AND ts < TIMESTAMP '2024-02-01'") + """
SELECT geo, week, channel, kpi, spend, sessions FROM panel""",

    "daily_join": "WITH " + DAILY + """,
r AS (SELECT CAST(ts AS DATE) AS day, count(*) AS raw FROM cls GROUP BY 1),
c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS cleaned FROM cls WHERE traffic_class = 'Human' GROUP BY 1)
SELECT r.day, r.raw, coalesce(c.cleaned, 0) AS cleaned FROM r LEFT JOIN c ON r.day = c.day""",

    "weekly_channel_panel": "WITH " + _panel("'national'") + """
SELECT geo, week, channel, kpi, spend, sessions FROM panel""",

    "panel_roi": "WITH " + _panel("geo_country") + """,
ms AS (
  SELECT n_name AS geo, CAST(date_trunc('week', ts) AS DATE) AS week, """ + CHANNEL_OF_SRC + """ AS channel,
         round(sum(value), 2) AS spend
  FROM ev GROUP BY 1, 2, 3
)
SELECT p.channel, round(regr_slope(p.kpi, m.spend), 4) AS roi, round(regr_r2(p.kpi, m.spend), 4) AS r2, count(*) AS n_points
FROM panel p JOIN ms m ON p.geo = m.geo AND p.week = m.week AND p.channel = m.channel
GROUP BY 1""",

    "panel_roi_joint": "WITH " + _panel("geo_country") + """,
ms AS (
  SELECT n_name AS geo, CAST(date_trunc('week', ts) AS DATE) AS week, """ + CHANNEL_OF_SRC + """ AS channel, round(sum(value), 2) AS spend
  FROM ev GROUP BY 1, 2, 3),
sp AS (
  SELECT geo, week, """ + ", ".join(f"coalesce(sum(spend) FILTER (WHERE channel = '{c}'), 0) AS x{i}" for i, c in enumerate(("Google Ads", "Meta Ads", "Bing Ads", "Display"))) + """
  FROM ms WHERE channel IN ('Google Ads', 'Meta Ads', 'Bing Ads', 'Display') GROUP BY 1, 2),
j AS (SELECT x0, x1, x2, x3, y FROM sp JOIN (SELECT geo, week, sum(kpi) AS y FROM panel GROUP BY 1, 2) p ON p.geo = sp.geo AND p.week = sp.week),
""" + _elimination(4) + "\n" + " UNION ALL ".join(f"SELECT '{c}' AS channel, round(m{i}_4, 4) AS roi, n_points FROM q4" for i, c in enumerate(("Google Ads", "Meta Ads", "Bing Ads", "Display"))),

    "feature_profile_match": "WITH " + B + """,
m AS (
  SELECT client_id, session_id,
    CAST(coalesce(edge_score > 0.65::DOUBLE, false) AS INTEGER)
      + CAST(coalesce(event_velocity_per_sec BETWEEN 1.0 AND 5.0, false) AS INTEGER)
      + CAST(coalesce(session_duration_sec BETWEEN 45 AND 600, false) AS INTEGER)
      + CAST(coalesce(mouse_move_events BETWEEN 20 AND 250, false) AS INTEGER) AS human_matches,
    CAST(coalesce(edge_score BETWEEN 0.15::DOUBLE AND 0.48::DOUBLE, false) AS INTEGER)
      + CAST(coalesce(event_velocity_per_sec BETWEEN 8.0 AND 35.0, false) AS INTEGER)
      + CAST(coalesce(session_duration_sec BETWEEN 0 AND 6, false) AS INTEGER)
      + CAST(coalesce(mouse_move_events BETWEEN 0 AND 0, false) AS INTEGER) AS scraper_matches,
    CAST(coalesce(edge_score < 0.20::DOUBLE, false) AS INTEGER)
      + CAST(coalesce(event_velocity_per_sec BETWEEN 30.0 AND 80.0, false) AS INTEGER)
      + CAST(coalesce(session_duration_sec BETWEEN 0 AND 3, false) AS INTEGER)
      + CAST(coalesce(mouse_move_events BETWEEN 0 AND 0, false) AS INTEGER) AS fraud_matches
  FROM b
)
SELECT *, CASE WHEN human_matches >= scraper_matches AND human_matches >= fraud_matches THEN 'Human'
               WHEN scraper_matches >= fraud_matches THEN 'LLM_Scraper' ELSE 'Ad_Fraud' END AS profile_class
FROM m""",

    "bot_signature_flags": "WITH " + B + """,
f AS (
  SELECT client_id, session_id,
    CAST(coalesce(edge_score < 0.4::DOUBLE, false) AS INTEGER) AS flag_low_score,
    CAST(coalesce(regexp_matches(user_agent, '(?i)(gptbot|claudebot|bot/|crawler|spider|headless)'), false) AS INTEGER) AS flag_bot_user_agent,
    CAST(coalesce(mouse_move_events = 0, false) AS INTEGER) AS flag_zero_mouse,
    CAST(coalesce(event_velocity_per_sec > 15.0::DOUBLE, false) AS INTEGER) AS flag_high_velocity,
    CAST(coalesce(session_duration_sec < 5, false) AS INTEGER) AS flag_short_session,
    CAST(coalesce(coalesce(referrer, '') = '', false) AS INTEGER) AS flag_empty_referrer
  FROM b
)
SELECT *, flag_low_score + flag_bot_user_agent + flag_zero_mouse + flag_high_velocity + flag_short_session
          + flag_empty_referrer AS n_flags
FROM f""",

    "session_outliers": "WITH " + B + """,
x AS (SELECT client_id, session_id, edge_score, CAST(event_velocity_per_sec AS DOUBLE) AS event_velocity_per_sec,
             CAST(session_duration_sec AS DOUBLE) AS session_duration_sec, CAST(mouse_move_events AS DOUBLE) AS mouse_move_events FROM b),
md AS (SELECT median(edge_score) AS m1, median(event_velocity_per_sec) AS m2, median(session_duration_sec) AS m3,
              median(mouse_move_events) AS m4 FROM x),
st AS (
  SELECT 'edge_score' AS f, (SELECT m1 FROM md) AS med, median(abs(edge_score - (SELECT m1 FROM md))) AS mad FROM x
  UNION ALL SELECT 'event_velocity_per_sec', (SELECT m2 FROM md), median(abs(event_velocity_per_sec - (SELECT m2 FROM md))) FROM x
  UNION ALL SELECT 'session_duration_sec', (SELECT m3 FROM md), median(abs(session_duration_sec - (SELECT m3 FROM md))) FROM x
  UNION ALL SELECT 'mouse_move_events', (SELECT m4 FROM md), median(abs(mouse_move_events - (SELECT m4 FROM md))) FROM x
),
z AS (
  SELECT client_id, session_id,
    """ + _robust("edge_score") + """ AS z_edge_score,
    """ + _robust("event_velocity_per_sec") + """ AS z_event_velocity_per_sec,
    """ + _robust("session_duration_sec") + """ AS z_session_duration_sec,
    """ + _robust("mouse_move_events") + """ AS z_mouse_move_events
  FROM x
)
SELECT *, greatest(abs(z_edge_score), abs(z_event_velocity_per_sec), abs(z_session_duration_sec), abs(z_mouse_move_events)) AS max_abs_z,
       coalesce(greatest(abs(z_edge_score), abs(z_event_velocity_per_sec), abs(z_session_duration_sec), abs(z_mouse_move_events)) > 3.5, false) AS is_outlier
FROM z""",

    "training_slice": "WITH " + B + """,
bb AS (SELECT *, CAST(ts AS DATE) AS day FROM cls),
o AS (SELECT event_id, round(value, 2) AS outcome FROM events WHERE event_type = 'purchase')
SELECT client_id, session_id, day, edge_score, event_velocity_per_sec, session_duration_sec, mouse_move_events,
       raw_traffic_label AS label, coalesce(outcome, conversion_value_usd) AS conversion_value_usd
FROM bb LEFT JOIN o ON bb.session_id = o.event_id WHERE day > DATE '2024-01-21' AND day <= DATE '2024-01-28'""",

    "summary_report": "WITH " + ATTR + """,
daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS raw, count(*) FILTER (WHERE traffic_class = 'Human') AS cleaned FROM cls GROUP BY 1),
last7 AS (SELECT * FROM daily ORDER BY day DESC LIMIT 7),
t AS (SELECT count(*) AS total_raw, count(*) FILTER (WHERE traffic_class = 'Human') AS total_cleaned,
             round(coalesce(sum(conversion_value_usd) FILTER (WHERE traffic_class = 'Human'), 0.0), 2) AS total_conv_value,
             round(avg(conversion_value_usd) FILTER (WHERE traffic_class = 'Human'), 2) AS avg_conv_value FROM cls)
SELECT total_raw, total_cleaned, total_raw - total_cleaned AS bots_removed,
       round(CAST(total_raw - total_cleaned AS DOUBLE) * 100.0 / total_raw, 1) AS bots_removed_pct,
       round(CAST(total_cleaned AS DOUBLE) * 100.0 / total_raw, 1) AS human_pct,
       (SELECT string_agg(strftime(day, '%a %d %b'), '|' ORDER BY day) FROM last7) AS daily_labels,
       (SELECT string_agg(CAST(raw AS VARCHAR), '|' ORDER BY day) FROM last7) AS daily_raw,
       (SELECT string_agg(CAST(cleaned AS VARCHAR), '|' ORDER BY day) FROM last7) AS daily_cleaned,
       total_cleaned AS human_sessions, total_raw - total_cleaned AS bot_sessions, total_conv_value, avg_conv_value,
       round((total_raw - total_cleaned) * 2.4::DOUBLE, 2) AS estimated_spend_saved,
       (SELECT string_agg(name, '|' ORDER BY priority) FROM attr2) AS channel_names,
       (SELECT round(sum(clean_kpi), 2) FROM attr2) AS total_clean_value,
       (SELECT round(sum(raw_kpi_estimate), 2) FROM attr2) AS total_raw_value
FROM t""",

    "model_scores": "WITH " + B + """
SELECT client_id, session_id, round(coalesce(edge_score, 0) * 2.0::DOUBLE + coalesce(event_velocity_per_sec, 0) * -0.05::DOUBLE
  + coalesce(session_duration_sec, 0) * 0.005::DOUBLE + coalesce(mouse_move_events, 0) * 0.01::DOUBLE, 6) AS score FROM b""",

    "kmeans_clusters": "WITH " + B + ",\n" + _lloyd(5),

    "raw_csv": "WITH " + B + "\nSELECT " + RAW_COLS + " FROM cls",

    "gap_sessions_nulls": GAP_SESS_NULLS,

    "time_between_events_nulls": """WITH g AS (
  SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events WHERE event_id % 7 <> 0)
SELECT user_id, count(gap) AS n_gaps, round(min(gap)/1000000.0, 3) AS min_gap_sec, round(max(gap)/1000000.0, 3) AS max_gap_sec,
  round(avg(gap)/1000000.0, 3) AS avg_gap_sec, round(stddev_samp(gap)/1000000.0, 3) AS stddev_gap_sec FROM g GROUP BY 1""",

    "accuracy_nulls": "WITH " + B + """
SELECT round(avg(CASE WHEN session_id % 7 <> 0 AND traffic_class = raw_traffic_label THEN 1.0 ELSE 0.0 END), 4) AS accuracy, count(*) AS n FROM cls""",

    "weekly_panel_nulls": "WITH " + _panel("CASE WHEN client_id % 3 <> 0 THEN geo_country ELSE 'Unknown' END") + """
SELECT * FROM panel""",

    "stream_gap_sessions": "SELECT * FROM (" + GAP_SESS + ") WHERE session_end_us <= " + WATERMARK,

    "stream_tumbling_value": "WITH " + B + """
SELECT (epoch_us(ts) // 3600000000) * 3600000000 AS window_start_us, channel, count(*) AS sessions,
       count(*) FILTER (WHERE traffic_class = 'Human') AS human_sessions,
       round(sum(CASE WHEN traffic_class = 'Human' THEN conversion_value_usd ELSE 0.0 END), 2) AS bid_value
FROM cls GROUP BY 1, 2 HAVING window_start_us + 3600000000 <= """ + WATERMARK + """""",

    "stream_late_rows": """SELECT (epoch_us(ts) // 3600000000) * 3600000000 AS window_start_us, count(*) AS n_events
FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1 HAVING window_start_us + 3600000000 <= """ + WATERMARK + """""",

    "stream_classify": "WITH " + B + """
SELECT client_id, session_id, traffic_class, channel,
       CASE WHEN traffic_class = 'Human' THEN conversion_value_usd ELSE 0.0::DOUBLE END AS bid_value
FROM cls""",
}
