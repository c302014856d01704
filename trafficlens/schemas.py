"""Declared schemas of the export and of the session tables (no inference)."""

from pyspark.sql import types as T

EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StructType([
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
    ])),
])

# Hit-level export; stored partitioned by event_date.
GA_EVENTS = T.StructType([
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("event_timestamp", T.LongType()),  # microseconds since epoch, UTC
    T.StructField("event_name", T.StringType()),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    T.StructField("traffic_source", T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("medium", T.StringType()),
    ])),
    T.StructField("geo", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("device", T.StructType([T.StructField("category", T.StringType())])),
    T.StructField("event_date", T.DateType()),
])

SESSIONS = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("session_id", T.LongType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("session_duration_sec", T.LongType()),
    T.StructField("total_events", T.LongType()),
    T.StructField("click_events", T.LongType()),
    T.StructField("scroll_events", T.LongType()),
    T.StructField("page_scroll_depth_pct", T.LongType()),
    T.StructField("event_velocity_per_sec", T.DoubleType()),
    T.StructField("source_medium", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("landing_page", T.StringType()),
])

SIGNALS = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("session_id", T.LongType()),
    T.StructField("edge_score", T.DoubleType()),
    T.StructField("mouse_move_events", T.LongType()),
])
